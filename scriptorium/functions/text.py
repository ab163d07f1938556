"""Text functions: white space, sentences, cluster keys, subtypes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A sentence ends after . ! or ? if white space and, past quotes, a capital or digit follows.
BOUNDARY = "(?U)(?<=[.!?])\\s+(?=[\"'“”‘’(]*[A-Z0-9])"


def clean(text: Column) -> Column:
    """White space collapsed and stripped (TF-04)."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def sentences(text: Column) -> Column:
    """Sentences of a paragraph, in order, without empty ones (TF-12)."""
    stripped = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.filter(F.transform(F.split(stripped, BOUNDARY), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")), lambda s: s != "")


def cluster_key(label: Column) -> Column:
    """Lower case, other than word characters and hyphens to spaces, collapsed (FN-16)."""
    return clean(F.regexp_replace(F.lower(label), r"(?U)[^\w\-]+", " "))


def block_type(level: Column) -> Column:
    return F.when(level <= 1, "chapter").when(level == 2, "section").when(level == 3, "subsection").otherwise("other")


def block_subtype(title: Column) -> Column:
    """First kind of apparatus that a title names, if any (TF-06)."""
    has = lambda *w: F.lower(title).rlike("|".join(w))
    return F.when(has("preface"), "preface").when(has("afterword", "postface"), "afterword").when(has("footnote", "notes"), "footnote").when(has("appendix"), "appendix")


def page_subtype(url: Column, block: Column) -> Column:
    """Subtype of a page by its block where that is decisive, else by its address (TF-11)."""
    by_url = F.when(F.lower(url).endswith("/guide.htm"), "study_guide").when(F.lower(url).rlike(r"/index\.html?$"), "toc")
    return F.coalesce(F.when(block.isin("preface", "afterword", "footnote", "editor_note"), block), by_url, block)
