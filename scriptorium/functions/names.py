"""Names and titles: normal forms, similarity, canonical casing (FN-10 to FN-15, FN-23, FN-24)."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from .text import clean

#: Name suffixes, in the order they are taken off.
SUFFIXES = (" jr", " sr", " iii", " ii", " iv")


def match_form(name: Column) -> Column:
    """Lower case, no dots, single spaces, suffixes taken off in turn."""
    bare = clean(F.regexp_replace(F.lower(name), r"\.", ""))
    return reduce(lambda c, s: F.regexp_replace(c, f"{s}$", ""), SUFFIXES, bare)


def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp ratio; not symmetric, the order of the arguments counts."""
    return SequenceMatcher(None, a, b).ratio()


def reaches(a: str, b: str, least: float) -> bool:
    """Whether the ratio is at least so much: lengths, then character counts, rule most pairs out before it is computed."""
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least


def same_author_forms(a: str, b: str, threshold: float) -> bool:
    """Whether two normal forms name one author: equal, similar, a lone token of the other, or initials and surname."""
    if a == b or reaches(a, b, threshold):
        return True
    x, y = a.split(), b.split()
    if len(x) == 1 and x[0] in y or len(y) == 1 and y[0] in x:
        return True
    if not x or not y or len(x) > len(y):
        return False
    initials = (p[0] == q[0] for p, q in zip(x, y, strict=False) if len(p) == 1 or len(q) == 1)
    return all(initials) and (x[-1] == y[-1] or reaches(x[-1], y[-1], 0.85) and ratio(x[-1], y[-1]) > 0.85)


def same_author(threshold: float = 0.85):
    """Arrow UDF over two columns of normal forms, the earlier name first."""

    @F.pandas_udf(BooleanType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_author_forms(p, q, threshold) for p, q in zip(a, b, strict=True)])

    return run


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if p is None or q is None else ratio(p, q) for p, q in zip(a, b, strict=True)])


def title_similarity(a: str, b: str) -> float:
    """1 if equal, else a mix of character ratio and word overlap."""
    if a == b:
        return 1.0
    x, y = set(a.split()), set(b.split())
    return 0.55 * ratio(a, b) + 0.45 * (len(x & y) / len(x | y) if x | y else 0.0)


#: Words that stay small inside a title, and initialisms that keep their capitals.
SMALL = frozenset("a an the and or nor but for so yet as at by in of on to from with over under into onto upon".split())
ACRONYMS = frozenset("US USA UK UN EU USSR CIA FBI NATO NAFTA".split())
_TOKENS = re.compile(r"[A-Za-z0-9]+(?:'[A-Za-z]+)?|[^A-Za-z0-9]+")
_ROMAN = re.compile(r"[IVXLCDM]+", re.I)


def title_form(title: str | None) -> str | None:
    """Single spaces; titles in capitals get title case, with small words, numerals and initialisms respected."""
    if title is None:
        return None
    title = re.sub(r"\s+", " ", title).strip()
    letters = [c for c in title if c.isalpha()]
    upper, lower = sum(map(str.isupper, letters)), sum(map(str.islower, letters))
    if len(letters) < 6 or not (lower == 0 and upper >= 6 or upper / max(1, upper + lower) >= 0.7):
        return title
    tokens = _TOKENS.findall(title)
    words = [i for i, t in enumerate(tokens) if t[0].isascii() and t[0].isalnum()]
    if not words:
        return title
    lettered = [i for i in words if any(c.isalpha() for c in tokens[i])] or words
    ends = {lettered[0], lettered[-1]}

    def cased(i: int) -> str:
        t = tokens[i]
        if t.isdigit():
            return t
        if _ROMAN.fullmatch(t):
            return t.upper()
        if i not in ends and t.lower() in SMALL:
            return t.lower()
        if t.isupper() and (t in ACRONYMS or any(c.isdigit() for c in t)):
            return t
        return t[0].upper() + t[1:].lower()

    return "".join(cased(i) if i in set(words) else t for i, t in enumerate(tokens))


@F.pandas_udf(StringType())
def canonical_title(title: pd.Series) -> pd.Series:
    return title.map(title_form)


def sort_name(name: Column) -> Column:
    """Last, First."""
    return F.regexp_replace(name, r"^(.*) ([^ ]+)$", "$2, $1")


def variant_type(alias: Column, canonical: Column) -> Column:
    """Kind of a name variant: initials (a dot, three words at most), a shorter form, or an abbreviation."""
    short = (alias != canonical) & canonical.contains(alias)
    return F.when(alias.contains(".") & (F.size(F.split(F.trim(alias), r"\s+")) <= 3), "initials").when(short, "short_form").otherwise("abbreviation")
