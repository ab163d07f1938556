"""URL functions (FN-05 to FN-09) as built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, which: str) -> Column:
    """scheme, host, path or query of a URL, empty where it has none."""
    return F.regexp_extract(url, _PARTS, ("scheme", "host", "path", "query").index(which) + 1)


def canonical_url(url: Column, preserve_query: bool = False) -> Column:
    """White space and fragment removed, scheme (https by default) and host in lower case; the query goes unless kept."""
    u = F.regexp_replace(url, r"(?U)\s+", "")
    scheme, query = F.lower(part(u, "scheme")), part(u, "query")
    head = F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), F.lower(part(u, "host")), part(u, "path"))
    return F.concat(head, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")) if preserve_query else head


def directory(url: Column) -> Column:
    """The URL without its last path segment, trailing slashes, query and fragment."""
    path = F.regexp_replace(F.regexp_replace(part(url, "path"), "/+$", ""), "/?[^/]*$", "")
    return F.concat(part(url, "scheme"), F.lit("://"), part(url, "host"), path)


def on_domain(url: Column, domain: str) -> Column:
    """Whether a URL's host is the domain or its www name (FN-08)."""
    return F.lower(part(url, "host")).isin(domain, f"www.{domain}")


#: Endings of resources that are no pages.
NOT_PAGES = "pdf txt jpg jpeg png gif svg css js json xml zip tar gz mp3 mp4 avi mov wav epub mobi azw3 prc".split()


def is_html(url: Column) -> Column:
    return ~F.lower(url).rlike(r"\.(?:" + "|".join(NOT_PAGES) + ")$")


#: Path parts that mark navigation and apparatus, and path parts that mark content.
SKIPPED = """/subject/ /history/ /glossary/ /reference/subject /admin/ /search /browse subject-index writer-index title-index /images/ /css/
/scripts/ /ebooks/ /ebook/ /audiobooks/ /audiobook/ /downloads/ /download/ /works/download/ /works/pdf/ /guide/ /guides/ /structure/ /visitors/
/reviews- /review- /bio/ /photo/ /photos/ txtindex.htm index-l.htm /works/date/ /works/subject/ /espanol/ /portugues/ /francais/ /catala/
/italiano/ /deutsch/ /nederlands/ /svenska/ /russkij/ /russian/ /polski/ /czech/ /chinese/ /korean/ /japanese/ /indonesia/ /tagalog/ /filipino/
/thai/ /vietnamese/ /hindi/ /urdu/ /tamil/ /bahasa/ /farsi/ /persian/ /arabic/ /hebrew/ /turkce/ /turkish/ /greek/ /esperanto/ /hungarian/
/finnish/ /xlang/""".split()
CONTENT = "/archive/ /works/ /collected-works/ /letters/ /articles/".split()


def likely_content(url: Column) -> Column:
    """Skipped parts first, then queries, content parts, depth and kind of page (FN-09)."""
    path = F.lower(part(url, "path"))
    depth = F.length(F.regexp_replace(F.regexp_replace(path, "/+$", ""), "[^/]", ""))
    any_of = lambda words: "|".join(map(re.escape, words))
    page = (path.endswith("/") | path.contains("index.htm")) & depth.between(2, 4) | F.lower(url).rlike(r"\.html?$")
    return F.when(path.rlike(any_of(SKIPPED)) | url.contains("?"), False).when(path.rlike(any_of(CONTENT)) | (depth <= 4) | page, True).otherwise(False)
