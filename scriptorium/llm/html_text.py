"""Main text of web pages: nearest-URL page differencing over block structure.

Pages of a host are sorted by URL path; each page meets the nearer of its two neighbours, by shared path segments, then
characters. Their text lines are aligned by longest common subsequence, and shared lines are deleted: what neighbouring
pages have in common is template. Two kinds of evidence from the markup go into that. Elements that are never content
(navigation, forms, scripts, adverts, ...) go in any case. Lines inside an article (article or main element) need both
neighbours as witnesses and must stand at its end, as sharing links and credits do; a neighbour that shares most of the
article is a copy of it and no witness.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from itertools import takewhile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_CLASS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z0-9]+")

#: Elements whose text is never content, raw-text elements, and elements that are blocks of their own.
DROPPED = frozenset("nav header footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu head title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role names that mark what is not content, and words that may stand beside them.
MARKED = frozenset("ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent disqus footer header menu nav navbar navigation newsletter notice notices pagination popup promo respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
BESIDE = frozenset("area big bar block bottom box buttons container content form inner left links list main message outer page panel right section site small text top wrap wrapper".split())
#: An element that implies the end of an open one: block starts end a paragraph, an item ends an item, and so on.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTENT = {"main": 1, "article": 2}


def _marked(attributes: str) -> bool:
    """Whether a class, id or role has a name that consists of marked words and words beside them: sidebar-left is one, has-sidebar and ad-hoc are not."""
    if "=" not in attributes:
        return False
    for m in _CLASS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _PART.findall(name)
            if not MARKED.isdisjoint(words) and all(w in MARKED or w in BESIDE for w in words):
                return True
    return False


def lines(page: str | None) -> list[tuple[str, int]]:
    """(text, depth) of the page's blocks, in order, without dropped elements and empty blocks; depth 2 is in an article, 1 in main."""
    out: list[tuple[str, int]] = []
    if not page:
        return []
    open_: list[tuple[str, bool, int]] = []  # name, dropped, depth of content: 1 in main, 2 in an article
    count: Counter[str] = Counter()  # of open elements by name
    parts: list[str] = []
    at, end = 0, len(page)

    def flush():
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, open_[-1][2] if open_ else 0))

    def close(i: int):
        if any(o[0] in BLOCKS for o in open_[i:]):
            flush()
        count.subtract(o[0] for o in open_[i:])
        del open_[i:]

    def text(a: int, b: int):
        if b > a and not (open_ and open_[-1][1]):
            parts.append(page[a:b])

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(at, end)
            break
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if count[name] > 0:
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            elif name in BLOCKS:
                flush()
            continue
        if name in BLOCKS:
            flush()
            if count["p"] > 0 and name != "hr":
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] == "p":
                        close(i)
                        break
                    if open_[i][0] in BLOCKS:
                        break
        if name in ENDS and any(count[n] > 0 for n in ENDS[name]):
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in ENDS[name]:
                    close(i)
                    break
                if open_[i][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        dropped = bool(open_) and open_[-1][1]
        inside = open_[-1][2] if open_ else 0
        if name in VOID:
            if name == "br" and not dropped:
                parts.append(" ")
            continue
        # a header or heading inside an article is part of it; page headers are not
        gone = dropped or name in DROPPED and not (name == "header" and inside) or name not in ("html", "body", *CONTENT) and _marked(m[3])
        if gone and not dropped and name in BLOCKS:
            flush()
        if name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if not m[3].endswith("/"):
                at = stop.end() if stop else end
            continue
        if not m[3].rstrip().endswith("/"):
            open_.append((name, gone, max(inside, CONTENT.get(name, 0))))
            count[name] += 1
    flush()
    return out


def common_lines(a: list, b: list) -> set[int]:
    """Places of a that a longest common subsequence with b keeps; equal ends are aligned first."""
    lo, x, y = 0, len(a), len(b)
    while lo < x and lo < y and a[lo] == b[lo]:
        lo += 1
    keep = set(range(lo))
    while x > lo and y > lo and a[x - 1] == b[y - 1]:
        x, y = x - 1, y - 1
        keep.add(x)
    known = set(b[lo:y]) & set(a[lo:x])
    ai = [i for i in range(lo, x) if a[i] in known]
    bi = [j for j in range(lo, y) if b[j] in known]
    if not ai:
        return keep
    # Hunt-Szymanski: longest increasing run of matching places
    where: dict = {}
    for j in bi:
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in ai:
        for j in reversed(where[a[i]]):
            k = bisect_left(ends, j)
            node = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(node)
            else:
                ends[k], links[k] = j, node
    node = links[-1]
    while node:
        keep.add(node[0])
        node = node[1]
    return keep


def nearness(a: str, b: str) -> tuple[int, int]:
    """Shared leading path segments, then characters, of two paths."""
    x, y = a.split("/"), b.split("/")
    segments = next((i for i, (s, t) in enumerate(zip(x, y, strict=False)) if s != t), min(len(x), len(y)))
    characters = next((i for i, (s, t) in enumerate(zip(a, b, strict=False)) if s != t), min(len(a), len(b)))
    return segments, characters


#: An article is the page's content if it holds so much of the text that is left.
REGION = 0.25


class Page(NamedTuple):
    """What differencing needs of a page: its lines' hashes, lengths and depths."""

    key: tuple
    host: str
    path: str
    hashes: list
    sizes: list
    depths: list


def decide(before: Page | None, page: Page, after: Page | None) -> list[int]:
    """Numbers of the page's lines that are content, given the pages before and after it in URL order."""
    everything, deepest = range(len(page.hashes)), max(page.depths, default=0)
    inside = {i for i in everything if deepest and page.depths[i] == deepest}
    shared = {}
    for near in (p for p in (before, after) if p and p.host == page.host):
        common = common_lines(page.hashes, near.hashes)
        own = inside or set(everything)
        alike, whole = sum(page.sizes[i] for i in own & common), sum(page.sizes[i] for i in own)
        if alike < whole and (not inside or 2 * alike <= whole):  # else a copy
            shared[near] = common
    gone: set[int] = set()
    if shared:
        gone = shared[max(shared, key=lambda p: nearness(page.path, p.path))] - inside
    if len(shared) == 2:
        both = set.intersection(*shared.values())
        # what follows the article; a line at its head or amid others is content
        gone |= both - inside | set(takewhile(both.__contains__, sorted(inside, reverse=True)))
    kept = [i for i in everything if i not in gone]
    total = sum(page.sizes[i] for i in kept)
    for depth in (2, 1):
        region = [i for i in kept if page.depths[i] >= depth]
        if region and sum(page.sizes[i] for i in region) >= REGION * total:
            return region
    return kept


_LINED = "k1 long, k2 long, host string, path string, page_id long, hashes array<bigint>, sizes array<int>, depths array<tinyint>"
_DECIDED = "k1 long, k2 long, keep array<int>, part int, place int, host string, path string, hashes array<bigint>, sizes array<int>, depths array<tinyint>"
_DECIDED_TYPES = {"k1": pa.int64(), "k2": pa.int64(), "keep": pa.list_(pa.int32()), "part": pa.int32(), "place": pa.int32(), "host": pa.string(), "path": pa.string(), "hashes": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32()), "depths": pa.list_(pa.int8())}


def _lined(batches):
    for batch in batches:
        found = [lines(h) for h in batch.column("html").to_pylist()]
        hashes = [[xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - 2**63 for t, _ in f] for f in found]
        own = [batch.column(n) for n in ("k1", "k2", "host", "path", "page_id")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(hashes, pa.list_(pa.int64())), pa.array([[len(t) for t, _ in f] for f in found], pa.list_(pa.int32())), pa.array([[d for _, d in f] for f in found], pa.list_(pa.int8()))], ["k1", "k2", "host", "path", "page_id", "hashes", "sizes", "depths"])


def _pages(batches):
    for batch in batches:
        for r in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "host", "path", "hashes", "sizes", "depths")), strict=True):
            yield Page((r[0], r[1]), *r[2:4], *map(tuple, r[4:]))


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_DECIDED_TYPES.values())], list(_DECIDED_TYPES))


def _edge(page: Page, part: int, place: int):
    return (*page.key, None, part, place, page.host, page.path, page.hashes, page.sizes, page.depths)


def _decided(batches):
    """Lines to keep of every page of a sorted partition that has both neighbours there; its first and last two pages as they are."""
    part, out, window, n = TaskContext.get().partitionId(), [], [], 0
    for page in _pages(batches):
        window.append(page)
        n += 1
        if n <= 2:
            out.append(_edge(page, part, n))
        if len(window) == 3:
            out.append((*window[1].key, decide(*window), *[None] * 7))
            window.pop(0)
        if len(out) >= 4096:
            yield _rows(out)
            out = []
    out += [_edge(page, part, n - len(window) + 1 + i) for i, page in enumerate(window) if n - len(window) + 1 + i > 2]
    if out:
        yield _rows(out)


def _joined_edges(table: pa.Table) -> pa.Table:
    """Lines to keep of the first and last page of every partition, from the partitions' first and last pages in order."""
    order = table.sort_by([("part", "ascending"), ("place", "ascending")])
    pages, parts = list(_pages([order])), order.column("part").to_pylist()
    padded, out = [None, *pages, None], []
    for i, page in enumerate(pages):
        if i == 0 or i == len(pages) - 1 or parts[i - 1] != parts[i] or parts[i + 1] != parts[i]:
            out.append((*page.key, decide(padded[i], page, padded[i + 2])))
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(list(_DECIDED_TYPES.items())[:3])})


def _texts(batches):
    for batch in batches:
        texts = []
        for page, keep in zip(batch.column("html").to_pylist(), batch.column("keep").to_pylist(), strict=True):
            found = lines(page) if keep else []
            texts.append("\n".join(found[i][0] for i in keep or []))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars; one row for each row.

    Lines' hashes are range-partitioned by host, path and page_id, so a large host takes many tasks; the first and last
    page of each partition meet those of the next in a second step, so results do not depend on the partitions.
    Character references are decoded, white space inside a block becomes one space, blocks are joined by a newline. A
    page with an article or main element that holds at least REGION of the text left yields that element's lines; any
    other yields all lines left after dropping and differencing. Null and empty html give an empty text, and no page meets them; null urls
    share an empty host; repeated rows count as one page and get equal results; other columns are ignored.
    """
    host = F.regexp_replace(F.lower(F.coalesce(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))), r"^(?:www|m)\.", "")
    path = F.coalesce(F.regexp_extract("url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), F.lit(""))
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    plain = plain.select("page_id", "url", "html", *(F.xxhash64(F.lit(i), "page_id", "url", "html").alias(f"k{i}") for i in (1, 2)))
    lined = cut(plain.select("k1", "k2", host.alias("host"), path.alias("path"), "page_id", "html").mapInArrow(_lined, _LINED).filter("size(hashes) > 0").dropDuplicates(["k1", "k2"]), "lined")
    keys = ("host", "path", "page_id", "k1", "k2")
    decided = cut(lined.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_decided, _DECIDED), "decided")
    inner = decided.filter("part is null").select("k1", "k2", "keep")
    edges = decided.filter("part is not null").groupBy().applyInArrow(_joined_edges, "k1 long, k2 long, keep array<int>")  # four rows a partition
    return plain.join(inner.unionAll(edges), ["k1", "k2"], "left").select("page_id", "url", "html", "keep").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
