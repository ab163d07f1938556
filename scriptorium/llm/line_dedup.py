"""Near-equal lines across documents: segment-partition edit join.

A line of n code points tolerates n // PER_EDIT edits, MOST at most; of two lines the shorter one's number holds. For a
threshold t a line is cut into t + 1 segments. If two lines are within t edits, one of the shorter line's segments
stands unchanged in the longer one, near its place. Every line indexes its own segments by (length, segment number,
segment) and probes the indexes of its length and of lengths up to MOST less, at the few offsets that alignment allows
(multi-match-aware windows). Lines under one key are candidates; banded bit-parallel edit distance verifies them.

A key that very many lines share is split: what is left of each line without the shared segment must lie within the
same threshold, so it is cut into segments again, and so on, until few lines share a key or next to nothing is left,
where lines with a string in common after t deletions are candidates. So the work grows with the lines, however many
share a beginning.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, maybe_members, membership, partitions, tidied
from .graph import connected_components

#: Code points of a line for each tolerated edit, and edits at most; shorter lines are compared exactly.
PER_EDIT, MOST = 10, 2
#: Characters whose keys are made at once, and characters of the corpus for each bucket of keys.
KEY_CHARS, BUCKET_CHARS = 500_000, 2_000_000
#: Documents of a batch that are taken apart at once.
SLICE = 1024
#: Lines of different classes that a key may hold before it is split.
HOT = 1024
#: A rest of so many code points for each of t + 1 segments is not cut again.
SHORT_REST = 4


def tolerated(length: int, per_edit: int = PER_EDIT, most: int = MOST) -> int:
    return min(most, length // per_edit)


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line, as even as can be, the longer ones last."""
    base, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, threshold: int) -> list[tuple[int, int, int]]:
    """(segment number, start, size) of the substrings of a line that can equal a segment of a line of length other."""
    delta, out = length - other, []
    for i, (at, size) in enumerate(segments(other, threshold + 1)):
        low = max(at - i, at + delta - (threshold - i), 0)
        high = min(at + i, at + delta + (threshold - i), length - size)
        out += [(i, p, size) for p in range(low, high + 1)]
    return out


@lru_cache(maxsize=50_000)
def spots(length: int, per_edit: int, most: int) -> np.ndarray:
    """(indexed length, segment number, start, size, threshold) of every key of a line, one a column."""
    found = set()
    for other in range(max(1, length - most), length + 1):
        t = tolerated(other, per_edit, most)
        if t and length - other <= t:
            found |= {(other, i, at, size, t) for i, at, size in probes(length, other, t)}
    own = tolerated(length, per_edit, most)
    if own:
        found |= {(length, i, at, size, own) for i, (at, size) in enumerate(segments(length, own + 1))}
    return np.array(sorted(found), np.int64).reshape(-1, 5).T


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_ODD = 0x9FB21C651E98DF25
_INVERSE = pow(_ODD, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def line_keys(lines: list[str], per_edit: int = PER_EDIT, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all lines and the line of each: hashes of (length, segment number, segment), by one sum over code points."""
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes) - sizes
    up, down = _powers(1 << int(sizes.max()).bit_length())
    place = np.arange(len(text)) - np.repeat(starts, sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix((text.astype(np.uint64) + np.uint64(1)) * _M1) * up[place], dtype=np.uint64)])
    lengths, which = np.unique(sizes, return_inverse=True)
    tables = [spots(n, per_edit, most) for n in lengths.tolist()]
    counts = np.fromiter((t.shape[1] for t in tables), np.int64, len(tables))
    m, i, at, size, _ = np.concatenate(tables, axis=1)
    per = counts[which]
    owners = np.repeat(np.arange(len(lines)), per)
    spot = np.arange(len(owners)) + np.repeat((np.cumsum(counts) - counts)[which] - (np.cumsum(per) - per), per)
    at, first = at[spot], starts[owners]
    h = (sums[first + at + size[spot]] - sums[first + at]) * down[at]
    return _mix((h + (m * 8 + i).astype(np.uint64)[spot] * _M1) * _M2).view(np.int64), owners


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is at most k: equal ends stripped, then bit-parallel over a diagonal band."""
    if abs(len(a) - len(b)) > k:
        return False
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:  # longest common prefix by halving
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    a, b = a[lo:], b[lo:]
    while a and b and a[-1] == b[-1]:
        step = 1
        while a[-2 * step :] == b[-2 * step :] and 2 * step <= min(len(a), len(b)):
            step *= 2
        a, b = a[:-step], b[:-step]
    return _banded(a, b, k)


def _banded(a: str, b: str, k: int) -> bool:
    """Bit-parallel edit distance (Myers 1999, banded as by Hyyro 2003): a window of 2k + 1 rows of a slides along b."""
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) <= k
    band, top = (1 << (2 * k + 1)) - 1, 1 << (2 * k)
    seen: dict[str, tuple[int, int]] = {}  # character -> (column, rows of the window at that column)
    for row in range(1, min(k, m) + 1):
        seen[a[row - 1]] = (0, seen.get(a[row - 1], (0, 0))[1] | 1 << (row + k))
    vp, vn, score = band & ~((1 << k) - 1), 0, min(k, m)
    for j, c in enumerate(b, 1):
        row = j + k
        if row <= m:
            at, rows = seen.get(a[row - 1], (j, 0))
            seen[a[row - 1]] = (j, rows >> (j - at) | top)
        at, rows = seen.get(c, (j, 0))
        eq = rows >> (j - at)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & band
        hp, hn = (vn | ~(d0 | vp)) & band, d0 & vp
        if row <= m:
            score += not d0 & top
        else:
            last = 1 << (m - j + k)
            score += bool(hp & last) - bool(hn & last)
        vp, vn = (hn | ~(d0 >> 1 | hp)) & band, d0 >> 1 & hp
        if score - (n - j) > k:
            return False
    return score <= k


def line_id(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - 2**63


def parities(lines: list[str]) -> np.ndarray:
    """Of each line, 64 parities of character counts: an edit flips two of them at most."""
    if not lines:
        return np.zeros(0, np.int64)
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    bits = np.uint64(1) << (text * np.uint64(0x9E3779B1) >> np.uint64(7) & np.uint64(63))
    return np.bitwise_xor.reduceat(bits, np.cumsum(sizes) - sizes).view(np.int64)


def _slices(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE):
            yield batch.slice(lo, SLICE)


def _documents(batches):
    for batch in _slices(batches):
        ids = [None if t is None else [line_id(s) if (s := line.strip()) else None for line in t.split("\n")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "version", "lines"])


def _distinct(batch, shortest: int) -> list[str]:
    return list({s for t in batch.column(1).to_pylist() if t for line in t.split("\n") if len(s := line.strip()) >= shortest})


def _keyed(batch, per_edit: int, most: int):
    """(lines, their ids, keys, line of each key) of a batch, some characters at a time."""
    lines, own, held = _distinct(batch, per_edit), [], 0
    for i, line in enumerate(lines, 1):
        own.append(line)
        held += len(line)
        if held >= KEY_CHARS or i == len(lines):
            yield own, np.fromiter(map(line_id, own), np.int64, len(own)), *line_keys(own, per_edit, most)
            own, held = [], 0


def _ends(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key, in order: its least and greatest id."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return (keys[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)) if len(first) else (keys, ids, ids)


def _keys(per_edit: int, most: int, buckets: int):
    """Keys in buckets by their range, with one or two lines each: enough to tell whether different lines share one."""

    def run(batches):
        for batch in _slices(batches):
            parts = [(keys, ids[owners]) for _, ids, keys, owners in _keyed(batch, per_edit, most)]
            if not parts:
                continue
            keys, low, high = _ends(*map(np.concatenate, zip(*parts, strict=True)))
            two = low != high
            keys, ids = np.concatenate([keys, keys[two]]), np.concatenate([low, high[two]])
            bucket = (keys.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            cut_at = lambda x: [p.tobytes() for p in np.split(x[order], first[1:])]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(cut_at(keys), pa.binary()), pa.array(cut_at(ids), pa.binary())], ["bucket", "keys", "lids"])

    return run


def _shared_keys(table: pa.Table) -> pa.Table:
    keys, ids = (np.concatenate([np.frombuffer(c.as_buffer(), np.int64) for c in table.column(n)]) for n in ("keys", "lids"))
    keys, low, high = _ends(keys, ids)
    return pa.table({"key": pa.array(keys[low != high])})


def _candidates(per_edit: int, most: int, shared):
    """Lines with keys that a broadcast bitmap lets pass, and those keys."""

    def run(batches):
        for batch in _slices(batches):
            for lines, ids, keys, owners in _keyed(batch, per_edit, most):
                keep = maybe_members(shared.value, keys)
                keys, owners = keys[keep], owners[keep]
                order = np.argsort(owners, kind="stable")
                found, first = np.unique(owners[order], return_index=True)
                own = [lines[i] for i in found.tolist()]
                offsets = pa.array(np.append(first, len(order)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[found]), pa.array(own, pa.string()), pa.array([len(s) for s in own], pa.int32()), pa.array(parities(own)), pa.ListArray.from_arrays(offsets, pa.array(keys[order]))],
                    ["lid", "line", "size", "parity", "keys"],
                )

    return run


def _near(batches):
    for batch in batches:
        keep = [within(a, b, t) for a, b, t in zip(batch.column("xl").to_pylist(), batch.column("yl").to_pylist(), batch.column("t").to_pylist(), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


_RESTS = "key long, lid long, label long, rest string, t int"


def _first_rests(per_edit: int, most: int):
    """Of lines under a key: what is left of them without the segment that the key stands for."""

    def run(batches):
        for batch in batches:
            out = []
            for key, lid, label, line in zip(*(batch.column(n).to_pylist() for n in ("key", "lid", "label", "line")), strict=True):
                own = spots(len(line), per_edit, most)
                keys, _ = line_keys([line], per_edit, most)
                for j in np.flatnonzero(keys == key).tolist():
                    _, _, at, size, t = own[:, j].tolist()
                    out.append((key, lid, label, f"{line[:at]}\n{line[at + size :]}", t))
            yield _rest_rows(out)

    return run


def _rest_rows(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32()))], ["key", "lid", "label", "rest", "t"])


def rests(rest: str, t: int) -> set[tuple[str, str | None]]:
    """(what two rests within t edits have one of in common, what is then left or None): segments, or for short rests strings after t deletions."""
    n, out = len(rest), set()
    if n > SHORT_REST * (t + 1):
        places = {(n, i, at, size) for i, (at, size) in enumerate(segments(n, t + 1))}
        for other in range(n - t, n + 1):
            places |= {(other, *p) for p in probes(n, other, t)}
        out = {(f"{m} {i} {rest[at : at + size]}", f"{rest[:at]}\n{rest[at + size :]}") for m, i, at, size in places}
    if n <= SHORT_REST * (t + 1) + t:  # those just longer meet short ones too
        out |= {("".join(c for i, c in enumerate(rest) if i not in gone), None) for d in range(min(t, n) + 1) for gone in map(set, combinations(range(n), d))}
    return out


def _more_rests(batches):
    for batch in batches:
        out = []
        for key, lid, label, rest, t in zip(*(batch.column(n).to_pylist() for n in ("key", "lid", "label", "rest", "t")), strict=True):
            out += [(xxhash.xxh3_64_intdigest(f"{key} {left is None} {name}".encode("utf-8", "surrogatepass")) - 2**63, lid, label, left, t) for name, left in rests(rest, t)]
        yield _rest_rows(out)


def _common_ends(batches):
    """(key, front, back): code points that all rests under a key begin and end with, from the least and greatest of them."""

    def same(a: str, b: str) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for batch in batches:
        front = [same(a, b) for a, b in zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist(), strict=True)]
        back = [min(same(a, b), n - f) for a, b, n, f in zip(batch.column("rlo").to_pylist(), batch.column("rhi").to_pylist(), batch.column("least").to_pylist(), front, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(front, pa.int32()), pa.array(back, pa.int32())], ["key", "front", "back"])


def _stripped(rows: DataFrame) -> DataFrame:
    """Rests without what all under their key begin and end with, which leaves edit distances as they are."""
    back = F.reverse("rest")
    ends = rows.groupBy("key").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.min(back).alias("rlo"), F.max(back).alias("rhi"), F.min(F.length("rest")).alias("least"))
    ends = ends.mapInArrow(_common_ends, "key long, front int, back int")
    return rows.join(ends, "key").select("key", "lid", "label", F.substring("rest", F.col("front") + 1, F.length("rest") - F.col("front") - F.col("back")).alias("rest"), "t")


#: Lines of a key whose pairs are filtered at once.
SQUARE = 1024


def group_links(lids: np.ndarray, labels: np.ndarray, lines: list[str], sizes: np.ndarray, parities_: np.ndarray, per_edit: int, most: int) -> list[tuple[int, int]]:
    """Links between the lines of a key whose labels differ: sizes and parities first, then banded edit distance."""
    out = []
    for lo in range(0, len(lids), SQUARE):
        for up in range(lo, len(lids), SQUARE):
            i, j = slice(lo, lo + SQUARE), slice(up, up + SQUARE)
            t = np.minimum(np.minimum(sizes[i, None], sizes[None, j]) // per_edit, most)
            ok = (np.abs(sizes[i, None] - sizes[None, j]) <= t) & (labels[i, None] != labels[None, j])
            ok &= np.bitwise_count(parities_[i, None] ^ parities_[None, j]) <= 2 * t
            for x, y in np.argwhere(np.triu(ok, 1) if lo == up else ok).tolist():
                if within(lines[lo + x], lines[up + y], int(t[x, y])):
                    out.append((int(lids[lo + x]), int(lids[up + y])))
    return out


def _linked(per_edit: int, most: int):
    """Links of rows that come sorted by key."""

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            keys = held.column("key").to_numpy()
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield made(held.slice(0, last))
            held = held.slice(last)
        if held is not None:
            yield made(held)

    def made(rows):
        out = []
        if rows.num_rows:
            keys, lids, labels, sizes, marks = (rows.column(n).to_numpy() for n in ("key", "lid", "label", "size", "parity"))
            lines = rows.column("line").to_pylist()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
                if hi - lo > 1:
                    out += group_links(lids[lo:hi], labels[lo:hi], lines[lo:hi], sizes[lo:hi].astype(np.int64), marks[lo:hi], per_edit, most)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(2)], ["a", "b"])

    return run


def _links_in_keys(rows: DataFrame, lines: DataFrame, per_edit: int, most: int) -> DataFrame:
    """Links (a, b) between lines under a key whose labels differ."""
    full = rows.select("key", "lid", "label").distinct().join(lines.select("lid", "line", "size", "parity"), "lid")
    return full.repartition("key").sortWithinPartitions("key").mapInArrow(tidied(_linked(per_edit, most)), "a long, b long")


def _split(rows: DataFrame) -> DataFrame:
    """The rows under keys of several labels, with the number of rows of their key."""
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("key", "n")
    return rows.join(mixed, "key")


def _within_keys(apart: DataFrame, lines: DataFrame, per_edit: int, most: int) -> DataFrame:
    """Links under the keys of apart(key, lid, label, n); keys of more than HOT rows are split by what is left of their lines."""
    found = _links_in_keys(apart.filter(F.col("n") <= HOT), lines, per_edit, most)
    hot = apart.filter(F.col("n") > HOT)
    if hot.isEmpty():
        return found
    rows = hot.select("key", "lid", "label").join(lines.select("lid", "line"), "lid").mapInArrow(_first_rests(per_edit, most), _RESTS)
    while True:
        level = cut(_split(_stripped(cut(rows, "rests")).mapInArrow(_more_rests, _RESTS).distinct()), "rests")
        # a rest of a few characters is not cut again: its key has but a bounded number of texts
        few = (F.col("n") <= HOT) | F.col("rest").isNull()
        found = found.unionAll(_links_in_keys(level.filter(few), lines, per_edit, most))
        rows = level.filter(~few).drop("n")
        if rows.isEmpty():
            return found


def line_classes(docs: DataFrame, per_edit: int = PER_EDIT, most: int = MOST) -> DataFrame:
    """(node, root): stripped lines, by id, that reach another line by links of tolerated edits."""
    plain = docs.select("doc_id", "text")
    chars = plain.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = max(partitions(docs.sparkSession), -(-chars // BUCKET_CHARS))
    rows = plain.mapInArrow(tidied(_keys(per_edit, most, buckets)), "bucket long, keys binary, lids binary")
    shared = cut(rows.groupBy("bucket").applyInArrow(_shared_keys, "key long"), "shared")
    some = docs.sparkSession.sparkContext.broadcast(membership(shared, "key"))
    lines = cut(plain.mapInArrow(tidied(_candidates(per_edit, most, some)), "lid long, line string, size int, parity long, keys array<bigint>").dropDuplicates(["lid"]), "lines")
    held = lines.select("lid", F.explode("keys").alias("key")).distinct().join(shared, "key", "left_semi")
    centers = held.groupBy("key").agg(F.min("lid").alias("center"))
    members = cut(held.join(centers, "key"), "members")
    facts = lines.select("lid", "size", "parity")

    def threshold(p: str, q: str):
        return F.least(F.floor(F.least(f"{p}.size", f"{q}.size") / per_edit), F.lit(most)).cast("int")

    def plausible(p: str, q: str):
        return (F.abs(F.col(f"{p}.size") - F.col(f"{q}.size")) <= threshold(p, q)) & (F.bit_count(F.col(f"{p}.parity").bitwiseXOR(F.col(f"{q}.parity"))) <= 2 * threshold(p, q))

    def links(pairs: DataFrame) -> DataFrame:
        side = lambda c: lines.select(F.col("lid").alias(c), F.struct("line", "size").alias(f"_{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        return both.select("a", "b", F.col("_a.line").alias("xl"), F.col("_b.line").alias("yl"), threshold("_a", "_b").alias("t")).mapInArrow(tidied(_near), "a long, b long")

    star = members.filter("lid <> center").select(F.col("center").alias("a"), F.col("lid").alias("b")).distinct()
    ends = lambda c, to: facts.select(F.col("lid").alias(c), F.struct("size", "parity").alias(to))
    star = cut(star.join(ends("a", "p"), "a").join(ends("b", "q"), "b").filter(plausible("p", "q")).select("a", "b"), "star")
    edges = cut(links(star), "links")
    roots = connected_components(edges)

    labelled = members.join(roots.withColumnRenamed("node", "lid"), "lid", "left").select("key", "lid", F.coalesce("root", "lid").alias("label"))
    apart = cut(_split(labelled), "apart")
    return connected_components(cut(edges.unionAll(_within_keys(apart, lines, per_edit, most)), "links"))


def duplicate_lines(docs: DataFrame, per_edit: int = PER_EDIT, most: int = MOST) -> DataFrame:
    """(doc_id, version, n_lines, n_removed, removed): one row per distinct (doc_id, text); version is the text's hash.

    Lines are split at newlines and stripped of surrounding white space; blank lines are never removed. Of each class
    of lines, equal or linked by tolerated edits (lines under per_edit code points: equal), the first by
    (doc_id, line number) stays and all others are removed: removed holds their numbers from 0, sorted. A null doc_id
    stands after all others. Null and empty texts have no removed line; repeated rows count as one document; other columns are
    ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("version"))
    listed = cut(docs.mapInArrow(tidied(_documents), "doc_id long, version long, lines array<bigint>").dropDuplicates(["doc_id", "version"]), "listed")
    spots = listed.select("doc_id", "version", F.posexplode("lines").alias("pos", "lid")).filter("lid is not null")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos", "version")
    first = spots.groupBy("lid").agg(F.min(place).alias("place"))
    roots = line_classes(docs, per_edit, most)
    grouped = cut(first.join(roots.withColumnRenamed("node", "lid"), "lid", "left").select("lid", F.coalesce("root", "lid").alias("root"), "place"), "first")
    least = grouped.groupBy("root").agg(F.min("place").alias("place"))
    keepers = grouped.select("lid", "root").join(least, "root").select("lid", "place")
    dropped = spots.join(keepers, "lid").filter(place != F.col("place"))
    gone = dropped.groupBy("doc_id", "version").agg(F.array_sort(F.collect_list("pos")).alias("removed"))
    out = listed.alias("l").join(gone.alias("g"), F.col("l.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("l.version") == F.col("g.version")), "left")
    removed = F.coalesce("g.removed", F.array().cast("array<int>"))
    return out.select("l.doc_id", "l.version", F.coalesce(F.size("l.lines"), F.lit(0)).cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def _rebuilt(batches):
    for batch in batches:
        texts = []
        for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True):
            if text and removed:
                gone = set(removed)
                left = [line for i, line in enumerate(text.split("\n")) if i not in gone]
                text = "\n".join(left) if any(line.strip() for line in left) else None
            texts.append((text, not removed or text is not None))
        keep = pa.array([k for _, k in texts], pa.bool_())
        at = batch.schema.get_field_index("text")
        batch = batch.set_column(at, "text", pa.array([t for t, _ in texts], pa.string()))
        at = batch.schema.get_field_index("n_chars")
        sizes = [len(t) if t is not None and r else n for (t, _), r, n in zip(texts, batch.column("removed").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
        batch = batch.set_column(at, "n_chars", pa.array(sizes, pa.int64()))
        yield batch.select([c for c in batch.schema.names if c != "removed"]).filter(keep)


def without_duplicate_lines(docs: DataFrame, per_edit: int = PER_EDIT, most: int = MOST) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) without repeated lines; documents left with no text at all go."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    marked = duplicate_lines(docs, per_edit, most).filter("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "removed")
    rows = docs.select(*columns).withColumn("_v", F.xxhash64("text"))
    joined = rows.join(marked, rows.doc_id.eqNullSafe(F.col("_id")) & (F.col("_v") == F.col("_version")), "left").select(*columns, "removed")
    return joined.mapInArrow(tidied(_rebuilt), "doc_id long, text string, lang string, source string, n_chars long")
