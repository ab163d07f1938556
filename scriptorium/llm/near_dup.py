"""Near-duplicate documents: SetSketch registers, banding, likelihood estimate, exact verification.

Registers. Each shingle owns a sequence of points, one in each of M equal quantile intervals of the exponential
distribution (exponentially spaced, truncated), dealt over the registers by its own permutation. A register keeps the
smallest point it meets, as floor(OFFSET - log_B point) in one byte. Points of interval j + 1 exceed all of interval j,
so a document stops at the first interval that has filled its registers. Sketches merge by the larger byte.

Candidates. ROWS registers form a band, from the first ROWS * BANDS registers; documents with one band in common are
candidates (a pair at similarity 0.8 is missed with probability (1 - 0.8**ROWS)**BANDS, 6e-5). Equal shingle sets are
one class beforehand. In a bucket, all classes first meet one seeded center, another in each bucket, so a class meets as
many centers as it has buckets. What is still apart is then joined within the bucket, under a condition inside the join:
exact for sets of up to EXACT shingles, by fingerprints for larger ones. So a group of n near copies costs about n
pairs, and no link between components is lost. Buckets with more than HOT classes still apart, say half-alike pages of
one template, are not joined whole: their classes meet by a shingle among the rarest of each (prefix filter), as two
sets at the threshold must share one of these.

Verification. Pairs pass a joint maximum-likelihood estimate over registers, then an exact comparison of full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordIds, ascii_words, cut, maybe_members, membership, tidied
from .graph import connected_components

ROWS, BANDS = 6, 32
REGISTERS = 384
#: A prime just above REGISTERS: start and stride modulo it are a permutation.
PRIME = 389
BASE, OFFSET = 1.1, 24.0
#: A pair goes on if its estimate is within so much of the threshold: 4.5 standard errors of each estimate at 0.8.
FINGERPRINT_SLACK, SLACK = 0.11, 0.09
#: Sets of up to so many shingles travel with the bucket join and are compared there.
EXACT = 256
#: Classes that a bucket may pair.
HOT = 8192
#: 64-bit words of a fingerprint: two mixed bits a register.
FINGERPRINT = REGISTERS * 2 // 64
_P1, _P2, _P3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def shingle_set(ids: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; a shorter text is one shingle; no words, none."""
    n = len(ids)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(k, n)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = _mix(h * _P1 + ids[j : n - width + 1 + j])
    return np.unique(h)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, REGISTERS) bytes of the sets; an empty set has zeros only."""
    docs = len(sets)
    lowest = np.full(docs * PRIME, np.inf)
    h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(docs), [len(s) for s in sets])
    register = (h % np.uint64(PRIME)).astype(np.int64)
    stride = 1 + (_mix(h + _P1) % np.uint64(PRIME - 1)).astype(np.int64)
    for j in range(PRIME):
        if not len(h):
            break
        u = (_mix(h + np.uint64((j + 2) * int(_P2) % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(lowest, doc * PRIME + register, (j + u) / PRIME)
        unfilled = np.isinf(lowest.reshape(docs, PRIME)).any(1)
        live = unfilled[doc]
        h, doc, stride = h[live], doc[live], stride[live]
        register = (register[live] + stride) % PRIME
    with np.errstate(divide="ignore"):
        point = -np.log1p(-np.minimum(lowest, 1 - 1e-16))
        value = np.floor(OFFSET - np.log(np.maximum(point, 1e-300)) / np.log(BASE))
    value = np.clip(value, 0, 255).astype(np.uint8).reshape(docs, PRIME)[:, :REGISTERS]
    value[[len(s) == 0 for s in sets]] = 0
    return np.ascontiguousarray(value)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(documents, BANDS): the register bytes of each band, with the band's number."""
    out = np.zeros((len(regs), BANDS, 8), np.uint8)
    out[:, :, :ROWS] = regs[:, : ROWS * BANDS].reshape(len(regs), BANDS, ROWS)
    out[:, :, ROWS] = np.arange(BANDS)
    return out.view(np.int64).reshape(len(regs), BANDS)


def fingerprints(regs: np.ndarray) -> np.ndarray:
    """(documents, FINGERPRINT): two mixed bits of each register; unequal registers agree in both a quarter of the time."""
    mixed = _mix(regs.astype(np.uint64) + np.arange(REGISTERS, dtype=np.uint64) * _P1)
    two = np.stack([mixed & np.uint64(1), mixed >> np.uint64(1) & np.uint64(1)], axis=2).astype(np.uint8)
    return np.packbits(two.reshape(len(regs), -1), axis=1).view(np.int64)


_GRID = np.linspace(0.0, 1.0, 101)


def likelihood_jaccard(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood Jaccard of register rows x and y of sets with nx and ny elements."""
    above, below = (x > y).sum(1), (x < y).sum(1)
    same = x.shape[1] - above - below
    u, v = nx / (nx + ny), ny / (nx + ny)
    most = np.minimum(u / v, v / u)

    def tail(z):
        return -np.log1p(-np.clip(z, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    best, at = np.full(len(x), -np.inf), np.zeros(len(x))
    for j in _GRID:
        up, down = np.clip(tail(u - v * j), 1e-9, 1), np.clip(tail(v - u * j), 1e-9, 1)
        ll = above * np.log(up) + below * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-9, 1))
        ll[j > most + 1e-9] = -np.inf
        better = ll > best
        best[better], at[better] = ll[better], j
    return at


_SKETCH = "doc_id long, version long, nid long, proof long, n long, keys array<bigint>, bits array<bigint>, regs binary"


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32)), pa.array(rows.reshape(-1)))


def _sketched(k: int):
    def run(batches):
        ids = WordIds()
        for batch in batches:
            docs, texts, versions = batch.column(0), batch.column(1), batch.column(2)
            for lo in range(0, batch.num_rows, 1024):
                part = texts.slice(lo, 1024).to_pylist()
                sets = [shingle_set(ids.array(ascii_words(t)), k) for t in part]
                regs = registers(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.slice(lo, 1024).cast(pa.int64()),
                        versions.slice(lo, 1024),
                        pa.array([_class(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([_proof(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        _lists(band_keys(regs)),
                        _lists(fingerprints(regs)),
                        pa.array([r.tobytes() for r in regs], pa.binary()),
                    ],
                    ["doc_id", "version", "nid", "proof", "n", "keys", "bits", "regs"],
                )

    return run


def _sets(k: int, shared, moved: frozenset):
    """(nid, shingles, exact) of the documents that a broadcast bitmap of doc_ids lets pass."""

    def run(batches):
        ids = WordIds()
        for batch in batches:
            own = batch.column(0).fill_null(0).to_numpy()
            batch = batch.filter(pa.array(maybe_members(shared.value, own)))
            for lo in range(0, batch.num_rows, 512):
                sets = [shingle_set(ids.array(ascii_words(t)), k) for t in batch.column(1).slice(lo, 512).to_pylist()]
                sets = [s for s in sets if len(s)]
                exact = [s.view(np.int64) if len(s) <= EXACT else None for s in sets]
                names = [(_class(s), _proof(s)) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([_moved(*x) if x in moved else x[0] for x in names], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(exact, pa.list_(pa.int64()))], ["nid", "shingles", "exact"])

    return run


def _class(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def _proof(s: np.ndarray) -> int:
    """A second hash: sets of one class and proof are equal by 128 bits."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), 1) - 2**63


def _moved(nid: int, proof: int) -> int:
    """The class of a set whose first hash another set has too."""
    return xxhash.xxh3_64_intdigest(f"{nid} {proof}") - 2**63


def _likely(threshold: float):
    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("xr", "yr"))
            j = likelihood_jaccard(x, y, batch.column("xn").to_numpy().astype(float), batch.column("yn").to_numpy().astype(float)) if len(x) else np.empty(0)
            yield batch.select(["x", "y"]).filter(pa.array(j >= threshold - SLACK))

    return run


def _verified(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("xs"), batch.column("ys"), strict=True):
                s, t = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(den * both >= num * (len(s) + len(t) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _plausible(threshold: float) -> F.Column:
    """Of aliased classes p and q: sizes allow the threshold, and fingerprints agree often enough."""
    def word(i: int) -> F.Column:
        x = F.col("p.bits")[i].bitwiseXOR(F.col("q.bits")[i])
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    differ = sum((word(i) for i in range(1, FINGERPRINT)), word(0))
    sizes = (F.col("p.n") >= threshold * F.col("q.n") - 1e-9) & (F.col("q.n") >= threshold * F.col("p.n") - 1e-9)
    return sizes & (differ <= int(REGISTERS * 0.75 * (1 - threshold + FINGERPRINT_SLACK)))


def components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs(doc_id, text, ...): doc_id, version (the text's hash), n_shingles, least: the smallest (doc_id, version) reachable over links.

    Links hold between documents with 100 * |A & B| >= percent * |A | B| of their k-word shingle sets (64-bit hashes;
    a collision inside a pair of 100,000 shingles has probability below 1e-9). Null and empty texts have no shingles
    and link with nothing: their least is their own. A null doc_id counts as larger than all others.
    """
    threshold = percent / 100
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    sketch = cut(plain.mapInArrow(tidied(_sketched(k)), _SKETCH), "sketch")
    sketch, classes, moved = _told_apart(sketch)
    rows = classes.select("nid", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi")).filter("lo < hi").select("key")
    small = classes.select("nid", "n", "bits")
    members = cut(rows.join(shared, "key").withColumn("label", F.col("nid")), "members")
    sets = cut(_set_table(plain, classes, members.select("nid").distinct(), k, moved), "sets")
    star = cut(_star_pairs(members, small, threshold), "star")
    edges = cut(_links(star, classes, sets, percent), "links")
    roots = connected_components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    pairs = cut(_all_pairs(_apart(members, roots), small, sets, percent).join(star, ["x", "y"], "left_anti"), "pairs")
    edges = cut(edges.unionAll(_links(pairs, classes, sets, percent)), "links")
    roots = connected_components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))

    by_root = sketch.select("doc_id", "version", "n", "nid").join(roots.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    by_root = cut(by_root.select("doc_id", "version", "n", "root"), "rooted")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version")
    least = by_root.filter("root is not null").groupBy("root").agg(F.min(own).alias("least"))
    out = by_root.join(least, "root", "left")
    return out.select("doc_id", "version", F.col("n").alias("n_shingles"), F.coalesce("least", own).alias("least"))


def _classes(sketch: DataFrame) -> DataFrame:
    return sketch.filter("nid is not null").groupBy("nid").agg(F.min("doc_id").alias("doc_id"), F.min("proof").alias("low"), F.max("proof").alias("high"), *(F.first(c).alias(c) for c in ("n", "keys", "bits", "regs")))


def _told_apart(sketch: DataFrame) -> tuple[DataFrame, DataFrame, frozenset]:
    """sketch and its classes, where different sets with one first hash have got classes of their own; and those sets."""
    classes = cut(_classes(sketch), "classes")
    clash = classes.filter("low < high").select("nid", "low").collect()  # a handful at any number of documents, by the birthday bound
    if not clash:
        return sketch, classes, frozenset()
    twice = sketch.filter(F.col("nid").isin([r.nid for r in clash])).select("nid", "proof").distinct().collect()
    moved = frozenset((r.nid, r.proof) for r in twice) - {(r.nid, r.low) for r in clash}
    nid = F.col("nid")
    for old, proof in sorted(moved):
        nid = F.when((F.col("nid") == old) & (F.col("proof") == proof), F.lit(_moved(old, proof))).otherwise(nid)
    sketch = cut(sketch.withColumn("nid", nid), "sketch")
    return sketch, cut(_classes(sketch), "classes"), moved


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs(doc_id, text, ...): doc_id, n_shingles, component_id, kept, by components().

    component_id is the smallest doc_id reachable over links, kept says doc_id = component_id (null-safe). Repeated
    rows come back repeated, in one component; where a component has no doc_id but null, component_id is null. Other
    columns of docs are ignored. An empty table gives an empty result.
    """
    least = F.col("least.doc_id")
    return components(docs, k, percent).select("doc_id", "n_shingles", least.alias("component_id"), F.col("doc_id").eqNullSafe(least).alias("kept"))


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members(key, nid) of the buckets that hold several components, with their labels and the bucket's size."""
    labelled = members.select("key", "nid").join(roots.withColumnRenamed("node", "nid"), "nid", "left").select("key", "nid", F.coalesce("root", "nid").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).filter("lo < hi").select("key", "size")
    return labelled.join(mixed, "key")


def _star_pairs(members: DataFrame, small: DataFrame, threshold: float) -> DataFrame:
    """Plausible pairs (x, y), x < y, of each bucket's seeded center and its other members."""
    centers = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "nid").alias("draw"), "nid")).getField("nid").alias("center"))
    pairs = members.join(centers, "key").filter("nid <> center").select(F.least("center", "nid").alias("x"), F.greatest("center", "nid").alias("y")).distinct()
    side = lambda c, to: small.select(F.col("nid").alias(c), F.struct("n", "bits").alias(to))
    return pairs.join(side("x", "p"), "x").join(side("y", "q"), "y").filter(_plausible(threshold)).select("x", "y")


def _all_pairs(members: DataFrame, small: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs (x, y), x < y, of members of different components within a bucket; small sets are compared exactly."""
    members = cut(members, "apart")
    cold = members.filter(F.col("size") <= HOT)
    full = cut(cold.join(small, "nid").join(sets.select("nid", "exact"), "nid", "left"), "full")
    both = F.size(F.array_intersect("p.exact", "q.exact"))
    alike = F.col("p.exact").isNull() | F.col("q.exact").isNull() | ((100 + percent) * both >= percent * (F.col("p.n") + F.col("q.n")))
    same = (F.col("p.key") == F.col("q.key")) & (F.col("p.label") < F.col("q.label")) & _plausible(percent / 100) & alike
    pairs = full.alias("p").join(full.alias("q"), same).select(F.least("p.nid", "q.nid").alias("x"), F.greatest("p.nid", "q.nid").alias("y"))
    hot = members.filter(F.col("size") > HOT).select("nid", "label").distinct()
    return pairs.distinct() if hot.isEmpty() else pairs.unionAll(_rare_pairs(hot, small, sets, percent)).distinct()


def _shingles(batches):
    for batch in batches:
        own = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
        n = [len(x) for x in own]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in ("nid", "label")] + [pa.array(np.concatenate(own)), pa.array(np.repeat(n, n).astype(np.int64))], ["nid", "label", "shingle", "n"])


def _rare_pairs(hot: DataFrame, small: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of hot(nid, label) of different components that share a shingle among the rarest of each."""
    rows = cut(hot.join(sets.select("nid", "shingles"), "nid").mapInArrow(_shingles, "nid long, label long, shingle long, n long"), "shingles")
    often = rows.groupBy("shingle").agg(F.count("*").alias("often"))
    ranked = rows.join(often, "shingle").withColumn("rank", F.row_number().over(Window.partitionBy("nid").orderBy("often", "shingle")))
    # sets of n shingles that reach the threshold share percent * n / 100 of them, so one of the n - that + 1 first in any order
    first = ranked.filter((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & (F.col("often") > 1))
    full = cut(first.select("nid", "label", "shingle").join(small, "nid"), "rarest")
    same = (F.col("p.shingle") == F.col("q.shingle")) & (F.col("p.label") < F.col("q.label")) & _plausible(percent / 100)
    return full.alias("p").join(full.alias("q"), same).select(F.least("p.nid", "q.nid").alias("x"), F.greatest("p.nid", "q.nid").alias("y"))


def _set_table(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int, moved: frozenset) -> DataFrame:
    """(nid, shingles, exact): full sets of the wanted classes, read again from one document each."""
    first = wanted.join(classes.select("nid", "doc_id"), "nid").select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"))
    some = docs.sparkSession.sparkContext.broadcast(membership(first, "doc_id"))
    return docs.mapInArrow(tidied(_sets(k, some, moved)), "nid long, shingles binary, exact array<bigint>").join(wanted, "nid", "left_semi").dropDuplicates(["nid"])


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of classes that pass the likelihood estimate and the exact comparison."""
    side = lambda c: classes.select(F.col("nid").alias(c), F.col("n").alias(f"{c}n"), F.col("regs").alias(f"{c}r"))
    likely = cut(pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(tidied(_likely(percent / 100)), "x long, y long"), "likely")
    full = lambda c: sets.select(F.col("nid").alias(c), F.col("shingles").alias(f"{c}s"))
    return likely.join(full("x"), "x").join(full("y"), "y").mapInArrow(tidied(_verified(percent, 100)), "x long, y long")
