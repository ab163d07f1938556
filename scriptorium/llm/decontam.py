"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed hashes the tokens at the ones of a fixed mask and ignores those at its zeros, so a substituted token hides only
some seeds. Seeds of every test window meet seeds of every training window; around a hit the aligned tokens are
compared, and a window with at most TOLERATED substitutions proves an overlap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Token positions that the masks look at; each has weight 6. By enumeration, any TOLERATED substitutions in 11, 12 or
#: WINDOW tokens leave a mask untouched at some place.
MASKS = ((0, 1, 2, 3, 7, 8), (0, 1, 3, 4, 5, 6), (0, 1, 5, 6, 8, 9))
#: Items of at least so many tokens are matched by masks.
SPAN = 11
#: Tokens of a verified window, and substitutions it may hold.
WINDOW, TOLERATED = 13, 2
#: Tokens of a window that may lie before a mask.
AHEAD = WINDOW - 1 - min(m[-1] for m in MASKS)
#: Items of SHORTEST to SPAN - 1 tokens are matched whole and exactly; shorter ones are no evidence.
SHORTEST = 5
#: Test seeds up to this many rows are broadcast, each of which holds REACH tokens at most (220 bytes); beyond it, seeds are shuffled.
BROADCAST_SEEDS = 200_000
#: Tokens around a seed's place that a verified window can touch.
REACH = AHEAD + WINDOW


def tokens(text: Column) -> Column:
    """Hashes of the lower-case runs of letters and digits."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(array: str, at: str, positions: tuple[int, ...], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *(F.get(F.col(array), F.col(at) + p) for p in positions))


def _seeds(array: str, at: str, lengths: list[int]) -> Column:
    """Seeds at a position; null where the mask ends beyond the text."""
    room = F.size(array) - F.col(at)
    spaced = [F.when(room > m[-1], _seed(array, at, m, i)) for i, m in enumerate(MASKS)]
    whole = [F.when(room >= n, _seed(array, at, tuple(range(n)), 100 + n)) for n in lengths]
    return F.array(*spaced, *whole)


def _pair(array: str, at: str) -> Column:
    return F.xxhash64(F.get(F.col(array), F.col(at)), F.get(F.col(array), F.col(at) + 1))


def _around(array: str, at: str) -> list[Column]:
    """The tokens from AHEAD before a place to WINDOW - 1 after it, and which of them is the place."""
    return [F.slice(array, F.greatest(F.col(at) - AHEAD, F.lit(0)) + 1, F.least(F.col(at), F.lit(AHEAD)) + WINDOW), F.least(F.col(at), F.lit(AHEAD))]


def _item_seeds(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(item_id, size, iw, ip, seed): seeds of every place of the items, with the tokens around it only."""
    at = items.select("item_id", "it", F.posexplode("it").alias("at", "_"))
    size = F.size("it")
    window, place = _around("it", "at")
    kept = ["item_id", size.alias("size"), window.alias("iw"), place.alias("ip")]
    spaced = at.filter(size >= SPAN).select(*kept, F.explode(_seeds("it", "at", [])).alias("seed"))
    if lengths:
        whole = reduce(lambda c, n: c.when(size == n, _seed("it", "at", tuple(range(n)), 100 + n)), lengths, F.when(F.lit(False), F.lit(0).cast("long")))
        spaced = spaced.unionAll(at.filter((size < SPAN) & (F.col("at") == 0)).select(*kept, whole.alias("seed")))
    return spaced.filter("seed is not null").distinct()


def _overlap(array: str, at: str) -> Column:
    """Whether some WINDOW tokens of the item around the hit agree with the text but for TOLERATED ones."""
    same = [F.get(F.col(array), F.col(at) + o).eqNullSafe(F.get(F.col("iw"), F.col("ip") + o)) & F.get(F.col("iw"), F.col("ip") + o).isNotNull() for o in range(-AHEAD, WINDOW)]
    agree = [F.when((F.col("ip") + o >= 0) & (F.col(at) + o >= 0), s).otherwise(False).cast("int") for o, s in zip(range(-AHEAD, WINDOW), same, strict=True)]
    windows = [reduce(lambda a, b: a + b, agree[s : s + WINDOW]) for s in range(AHEAD + 1)]
    most, size = F.greatest(*windows), F.col("size")
    need = F.when(size < SPAN, size).otherwise(F.least(size, F.lit(WINDOW)) - TOLERATED)
    return most >= need


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, version, item_id), distinct: items of which a text holds a verified overlap; version is the text's hash.

    A benchmark of few seeds is broadcast and texts are read where they stand. Beyond that only places travel: pairs of
    tokens, then seeds, are joined by hash, and the tokens around a hit are read again from its text.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("it")).filter(F.size("it") >= SHORTEST)
    lengths = sorted(r[0] for r in items.filter(F.size("it") < SPAN).select(F.size("it")).distinct().collect())  # SPAN - SHORTEST values at most
    seeds = _item_seeds(items, lengths)
    # All masks look at positions 0 and 1, so a window is hashed only where the benchmark has that pair of tokens.
    pairs = items.select("it", F.posexplode("it").alias("at", "_")).select(_pair("it", "at").alias("pair")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), tokens(F.col("text")).alias("dt"))
    places = texts.select("doc_id", "version", "dt", F.posexplode("dt").alias("dp", "_")).withColumn("pair", _pair("dt", "dp"))
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        spots = places.join(F.broadcast(pairs), "pair", "left_semi")
        hashed = spots.select("doc_id", "version", "dt", "dp", F.explode(_seeds("dt", "dp", lengths)).alias("seed"))
        return hashed.join(F.broadcast(seeds), "seed").filter(_overlap("dt", "dp")).select("doc_id", "version", "item_id").distinct()
    spots = places.select("doc_id", "version", "pair", "dp").join(pairs, "pair", "left_semi")
    located = spots.groupBy("doc_id", "version").agg(F.collect_set("dp").alias("at")).alias("s")  # no more places than the text has tokens
    t = texts.dropDuplicates(["doc_id", "version"]).alias("t")
    again = t.join(located, F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("t.version") == F.col("s.version")))
    window, place = _around("dt", "dp")
    hashed = again.select("t.doc_id", "t.version", "dt", F.explode("at").alias("dp")).select("doc_id", "version", window.alias("dw"), place.alias("wp"), F.explode(_seeds("dt", "dp", lengths)).alias("seed"))
    return hashed.join(seeds, "seed").filter(_overlap("dw", "wp")).select("doc_id", "version", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs(doc_id, text) as doc_id, contaminated, n_items, items (sorted ids, comma-joined; null if none).

    Tokens are lower-case runs of letters and digits. A document is contaminated by an item if WINDOW consecutive item
    tokens stand in it with at most TOLERATED substitutions, wherever these fall (items of SPAN to WINDOW - 1 tokens:
    the whole item, as tolerant; SHORTEST to SPAN - 1: the whole item exactly; shorter: never). Null and empty texts are
    clean; null items match nothing; repeated rows are judged alike; other columns are ignored.
    """
    found = overlaps(docs, benchmark).groupBy("doc_id", "version").agg(F.count("*").alias("n"), F.concat_ws(",", F.transform(F.array_sort(F.collect_list("item_id")), lambda x: x.cast("string"))).alias("items"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version")).alias("d")
    f = found.alias("f")
    joined = rows.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.version") == F.col("f.version")), "left")
    return joined.select("d.doc_id", F.col("f.n").isNotNull().alias("contaminated"), F.coalesce("f.n", F.lit(0)).cast("long").alias("n_items"), F.col("f.items").alias("items"))


#: The definition itself: tokens that agree under one alignment, counted over any WINDOW places of the item.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dt AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d),
bt AS (SELECT item_id, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM b WHERE len(w) >= 5),
agree AS (SELECT doc_id, item_id, n, dt.p - bt.p AS shift, bt.p AS p FROM dt JOIN bt USING (t)),
many AS (SELECT * FROM agree QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= 5),
counted AS (SELECT doc_id, item_id, n, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS m FROM many),
found AS (SELECT DISTINCT doc_id, item_id FROM counted WHERE m >= CASE WHEN n < 11 THEN n ELSE least(n, 13) - 2 END),
per AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM found GROUP BY doc_id)
SELECT documents.doc_id, per.n IS NOT NULL AS contaminated, coalesce(per.n, 0)::BIGINT AS n_items, per.items FROM documents LEFT JOIN per ON documents.doc_id = per.doc_id
"""
