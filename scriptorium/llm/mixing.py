"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

A source's documents are laid end to end in seeded order within shards, which cuts each shard into blocks of BLOCK
words. Blocks are apportioned to sources, then to a source's shards, by highest quotients; a shard takes its quota of
blocks from a seeded start onwards, around its end, once more over if the quota asks for it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK = 8
#: Documents of a shard on average; a large source has many shards.
SHARD_DOCS = 20_000
#: No document is taken more often.
REPEATS = 2
SHARE, WEIGHTS = 1.5, (3, 1, 2)


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Integer seats by the highest quotients votes / (2 * seats + 1); ties go to the earlier entry."""
    votes = np.asarray(votes, float)
    if seats <= 0 or votes.sum() <= 0:
        return np.zeros(len(votes), np.int64)
    # Start one below the proportional share of everyone, which highest quotients always grant; deal the rest singly.
    given = np.maximum(np.floor(votes * (seats / votes.sum())) - 1, 0).astype(np.int64)
    queue = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes.tolist(), given.tolist(), strict=True)) if v > 0]
    while given.sum() > seats:  # cannot happen for floors; kept for float rounding
        given[int(np.argmax(given))] -= 1
    heapq.heapify(queue)
    for _ in range(seats - int(given.sum())):
        _, i = queue[0]
        given[i] += 1
        heapq.heapreplace(queue, (-votes[i] / (2 * given[i] + 1), i))
    return given


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, repeats: float = REPEATS) -> np.ndarray:
    """Shares of total by weight; a share stops at repeats * size and its excess goes to the others by weight."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), float(total)
    while free.any():
        share = left * weights / weights[free].sum()
        above = free & (share > repeats * sizes)
        if not above.any():
            out[free] = share[free]
            break
        out[above] = repeats * sizes[above]
        left -= out[above].sum()
        free &= ~above
    return out


def words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sources(sized: DataFrame, share: float, weights: tuple) -> DataFrame:
    """(source, source_size, target, blocks): one row a source. The table of sources is one group: a name and a number each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = pdf["source"].tolist()
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, (names[i] or "").encode("utf-32-be", "surrogatepass")))
        pdf = pdf.iloc[order].reset_index(drop=True)
        size = pdf["source_size"].to_numpy(float)
        goal = targets(size, np.array([weights[i % len(weights)] for i in range(len(pdf))]), share * size.sum())
        return pdf.assign(target=goal, blocks=sainte_lague(goal, round(goal.sum() / BLOCK)))

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    return totals.groupBy().applyInPandas(run, "source string, source_size long, docs long, target double, blocks long")


def _quotas(shards: DataFrame) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard").reset_index(drop=True)
        return pdf.assign(quota=sainte_lague(pdf["words"].to_numpy(), int(pdf["blocks"].iloc[0])))[["source", "shard", "words", "quota"]]

    return shards.groupBy("source").applyInPandas(run, "source string, shard long, words long, quota long")


def mix(docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, seed: int = 17) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, size, source_size, target, taken; one row for each row.

    Sources in code-point order, null last, weigh weights in turn and share `share` times all words; a target stops at
    REPEATS times the source's words. taken counts the words the mix takes of the row, repeats included: the part of
    the source's chosen blocks that lies in it, at most REPEATS times its size. A source's taken words differ from its
    target by about a block. Null and empty texts have size 0; repeated rows lie side by side and are taken each on
    its own; other columns are ignored; an empty table gives an empty result. Equal input and seed give equal output.
    """
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size"), F.xxhash64("text").alias("version")), "sized")
    sources = cut(_sources(sized, share, weights), "sources")
    own = sources.withColumnRenamed("source", "_source")
    placed = sized.join(own, sized.source.eqNullSafe(own._source)).drop("_source")
    order = F.xxhash64(F.lit(seed), "doc_id", "version")
    placed = placed.withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "order"), F.ceil(F.col("docs") / SHARD_DOCS)))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("blocks").alias("blocks"))
    quotas = _quotas(shards).withColumnsRenamed({"source": "_source", "shard": "_shard", "words": "length"})
    laid = placed.withColumn("end", F.sum("size").over(Window.partitionBy("source", "shard").orderBy("order", "doc_id", "version").rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.join(quotas, laid.source.eqNullSafe(quotas._source) & (laid.shard == quotas._shard))
    # quota blocks run from the seeded block's start, around the shard: whole laps, and one stretch that may wrap.
    length, asked = F.col("length"), F.least(F.col("quota") * BLOCK, F.col("length") * REPEATS)
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.greatest(F.ceil(length / BLOCK), F.lit(1))) * BLOCK
    laps, rest = F.floor(asked / F.greatest(length, F.lit(1))), asked % F.greatest(length, F.lit(1))
    lo, hi = F.col("end") - F.col("size"), F.col("end")

    def common(a, b):
        return F.greatest(F.least(hi, b) - F.greatest(lo, a), F.lit(0))

    taken = laps * F.col("size") + common(first, F.least(first + rest, length)) + common(F.lit(0), F.greatest(first + rest - length, F.lit(0)))
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
