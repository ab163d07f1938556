"""Author identity: blocked fuzzy matching, clusters, merge plan (JN-13, GR-01, GR-04, Q-27, Q-28)."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import match_form, same_author, similarity, sort_name, variant_type
from ..registry import query
from .graph import breadth_first, checkpointed, components

#: Character n-gram size, and the least share of the shorter form's n-grams that similar long forms have in common.
GRAM, SHARED = 3, 0.2
#: Characters without a counterpart, of both together, that the keys of similar() allow for; rows of a batch of keys, and of a task that pairs them.
MOST, BATCH, TASK_KEYS = 6, 1 << 18, 1 << 20
KEYS = ["key", "id", "skip", "odd"]


def unmatched(a: int, b: int, least: float) -> int:
    """Most characters without a counterpart in strings of these lengths whose ratio reaches so much; below 0 if none can."""
    if 2 * min(a, b) < least * (a + b) - 1e-9:
        return -1
    most = int((1 - least) * (a + b) + 1e-9)
    return most - (a + b - most) % 2


def key_plan(lengths: list[int], least: float) -> dict[int, dict[tuple[int, int], int]]:
    """Of each length, for keys (part, characters kept), the most characters left out.

    Strings whose ratio reaches least have a common subsequence of m characters and d others, both known from their
    lengths. If d is small, the subsequence is the key (part 0). Else of its two halves either the first has d // 2 of
    the others before its last character (part 1), or the second fewer than what is left after its first (part 2).
    """
    plan = {n: {} for n in lengths}
    for a in lengths:
        for b in lengths:
            d = unmatched(a, b, least)
            if not 0 < d <= MOST:
                continue
            m = (a + b - d) // 2
            needs = [((0, m), a - m)] if d <= 3 else [((1, m // 2), min(d // 2, a - m)), ((2, m - m // 2), min(d - 1 - d // 2, a - m))]
            for key, out in needs:
                plan[a][key] = max(out, plan[a].get(key, 0))
    return plan


def kept_places(part: int, keep: int, out: int, length: int) -> np.ndarray:
    """(keys, keep): the places of each key's characters; keys of halves end with a character that is kept."""
    if part == 0:
        return np.array(list(combinations(range(length), keep)), np.int64).reshape(-1, keep)
    rows = [(*c, keep + i - 1) for i in range(out + 1) if keep + i <= length for c in combinations(range(keep + i - 1), keep - 1)]
    places = np.array(rows, np.int64).reshape(-1, keep)
    return places if part == 1 else length - 1 - places


def subsequence_keys(plan: dict[int, dict[tuple[int, int], int]]):
    """Arrow batches of (id, text, skip) -> (key, id, skip, odd): hashes of the subsequences that the plan names, each once a text; a bit for each character met an odd number of times."""
    factors = np.random.default_rng(0).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(codes: np.ndarray):
        length = codes.shape[1]
        for (part, keep), out in sorted(plan[length].items()):
            places = kept_places(part, keep, out, length)
            for lo in range(0, len(places), 64):
                total = np.full((len(codes), len(places[lo : lo + 64])), part * 256 + keep, np.uint64) * factors[255]
                for r, at in enumerate(places[lo : lo + 64].T):
                    total += codes[:, at] * factors[r]
                total = np.sort(total ^ total >> np.uint64(31), axis=1)
                yield total, np.diff(total, axis=1, prepend=~total[:, :1]) != 0

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            ids, skip = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for n in np.unique(sizes):
                if not plan.get(int(n)):
                    continue
                for rows in np.array_split(np.flatnonzero(sizes == n), -(-int((sizes == n).sum()) * 64 // BATCH)):
                    codes = np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(rows), n).astype(np.uint64)
                    odd = np.bitwise_xor.reduce(np.uint64(1) << (codes & np.uint64(63)), axis=1)
                    for found, new in keys(codes):
                        at = np.nonzero(new)[0]
                        yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64)), pa.array(ids[rows[at]]), pa.array(skip[rows[at]]), pa.array(odd[at].view(np.int64))], KEYS)

    return run


def meeting(batches):
    """All rows of some keys -> (p, q), p < q, of one key and two skips; each character without a counterpart changes one bit of odd at most."""
    held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
    if not held:
        return
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    key, ids, skip, odd = (c[order] for c in columns)
    first, apart = np.arange(len(key)), 1
    while len(first := first[first + apart < len(key)]) and len(first := first[key[first] == key[first + apart]]):
        other = first + apart
        near = (skip[first] != skip[other]) & (ids[first] != ids[other]) & (np.bitwise_count(odd[first] ^ odd[other]) <= MOST)
        a, b = ids[first[near]], ids[other[near]]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["p", "q"])
        apart += 1


def longest(least: float) -> int:
    """Length up to which any two strings can be compared by similar()."""
    return next((n for n in range(1, 200) if unmatched(n + 1, n + 1, least) > MOST), 200)


def similar(strings: DataFrame, least: float) -> DataFrame:
    """strings(id, text, skip) -> (p, q), p < q: all pairs whose character ratio may reach least, but those of one skip.

    For texts up to longest(least); pairs meet in a common subsequence, so that their number is near that of the result.
    """
    cores = strings.sparkSession.sparkContext.defaultParallelism
    counts = {r["n"]: r["count"] for r in strings.groupBy(F.length("text").alias("n")).count().collect()}  # lengths of names: few
    plan = key_plan([n for n in counts if 0 < n <= longest(least)], least)
    total = sum(counts[n] * sum(len(kept_places(part, keep, out, n)) for (part, keep), out in own.items()) for n, own in plan.items())
    made = strings.repartition(max(cores, sum(counts.values()) // 50_000), "id").mapInArrow(subsequence_keys(plan), ", ".join(f"{c} long" for c in KEYS))
    pairs = made.repartition(max(cores, total // TASK_KEYS), "key").mapInArrow(meeting, "p long, q long").distinct()
    side = lambda c, to: strings.select(F.col("id").alias(c), F.col("text").alias(to))
    both = pairs.join(side("p", "x").hint("merge"), "p").join(side("q", "y").hint("merge"), "q")
    return both.filter(F.levenshtein("x", "y") <= (F.length("x") + F.length("y")) * (1 - least) + 1e-9).select("p", "q")


def similar_long(rows: DataFrame, limit: int) -> DataFrame:
    """rows(id, form, grams) -> (p, q): pairs with a form longer than limit that have many common n-grams.

    A similarity of 0.85 needs common blocks that cover 85 % of both forms; each block edge costs GRAM - 1 n-grams, so at
    least SHARED of the shorter form's n-grams are common. Forms so alike differ little in length, so of each form only
    its rarest n-grams are joined, without the SHARED * 0.7 most frequent ones but one: a pair must meet in one of these,
    and no n-gram that most names hold pairs them all.
    """
    own = rows.filter(F.length("form") > limit // 2).withColumn("long", F.length("form") > limit)
    spread = own.select("id", "long", F.size("grams").alias("n"), F.explode("grams").alias("key"))
    often = spread.groupBy("key").agg(F.count("*").alias("often"))
    ranked = spread.join(often, "key").withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("often", "key")))
    rare = ranked.filter(F.col("r") <= F.col("n") - F.ceil(F.col("n") * (SHARED * 0.7)) + 1).select("id", "long", "key")
    a, b = rare.alias("a"), rare.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.long") | F.col("b.long"))).select(F.col("a.id").alias("p"), F.col("b.id").alias("q")).distinct()
    side = lambda c, to: rows.select(F.col("id").alias(c), F.col("grams").alias(to))
    both = met.join(side("p", "g"), "p").join(side("q", "h"), "q")
    return both.filter(F.size(F.array_intersect("g", "h")) >= F.least(F.size("g"), F.size("h")) * SHARED).select("p", "q")


def candidate_pairs(names: DataFrame, threshold: float = 0.85) -> DataFrame:
    """names(id, rank, form) -> pairs of names to compare (src, dst, x, y), the earlier name first.

    They have a common last word, or similar ones, or a lone word of the other, or are similar as a whole: all that
    same_author() can link. Names of one last word are one author by rule, or nearly, and meet by that word alone.
    """
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("form") - GRAM + 1, F.lit(1))), lambda i: F.substring(F.col("form"), i, F.lit(GRAM))))
    rows = checkpointed(names.select("id", "rank", "form", F.split("form", " ").alias("words")).withColumn("last", F.element_at("words", -1)))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        """(p, q), p < q, that share a key."""
        both = left.alias("a").join(right.hint("merge").alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.id") != F.col("b.id")))
        return both.select(F.least("a.id", "b.id").alias("p"), F.greatest("a.id", "b.id").alias("q"))

    last = rows.select("id", F.col("last").alias("key"))
    lone = rows.filter(F.size("words") == 1).select("id", F.col("words")[0].alias("key"))
    held = rows.select("id", F.explode(F.array_distinct("words")).alias("key"))
    found = met(last, last).filter("p < q").union(met(lone, held))

    ends = checkpointed(rows.select("last").distinct().select(F.monotonically_increasing_id().alias("id"), "last"))
    found = found.union(similar(rows.select("id", F.col("form").alias("text"), F.xxhash64("last").alias("skip")), threshold))
    near = similar(ends.select("id", F.col("last").alias("text"), F.col("id").alias("skip")), 0.85)
    word = lambda c, to: ends.select(F.col("id").alias(c), F.col("last").alias(to))
    near = near.join(word("p", "u"), "p").join(word("q", "v"), "q").select("u", "v")
    of = lambda c, to: rows.select(F.col("last").alias(c), F.col("id").alias(to))
    found = found.union(near.join(of("u", "i"), "u").join(of("v", "j"), "v").select(F.least("i", "j"), F.greatest("i", "j")))
    limit = longest(threshold)
    if rows.filter(F.length("form") > limit).limit(1).count():
        found = found.union(similar_long(rows.select("id", "form", grams.alias("grams")), limit))
    side = lambda c, form, rank: rows.select(F.col("id").alias(c), F.col("form").alias(form), F.col("rank").alias(rank)).hint("merge")
    both = found.distinct().join(side("p", "x", "r"), "p").join(side("q", "y", "s"), "q")
    first = F.col("r") < F.col("s")
    turn = lambda a, b, to: F.when(first, F.col(a)).otherwise(F.col(b)).alias(to)
    return both.select(turn("p", "q", "src"), turn("q", "p", "dst"), turn("x", "y", "x"), turn("y", "x", "y"))


def settled(links: DataFrame, threshold: float) -> DataFrame:
    """links(src, dst, x, y) of same_author() -> those of them, (src, dst), that do not rest on a chance likeness.

    Among many names some last words are alike by chance. A link by a common last word or a lone word holds. One by
    likeness alone holds between names with first names if they are alike as a whole, and for a short name, a lone word
    or one with an initial, if no name with a first name has its very last word: else that one tells whom it names.
    """
    head = lambda c: F.slice(F.split(c, " "), 1, F.size(F.split(c, " ")) - 1)
    named = lambda c: F.exists(head(c), lambda w: F.length(w) > 1)
    short = lambda c: (F.size(head(c)) == 0) | F.exists(head(c), lambda w: F.length(w) == 1)
    lone = lambda c, of: (F.size(head(c)) == 0) & F.array_contains(F.split(of, " "), F.col(c))
    common = (F.element_at(F.split("x", " "), -1) == F.element_at(F.split("y", " "), -1)) | lone("x", "y") | lone("y", "x")
    links = checkpointed(links.withColumn("common", common))
    held, alike = links.filter("common"), links.filter("not common")
    whole = alike.filter(named("x") & named("y")).filter(similarity("x", "y") >= threshold)
    told = held.filter(~short("y")).select(F.col("src").alias("id")).union(held.filter(~short("x")).select("dst")).distinct()
    ends = alike.filter(short("x")).select("src", "dst", F.col("src").alias("id")).union(alike.filter(short("y")).select("src", "dst", "dst"))
    return held.select("src", "dst").union(whole.select("src", "dst")).union(ends.join(told, "id", "left_anti").select("src", "dst"))


def name_clusters(names: DataFrame, threshold: float = 0.85, settle: bool = False) -> DataFrame:
    """names(id, name, works) -> (id, component) over same-author links, or the settled ones; earlier names by works desc, then name."""
    ranked = checkpointed(names.select("id", match_form(F.col("name")).alias("form"), F.struct((-F.col("works")).alias("w"), "name", "id").alias("rank")))
    links = candidate_pairs(ranked, threshold).filter(same_author(threshold)("x", "y"))
    return components(ranked.select("id"), settled(links, threshold) if settle else links.select("src", "dst"))


_LETTERS = "bcdfghklmnprstvz"
#: Of author k: a first and a last name of letters that its key's hash gives.
_NAMES_SQL = f"""a AS (SELECT c_custkey AS k, translate(md5(c_custkey::VARCHAR), '0123456789abcdef', '{_LETTERS}') AS h FROM customer),
 n AS (SELECT k, upper(h[1]) || h[2:8] AS first, upper(h[9]) || h[10:18] AS last FROM a),
 v AS (SELECT k, first || ' ' || last AS name, 3 AS works FROM n UNION ALL SELECT k, first[1] || '. ' || last, 1 FROM n WHERE k % 2 = 0 UNION ALL SELECT k, first || 'x ' || last, 2 FROM n WHERE k % 3 = 0 UNION ALL SELECT k, last, 1 FROM n WHERE k % 5 = 0)"""


def _names(t) -> DataFrame:
    """Authors' names with variants: every author has a name of its own; some are also written with an initial, an error, or the last name alone."""
    h = F.translate(F.md5(F.col("c_custkey").cast("string")), "0123456789abcdef", _LETTERS)
    base = t.customer.select(F.col("c_custkey").alias("k"), F.initcap(F.substring(h, 1, 8)).alias("first"), F.initcap(F.substring(h, 9, 10)).alias("last"))
    made = ((F.concat("first", F.lit(" "), "last"), 3, 1), (F.concat(F.substring("first", 1, 1), F.lit(". "), "last"), 1, 2), (F.concat("first", F.lit("x "), "last"), 2, 3), (F.col("last"), 1, 5))
    rows = [base.filter(F.col("k") % step == 0).select(name.alias("name"), F.lit(works).alias("works")) for name, works, step in made]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]).groupBy("name").agg(F.sum("works").alias("works")).withColumn("id", F.xxhash64("name"))


@query(
    "gr04_name_clusters",
    f"WITH {_NAMES_SQL} SELECT count(*) AS n, arg_max(name, (length(name), works, name)) AS canonical, sum(works)::BIGINT AS works, string_agg(name, '|' ORDER BY name) AS names FROM v GROUP BY k HAVING count(*) > 1",
)
def clusters(t):
    """Proposed merges: each cluster of two or more names with its canonical name and summed works."""
    names = checkpointed(_names(t))
    rows = names.join(name_clusters(names, settle=True), "id")
    best = F.max_by("name", F.struct(F.length("name"), "works", "name"))
    return rows.groupBy("component").agg(F.count("*").alias("n"), best.alias("canonical"), F.sum("works").alias("works"), F.array_join(F.array_sort(F.collect_list("name")), "|").alias("names")).filter("n > 1").drop("component")


@query("jn13_alike_names", f"WITH {_NAMES_SQL} SELECT least(x.name, y.name) AS a, greatest(x.name, y.name) AS b FROM v x JOIN v y ON x.k = y.k AND x.name < y.name WHERE x.name <> y.name")
def alike(t):
    """Pairs of names that name one author, without comparing all pairs."""
    names = checkpointed(_names(t).select("id", "name", match_form(F.col("name")).alias("form"), F.struct((-F.col("works")).alias("w"), "name", "id").alias("rank")))
    links = candidate_pairs(names.select("id", "rank", "form")).filter(same_author(0.85)("x", "y")).select("src", "dst")
    side = lambda c, to: names.select(F.col("id").alias(c), F.col("name").alias(to))
    found = links.join(side("src", "x"), "src").join(side("dst", "y"), "dst")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


@query(
    "q27_merge_proposal",
    f"WITH {_NAMES_SQL}, c AS (SELECT k, arg_max(name, (length(name), works, name)) AS canonical, sum(works) AS total FROM v GROUP BY k HAVING count(*) > 1) SELECT name AS variant, canonical, works::BIGINT AS works, total::BIGINT AS total, name = canonical AS keeps, CASE WHEN name = canonical THEN NULL WHEN contains(name, '.') THEN 'initials' WHEN contains(canonical, name) THEN 'short_form' ELSE 'abbreviation' END AS kind FROM v JOIN c USING (k)",
)
def proposal(t, manual: dict[str, str] | None = None):
    """The report on author names: every variant with its canonical name, both numbers of works, and the variant's kind; a manual mapping wins."""
    names = checkpointed(_names(t))
    rows = names.join(name_clusters(names, settle=True), "id")
    best = F.max_by("name", F.struct(F.length("name"), "works", "name"))
    groups = rows.groupBy("component").agg(best.alias("canonical"), F.sum("works").alias("total"), F.count("*").alias("n")).filter("n > 1")
    out = rows.join(groups, "component").withColumn("canonical", F.coalesce(*([F.try_element_at(F.create_map(*(F.lit(x) for pair in manual.items() for x in pair)), "name")] if manual else []), "canonical"))
    keeps = F.col("name") == F.col("canonical")
    return out.select(F.col("name").alias("variant"), "canonical", F.col("works").cast("bigint").alias("works"), "total", keeps.alias("keeps"), F.when(~keeps, variant_type(F.col("name"), F.col("canonical"))).alias("kind"))


@query("q28_apply_mapping", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey - 1 ELSE c_custkey END AS author_id, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def apply_mapping(t):
    """Works keep counting for the author they are reassigned to."""
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("works"))
    target = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))
    return t.customer.join(counts, "c_custkey", "left").select("c_custkey", target.alias("author_id"), F.coalesce("works", F.lit(0)).alias("works"))


@query("fn24_aliases", f"WITH {_NAMES_SQL} SELECT name, regexp_replace(name, '^(.*) ([^ ]+)$', '\\2, \\1') AS name_sort, CASE WHEN name[2] = '.' THEN 'initials' WHEN contains(name, ' ') THEN 'short_form' ELSE 'abbreviation' END AS variant FROM v")
def aliases(t):
    names = _names(t)
    return names.select("name", sort_name(F.col("name")).alias("name_sort"), variant_type(F.regexp_extract("name", r"^([^ ]+)", 1), F.col("name")).alias("variant"))


@query(
    "gr01_link_graph",
    """WITH RECURSIVE e AS (SELECT event_id AS src, event_id * 3 + k AS dst FROM events, (VALUES (1), (2), (0)) v(k)),
    w AS (SELECT 1::BIGINT AS id, 0 AS depth UNION SELECT e.dst, depth + 1 FROM w JOIN e ON e.src = w.id WHERE depth < 6) SELECT id, min(depth)::BIGINT AS depth FROM w GROUP BY 1""",
)
def link_graph(t, max_depth: int = 6):
    """Breadth-first levels of a link table from one seed."""
    links = t.events.select(F.col("event_id").alias("src"), F.posexplode(F.array(*(F.col("event_id") * 3 + k for k in (0, 1, 2)))).alias("place", "dst"))
    seeds = t.spark.createDataFrame([(1,)], "id long")
    return breadth_first(seeds, checkpointed(links), max_depth).select("id", F.col("depth").cast("bigint").alias("depth"))


@query("gr05_leaf_to_root", "SELECT event_id, depth FROM (SELECT event_id, event_id % 7 AS depth, coalesce(sum(40) OVER (ORDER BY event_id % 7 DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events WHERE event_type = 'view') WHERE spent < 4000")
def leaf_to_root(t, budget: int = 4000, cost: int = 40):
    """Deepest level first until the budget is spent; costs are equal, so a top-k by (depth desc, id) is the running total."""
    rows = t.events.filter("event_type = 'view'").select("event_id", (F.col("event_id") % 7).alias("depth"))
    return rows.orderBy(F.desc("depth"), "event_id").limit(-(-budget // cost))
