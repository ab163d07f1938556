"""Joins (JN). Strategies are left to AQE; only sides of one row or of constants are broadcast."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query


@query("jn01_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("jn02_left_keyed", "SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def left_keyed(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic")


@query(
    "jn03_preaggregated",
    """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(n_suppliers, 0) AS n_suppliers, coalesce(n_lines, 0) AS n_lines FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, count(DISTINCT l_suppkey) AS n_suppliers, count(*) AS n_lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) b ON b.o_custkey = c_custkey""",
)
def preaggregated(t):
    orders = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    lines = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.countDistinct("l_suppkey").alias("n_suppliers"), F.count("*").alias("n_lines"))
    both = orders.join(lines, "o_custkey", "left")
    joined = t.customer.select("c_custkey").join(both, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_orders", "n_suppliers", "n_lines")))


@query("jn04_left_then_group", "SELECT c_custkey, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def left_then_group(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("works"))  # aggregated below the join
    return t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("works", F.lit(0)).alias("works"))


@query("jn05_multi_hop", "SELECT l_orderkey, l_linenumber, r_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_returnflag = 'R'")
def multi_hop(t):
    place = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    return t.lineitem.filter("l_returnflag = 'R'").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(place, F.col("o_custkey") == F.col("c_custkey")).select("l_orderkey", "l_linenumber", "r_name")


@query("jn06_bridge", "SELECT DISTINCT s_suppkey, p_brand FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey WHERE p_size > 40")
def bridge(t):
    parts = t.part.filter("p_size > 40").select("p_partkey", "p_brand")
    links = t.lineitem.join(parts, F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "p_brand").distinct()
    return links.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey", "p_brand")


@query("jn07_ordinal", "SELECT a.conv_id, a.turn, a.role AS role, b.role AS next_role FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def ordinal(t):
    a, b = t.conversations.alias("a"), t.conversations.alias("b")
    return a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") + 1)).select("a.conv_id", "a.turn", F.col("a.role").alias("role"), F.col("b.role").alias("next_role"))


@query("jn08_condition_in_on", "SELECT documents.doc_id, count(quality) AS good FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id AND quality > 0 GROUP BY documents.doc_id")
def condition_in_on(t):
    good = t.labels.filter("quality > 0").select("doc_id", "quality")  # the ON condition of the inner side
    return t.documents.select("doc_id").join(good, "doc_id", "left").groupBy("doc_id").agg(F.count("quality").alias("good"))


@query("jn09_anti", "SELECT c_custkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderkey IS NULL")
def anti(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("jn10_processed_skip", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM labels WHERE toxic = 0)")
def processed_skip(t):
    done = t.labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("a"), F.max(F.col("toxic") == 0).alias("b")).filter("a AND b")
    return t.documents.join(done, "doc_id", "left_anti").select("doc_id")


@query("jn11_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def semi(t):
    return t.customer.join(t.orders.filter("o_totalprice > 200000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("jn12_parent", "SELECT a.event_id, b.event_type AS parent_type FROM events a LEFT JOIN events b ON b.event_id = CASE WHEN a.event_id > 0 THEN a.event_id // 4 END")
def parent(t):
    a = t.events.select("event_id", F.when(F.col("event_id") > 0, F.floor(F.col("event_id") / 4)).alias("parent_id"))
    b = t.events.select(F.col("event_id").alias("parent_id"), F.col("event_type").alias("parent_type"))
    return a.join(b, "parent_id", "left").select("event_id", "parent_type")


@query("jn14_substring", "SELECT o_clerk.k AS curated, count(*) AS hits FROM (VALUES ('urgent'), ('low'), ('not specified'), ('none')) o_clerk(k) JOIN orders ON lower(o_orderpriority) LIKE '%' || k || '%' GROUP BY 1")
def substring(t):
    curated = t.spark.createDataFrame([("urgent",), ("low",), ("not specified",), ("none",)], "curated string")  # a constant table
    titles = t.orders.groupBy(F.lower("o_orderpriority").alias("title")).agg(F.count("*").alias("n"))
    return titles.join(F.broadcast(curated), F.col("title").contains(F.col("curated"))).groupBy("curated").agg(F.sum("n").alias("hits"))


@query("jn15_override", "SELECT p_partkey, coalesce(u.size, p_size)::BIGINT AS size FROM part LEFT JOIN (SELECT s_suppkey AS k, 99 AS size FROM supplier WHERE s_suppkey % 2 = 0) u ON u.k = p_partkey")
def override(t):
    updates = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("p_partkey"), F.lit(99).alias("new"))
    return t.part.join(updates, "p_partkey", "left").select("p_partkey", F.coalesce("new", "p_size").cast("bigint").alias("size"))


@query("jn16_point_lookup", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7")
def point_lookup(t):
    return t.orders.filter("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("jn17_collected", "SELECT o_orderkey, count(l_linenumber) AS n, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def collected(t):
    one = F.concat_ws(":", F.col("l_linenumber").cast("string"), "l_returnflag")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", one.alias("s")))).alias("a"))
    joined = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") > 0, F.array_join(F.transform("a", lambda x: x["s"]), ",")).alias("lines"))


@query(
    "jn18_positional_zip",
    """WITH r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) - 1 AS pos FROM conversations)
    SELECT a.conv_id, a.pos, a.text AS question, b.text AS answer FROM r a JOIN r b ON a.conv_id = b.conv_id AND a.pos = b.pos AND a.role = 'user' AND b.role = 'assistant'""",
)
def positional_zip(t):
    """Pairs of the n-th user and n-th assistant turn; the longer list is cut, as a positional zip does."""
    ranked = t.conversations.filter("role IN ('user', 'assistant')").groupBy("conv_id", "role").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("a"))
    side = lambda role, name: ranked.filter(F.col("role") == role).select("conv_id", F.posexplode(F.transform("a", lambda x: x["text"])).alias("pos", name))
    return side("user", "question").join(side("assistant", "answer"), ["conv_id", "pos"]).select("conv_id", F.col("pos").cast("bigint").alias("pos"), "question", "answer")


@query("jn19_mapping_chain", "SELECT c_mktsegment AS variant, coalesce(m2.c, m1.c, c_mktsegment) AS canonical, count(*) AS n FROM customer LEFT JOIN (VALUES ('BUILDING', 'construction'), ('MACHINERY', 'tools')) m1(v, c) ON m1.v = c_mktsegment LEFT JOIN (VALUES ('MACHINERY', 'machines')) m2(v, c) ON m2.v = c_mktsegment GROUP BY 1, 2")
def mapping_chain(t):
    first, later = {"BUILDING": "construction", "MACHINERY": "tools"}, {"MACHINERY": "machines"}
    mapping = F.create_map(*(F.lit(x) for pair in (first | later).items() for x in pair))
    return t.customer.select(F.col("c_mktsegment").alias("variant"), F.coalesce(F.try_element_at(mapping, F.col("c_mktsegment")), "c_mktsegment").alias("canonical")).groupBy("variant", "canonical").agg(F.count("*").alias("n"))
