"""Page plans: blocks, paragraphs, links, samples, header fields (TF, SRC-05)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import block_subtype, block_type, page_subtype
from ..operators import html_blocks
from ..registry import query
from ..sources.tables import spread

_BLOCKS = "page_id long, url string, blocks array<struct<title:string,level:int,author:string,paragraphs:array<string>>>"
_BLOCK_TYPE = pa.list_(pa.struct([("title", pa.string()), ("level", pa.int32()), ("author", pa.string()), ("paragraphs", pa.list_(pa.string()))]))


def _mapped(pages: DataFrame, schema: str, make, types: list) -> DataFrame:
    """page_id, url and columns that make(html, url) gives, batch by batch."""
    names = ["page_id", "url", *(n for n, _ in types)]

    def run(batches):
        for b in batches:
            rows = [make(h, u) for h, u in zip(b.column("html").to_pylist(), b.column("url").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *(pa.array([r[n] for r in rows], t) for n, t in types)], names)

    return spread(pages.select("page_id", "url", "html")).mapInArrow(run, schema)


def parsed_blocks(pages: DataFrame) -> DataFrame:
    """One row per block: order, type, subtype, title, author override, paragraphs."""
    rows = _mapped(pages, _BLOCKS, lambda h, u: {"blocks": html_blocks.blocks(h)}, [("blocks", _BLOCK_TYPE)])
    rows = rows.select("page_id", "url", F.posexplode("blocks").alias("order_index", "b"))
    return rows.select("page_id", "url", F.col("order_index").cast("bigint").alias("order_index"), block_type(F.col("b.level")).alias("block_type"), page_subtype(F.col("url"), block_subtype(F.col("b.title"))).alias("block_subtype"), F.col("b.title").alias("title"), F.col("b.author").alias("author_override"), F.col("b.paragraphs").alias("paragraphs"))


@query("tf01_html_blocks")
def html_blocks_query(t):
    return parsed_blocks(t.pages).withColumn("paragraphs", F.array_join("paragraphs", "\n"))


@query("tf08_page_paragraphs", r"SELECT page_id, len(regexp_extract_all(regexp_replace(regexp_replace(html, '<script>.*?</script>', '', 'gs'), '<footer>.*?</footer>', '', 'gs'), '<p>(<b>)?[^<]*[^<\s]')) AS n FROM pages")
def page_paragraphs(t):
    return parsed_blocks(t.pages).groupBy("page_id").agg(F.sum(F.size("paragraphs")).cast("bigint").alias("n"))


@query("tf16_links", r"SELECT page_id, len(regexp_extract_all(regexp_replace(html, '<script>.*?</script>', '', 'gs'), '<a href=')) AS n FROM pages WHERE contains(html, '<a href=')")
def links(t):
    rows = _mapped(t.pages, "page_id long, url string, links array<string>", lambda h, u: {"links": html_blocks.links(h, u)}, [("links", pa.list_(pa.string()))])
    return rows.select("page_id", F.explode("links").alias("link")).groupBy("page_id").agg(F.count("*").alias("n"))


@query("tf17_samples")
def samples(t):
    names = [("title", pa.string()), ("h1", pa.string()), ("content_sample", pa.string())]
    return _mapped(t.pages, "page_id long, url string, title string, h1 string, content_sample string", lambda h, u: html_blocks.sample(h), names)


@query("tf13_header_fields", "SELECT page_id, 'Written' AS label, 'May 1, 1919' AS value FROM pages UNION ALL SELECT page_id, 'Source', url FROM pages")
def header_fields(t):
    """Header labels of pages, with a header paragraph made of each page's own URL, as pages here carry none."""
    lead = F.concat(F.lit('<body><p class="information"><span class="info">Written:</span> '), F.lit("May 1, 1919<br><span class=\"info\">Source:</span> "), F.col("url"), F.lit("</p>"))
    pages = t.pages.withColumn("html", F.concat(lead, F.regexp_replace("html", "^.*?<body>", "")))
    rows = _mapped(pages, "page_id long, url string, fields map<string,string>", lambda h, u: {"fields": list(html_blocks.header_fields(h).items())}, [("fields", pa.map_(pa.string(), pa.string()))])
    return rows.select("page_id", F.explode("fields").alias("label", "value"))


@query("tf18_path_facts", r"SELECT page_id, regexp_extract(url, '^https?://[^/]*/([a-z]{2})/', 1) AS lang, regexp_extract(url, '^https?://(?:www\.|m\.|blog\.)?([^./]+)', 1) AS site FROM pages")
def path_facts(t):
    return t.pages.select("page_id", F.regexp_extract("url", r"^https?://[^/]*/([a-z]{2})/", 1).alias("lang"), F.regexp_extract("url", r"^https?://(?:www\.|m\.|blog\.)?([^./]+)", 1).alias("site"))


@query(
    "tf19_year_votes",
    r"""WITH y AS (SELECT source, unnest(regexp_extract_all(text, '(1[5-9][0-9]{2}|20[0-3][0-9])')) AS y FROM documents), c AS (SELECT source, y, count(*) AS n FROM y GROUP BY 1, 2)
    SELECT source, y::INTEGER AS year, n, least(0.9, 0.4 + 0.1 * n)::DOUBLE AS confidence FROM c QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, y) = 1""",
)
def year_votes(t):
    """The most frequent year of a group of texts, with a confidence that grows with its votes."""
    years = t.documents.select("source", F.explode(F.regexp_extract_all("text", F.lit("(1[5-9][0-9]{2}|20[0-3][0-9])"), 1)).alias("y"))
    votes = years.groupBy("source", "y").agg(F.count("*").alias("n"))
    best = votes.groupBy("source").agg(F.min(F.struct((-F.col("n")).alias("m"), "y")).alias("b"))
    n = -F.col("b.m")
    return best.select("source", F.col("b.y").cast("int").alias("year"), n.alias("n"), F.least(F.lit(0.9), F.lit(0.4) + n * F.lit(0.1)).alias("confidence"))


@query("src01_snapshots", "SELECT sha256(html) AS sha, min(page_id) AS page_id, min(octet_length(encode(html)))::BIGINT AS bytes FROM pages WHERE octet_length(encode(html)) <= 4000 GROUP BY 1")
def bounded_snapshots(t, max_bytes: int = 4000):
    """Snapshots of fetched pages, written once by content hash, with the fetcher's bound on size as a parameter."""
    rows = t.pages.withColumn("bytes", F.octet_length("html")).filter(F.col("bytes") <= max_bytes)
    return rows.groupBy(F.sha2("html", 256).alias("sha")).agg(F.min("page_id").alias("page_id"), F.min("bytes").cast("bigint").alias("bytes"))


@query("src05_content_addressed", "SELECT sha256(html) AS sha, min(page_id) AS page_id, count(*) AS copies, min(octet_length(encode(html)))::BIGINT AS bytes FROM pages GROUP BY 1")
def snapshots(t):
    """Write-once snapshots: one row per content hash (SRC-01)."""
    return t.pages.groupBy(F.sha2("html", 256).alias("sha")).agg(F.min("page_id").alias("page_id"), F.count("*").alias("copies"), F.min(F.octet_length("html")).cast("bigint").alias("bytes"))
