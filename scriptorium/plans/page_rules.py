"""Rules of the page parser one by one, each over pages made of parts and orders (TF-02 to TF-07, TF-09 to TF-11, TF-14, TF-15, TF-21, DT-13, SRC-13)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTHS, parse_dateish
from ..functions.text import block_subtype, clean, page_subtype
from ..operators import html_blocks
from ..operators.windows import top_per_group
from ..registry import query
from .catalog import header_years
from .pages import _mapped, parsed_blocks


def _pages(t, html: Column, key: str = "p_partkey", table: str = "part", url: Column | None = None) -> DataFrame:
    return getattr(t, table).select(F.col(key).alias("page_id"), (F.lit("https://e.org/x.htm") if url is None else url).alias("url"), html.alias("html"))


def _by(k: Column, *values) -> Column:
    """One of the values in turn."""
    out = F.when(k == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(k == i, v)
    return out


def container_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, body): text of each page's main container without noise elements; null without a container."""

    def make(html, url):
        found = html_blocks.main_container(html_blocks.parse(html))
        if found is None:
            return {"body": None}
        html_blocks.strip_noise(found)
        return {"body": html_blocks.clean(found.text())}

    return _mapped(pages, "page_id long, url string, body string", make, [("body", pa.string())])


@query("tf02_main_container", "SELECT p_partkey AS page_id, CASE p_partkey % 5 WHEN 0 THEN 'C ' WHEN 1 THEN 'A ' WHEN 2 THEN 'I ' WHEN 3 THEN 'M ' ELSE 'M B ' END || p_name AS body FROM part")
def main_containers(t):
    name = F.col("p_name")
    html = _by(
        F.col("p_partkey") % 5,
        F.concat(F.lit('<body><div id="main">M</div><div id="content">C '), name, F.lit("</div></body>")),
        F.concat(F.lit('<body><div id="main">M</div><div id="article">I</div><div class="x article">A '), name, F.lit("</div></body>")),
        F.concat(F.lit('<body><div id="main">M</div><div id="article">I '), name, F.lit("</div></body>")),
        F.concat(F.lit('<body>B<div id="main">M '), name, F.lit("</div></body>")),
        F.concat(F.lit("<body><div>M</div>B "), name, F.lit("</body>")),
    )
    return container_texts(_pages(t, html)).select("page_id", "body")


@query("tf03_noise_strip", "SELECT p_partkey AS page_id, 'kept ' || p_name || ' beside' AS body FROM part")
def noise(t):
    html = F.concat(F.lit('<body><nav>n</nav><script>s</script><style>y</style><header>h</header><div class="Top-Menu">m</div><form>f</form><div class="big footer">g</div><p>kept</p><p>'), "p_name", F.lit('</p><div class="note">beside</div><footer>f</footer></body>'))
    return container_texts(_pages(t, html)).select("page_id", "body")


@query("tf04_white_space", r"SELECT doc_id, sha256(trim(regexp_replace(concat('  ', text, chr(9), ' end '), '\s+', ' ', 'g'))) AS hash FROM documents")
def white_space(t):
    return t.documents.select("doc_id", F.sha2(clean(F.concat(F.lit("  "), "text", F.lit("\t end "))), 256).alias("hash"))


@query("tf05_block_types", "SELECT p_partkey AS page_id, ['chapter', 'section', 'subsection', 'other'][p_partkey % 4 + 1] AS block_type, p_name AS title FROM part")
def block_types(t):
    level = (F.col("p_partkey") % 4 + 1).cast("string")
    html = F.concat(F.lit("<body><h"), level, F.lit(">"), "p_name", F.lit("</h"), level, F.lit("><p>x</p></body>"))
    return parsed_blocks(_pages(t, html)).select("page_id", "block_type", "title")


@query("tf06_block_subtypes", "SELECT p_partkey AS page_id, CASE p_partkey % 6 WHEN 0 THEN 'preface' WHEN 1 THEN 'afterword' WHEN 2 THEN 'afterword' WHEN 3 THEN 'footnote' WHEN 4 THEN 'appendix' END AS subtype FROM part")
def block_subtypes(t):
    title = F.concat(_by(F.col("p_partkey") % 6, F.lit("PREFACE to notes on "), F.lit("Afterword: "), F.lit("A Postface, "), F.lit("End Notes "), F.lit("Appendix "), F.lit("Chapter ")), F.col("p_name"))
    return t.part.select(F.col("p_partkey").alias("page_id"), block_subtype(title).alias("subtype"))


@query("tf07_author_override", "SELECT p_partkey AS page_id, CASE p_partkey % 3 WHEN 0 THEN 'Karl ' || upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) END AS author FROM part")
def author_overrides(t):
    first = F.initcap(F.split("p_name", " ")[0])
    title = _by(F.col("p_partkey") % 3, F.concat(F.lit("Letter by Karl "), first, F.lit(", 1919")), F.concat(F.lit("Letter by karl "), first), F.lit("Standby Notes"))
    html = F.concat(F.lit("<body><h2>"), title, F.lit("</h2><p>x</p></body>"))
    return parsed_blocks(_pages(t, html)).select("page_id", F.col("author_override").alias("author"))


@query("tf09_header_paragraphs", "SELECT p_partkey AS page_id, CASE p_partkey % 4 WHEN 3 THEN p_name || '|' ELSE '' END || 'body' AS paragraphs FROM part")
def header_paragraphs(t):
    html = F.concat(
        _by(F.col("p_partkey") % 4, F.lit('<body><p class="intro">'), F.lit('<body><p class="information">Written: '), F.lit('<body><p class="information"><span class="info">Source</span>: '), F.lit('<body><p class="information">')),
        F.col("p_name"), F.lit("</p><p>body</p></body>"),
    )
    return parsed_blocks(_pages(t, html)).select("page_id", F.array_join("paragraphs", "|").alias("paragraphs"))


@query("tf10_no_block_fallback", "SELECT p_partkey AS page_id, 'chapter' AS block_type, NULL::VARCHAR AS title, 'one two ' || p_name AS paragraphs FROM part")
def fallback(t):
    html = F.concat(F.lit("<body>  one\n\n two <b>"), "p_name", F.lit("</b></body>"))
    return parsed_blocks(_pages(t, html)).select("page_id", "block_type", "title", F.array_join("paragraphs", "|").alias("paragraphs"))


@query(
    "tf11_page_subtypes",
    "SELECT page_id, block, CASE WHEN block IN ('preface', 'footnote') THEN block WHEN page_id % 3 = 0 THEN 'study_guide' WHEN page_id % 3 = 1 THEN 'toc' ELSE block END AS subtype FROM (SELECT p_partkey AS page_id, ['preface', 'footnote', 'appendix', NULL][p_partkey % 4 + 1] AS block FROM part)",
)
def page_subtypes(t):
    block = _by(F.col("p_partkey") % 4, F.lit("preface"), F.lit("footnote"), F.lit("appendix"), F.lit(None).cast("string"))
    url = _by(F.col("p_partkey") % 3, F.lit("https://e.org/a/Guide.htm"), F.lit("https://e.org/a/index.html"), F.lit("https://e.org/a/ch01.htm"))
    return t.part.select(F.col("p_partkey").alias("page_id"), block.alias("block"), page_subtype(url, block).alias("subtype"))


@query(
    "tf14_key_values",
    "SELECT page_id, unnest(['First Published', 'Source', 'Transcription']) AS label, unnest([y || ' in a journal', p || ' Volume 2', 'Volunteers']) AS value FROM (SELECT o_orderkey AS page_id, year(o_orderdate)::VARCHAR AS y, o_orderpriority AS p FROM orders)",
)
def key_values(t):
    html = F.concat(F.lit('<body><p class="information"><span class="info">firstpub:</span> '), F.year("o_orderdate").cast("string"), F.lit(' in <i>a journal</i><br><span class="info">3.</span> x<br><span class="info">Transcription/HTML Markup:</span> Volunteers</p><p>Source: '), "o_orderpriority", F.lit("  Volume 2</p><p>Source: a later one</p></body>"))
    rows = _mapped(_pages(t, html, "o_orderkey", "orders"), "page_id long, url string, fields map<string,string>", lambda h, u: {"fields": list(html_blocks.header_fields(h).items())}, [("fields", pa.map_(pa.string(), pa.string()))])
    return rows.select("page_id", F.explode("fields").alias("label", "value"))


def title_dates(pages: DataFrame) -> DataFrame:
    """(page_id, title, date): the first of six headings that yields a date, else the document's title (TF-15)."""
    rows = _mapped(pages, "page_id long, url string, texts array<string>", lambda h, u: {"texts": html_blocks.heading_texts(h)}, [("texts", pa.list_(pa.string()))])
    dated = F.filter(F.transform("texts", lambda s: F.struct(s.alias("title"), parse_dateish(s).alias("date"))), lambda x: x["date"].isNotNull())
    return rows.select("page_id", F.get(dated, 0).alias("x")).filter("x IS NOT NULL").select("page_id", "x.title", "x.date")


@query("tf15_title_dates", "SELECT o_orderkey AS page_id, CASE k WHEN 0 THEN 'Speech of ' || y WHEN 1 THEN 'Notes, ' || y ELSE 'Collected in ' || y END AS title, y::INTEGER AS year FROM (SELECT o_orderkey, o_orderkey % 4 AS k, year(o_orderdate)::VARCHAR AS y FROM orders) WHERE k < 3")
def title_date_rows(t):
    y = F.year("o_orderdate").cast("string")
    late = F.concat(F.lit("<h3>x</h3>" * 6 + "<h3>Never reached "), y, F.lit("</h3>"))
    html = F.concat(
        F.lit("<html><head><title>"), F.when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("Collected in "), y)).otherwise("No date"), F.lit("</title></head><body>"),
        _by(F.col("o_orderkey") % 4, F.concat(F.lit("<h1> </h1><h2>No date</h2><h3>Speech of "), y, F.lit("</h3>")), F.concat(F.lit("<h1>Notes, "), y, F.lit("</h1><h2>Of 1848</h2>")), late, late), F.lit("</body></html>"),
    )
    return title_dates(_pages(t, html, "o_orderkey", "orders")).select("page_id", "title", F.col("date.year").alias("year"))


#: Phrases that state in a body when a text was published or written; the first group is the date.
_DAY = "(?:" + "|".join(m.capitalize() for m in MONTHS) + r")\s+[0-9]{1,2},?\s+[0-9]{4}"
BODY_DATES = (rf"(?i)(?:first published|published)\s+(?:in|on)\s+({_DAY})", rf"(?i)(?:written|composed)\s+(?:in|on)\s+({_DAY})", r"(?i)(?:first published|published)\s+in\s+([0-9]{4})")


def body_dates(paragraphs: Column) -> Column:
    """Dates that the first twenty paragraphs state, one for each phrase at most, of its first two places (TF-21)."""
    text = F.array_join(F.slice(paragraphs, 1, 20), " ")
    found = [F.get(F.filter(F.transform(F.slice(F.regexp_extract_all(text, F.lit(p), 1), 1, 2), lambda m: parse_dateish(m)), lambda d: d.isNotNull()), 0) for p in BODY_DATES]
    return F.filter(F.array(*found), lambda d: d.isNotNull())


@query(
    "tf21_body_dates",
    """SELECT o_orderkey AS page_id, year(d)::INTEGER AS year, CASE WHEN k < 2 THEN month(d) END::INTEGER AS month, CASE k WHEN 2 THEN 'year' ELSE 'day' END AS precision FROM (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 4 AS k FROM orders) WHERE k < 3""",
)
def body_date_rows(t):
    y, d = F.year("o_orderdate").cast("string"), F.dayofmonth("o_orderdate").cast("string")
    month = F.element_at(F.array(*(F.lit(m.capitalize()) for m in MONTHS)), F.month("o_orderdate"))
    said = _by(F.col("o_orderkey") % 4, F.concat(F.lit("It was First published on "), month, F.lit(" "), d, F.lit(", "), y, F.lit(".")), F.concat(F.lit("Composed in "), month, F.lit(" "), d, F.lit(", "), y), F.concat(F.lit("published in "), y), F.lit("undated"))
    early = F.array_repeat(F.lit("words"), 19)
    paragraphs = F.concat(early, F.array(said), F.array(F.lit("Written on May 1, 1848, too late to be read")))
    return t.orders.select(F.col("o_orderkey").alias("page_id"), F.explode(body_dates(paragraphs)).alias("d")).select("page_id", "d.year", "d.month", "d.precision")


_YEARS = pa.list_(pa.struct([("year", pa.int32()), ("score", pa.float64()), ("tag", pa.string())]))


def page_header_years(pages: DataFrame) -> DataFrame:
    """(page_id, url, year, score, tag): years from labelled lines at the top of pages, best first (DT-13)."""

    def make(html, url):
        return {"years": [{"year": y, "score": s, "tag": g} for y, s, g in header_years(html_blocks.parse(html).text("\n").split("\n"))]}

    rows = _mapped(pages, "page_id long, url string, years array<struct<year:int,score:double,tag:string>>", make, [("years", _YEARS)])
    return rows.select("page_id", "url", F.explode("years").alias("y")).select("page_id", "url", "y.*")


_HEADER_SQL = """h AS (SELECT o_orderkey AS page_id, o_custkey AS work, o_orderkey % 6 AS k, year(o_orderdate)::INTEGER AS y FROM orders),
 c AS (SELECT page_id, work, y AS year, [0.92, 0.90, 0.86, 0.84, 0.92, 0.70][k + 1]::DOUBLE AS score, ['first_published', 'publication_date', 'published', 'edition', 'first_published', 'translation_published'][k + 1] AS tag FROM h)"""


def _header_html() -> Column:
    y = F.year("o_orderdate").cast("string")
    lead = _by(
        F.col("o_orderkey") % 6,
        F.concat(F.lit("<p>First Published: in a paper, "), y, F.lit("</p>")),
        F.concat(F.lit("<p>Publication date: "), y, F.lit("; proofread 2004</p>")),
        F.concat(F.lit("<p>Published: <i>Gazette</i> of "), y, F.lit("</p>")),
        F.concat(F.lit("<p>First edition: "), y, F.lit("</p>")),
        F.concat(F.lit("<p><b>First Published</b> : "), y, F.lit("</p>")),
        F.concat(F.lit("<p>Published: Gazette. Translation published: "), y, F.lit("</p>")),
    )
    return F.concat(F.lit("<body><h1>A title</h1>"), lead, F.lit("<p>Source: 1977</p></body>"))


@query("dt13_header_years", f"WITH {_HEADER_SQL} SELECT page_id, year, score, tag FROM c")
def header_year_rows(t):
    return page_header_years(_pages(t, _header_html(), "o_orderkey", "orders")).select("page_id", "year", "score", "tag")


def header_lookups(works: DataFrame, pages: DataFrame, most: int = 12) -> DataFrame:
    """works(work, page_id, url), pages(page_id, html) -> (work, page_id, year, score, tag): header years of each work's first addresses (SRC-13).

    Addresses that look like a work's root come first, then short ones; pages that were not fetched give nothing.
    """
    root = (~F.lower("url").rlike(r"/(?:index|preface)[^/]*$")).cast("int")
    first = top_per_group(works.withColumns({"_root": root, "_size": F.length("url")}), most, ["work"], ["_root", "_size", "url", "page_id"]).select("work", "page_id", "url")
    read = page_header_years(first.join(pages, "page_id").select("page_id", "url", "html"))
    return first.join(read.drop("url"), "page_id").select("work", "page_id", "year", "score", "tag")


@query(
    "src13_header_lookups",
    f"WITH {_HEADER_SQL}, f AS (SELECT page_id FROM h QUALIFY row_number() OVER (PARTITION BY work ORDER BY page_id % 5 <> 0, length(page_id::VARCHAR) + CASE WHEN page_id % 5 = 0 THEN 6 ELSE 0 END, page_id % 5 <> 0, page_id::VARCHAR) <= 2) SELECT work, page_id, year, score, tag FROM c JOIN f USING (page_id)",
)
def header_lookup_rows(t):
    name = F.col("o_orderkey").cast("string")
    works = t.orders.select(F.col("o_custkey").alias("work"), F.col("o_orderkey").alias("page_id"), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("https://e.org/w/"), name, F.lit("/index"))).otherwise(F.concat(F.lit("https://e.org/w/"), name)).alias("url"))
    return header_lookups(works, _pages(t, _header_html(), "o_orderkey", "orders").select("page_id", "html"), 2)
