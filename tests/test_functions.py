import itertools
import uuid

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import dates, identity, names, text, urls
from scriptorium.operators import html_blocks
from scriptorium.operators.graph import breadth_first, components
from scriptorium.operators.identity_resolution import name_clusters
from scriptorium.plans import date_pipeline, extraction
from scriptorium.sources.sinks import insert_absent, overwrite


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_uuid5(spark):
    values = ["Karl", " Karl ", "Ünïcode  ", "", "日本"]
    assert column(spark, values, identity.author_id) == [str(uuid.uuid5(uuid.UUID(identity.AUTHOR), v.strip())) for v in values]


def test_parse_dateish(spark):
    cases = {
        "Written 4 March 1919 in May": (1919, 3, 4, "day"), "March 4th, 1923": (1923, 3, 4, "day"), "32 Sept 1920": (1920, 9, 32, "day"), "5 Brumaire 1799": (1799, None, None, "year"),
        "No. 11918": None, "in 2039 or 2040": (2039, None, None, "year"), "": None, "May 1, 1900": (1900, 5, 1, "day"),
    }
    assert [r and tuple(r) for r in column(spark, list(cases), dates.parse_dateish)] == list(cases.values())
    assert column(spark, [None], dates.parse_dateish) == [None]


def test_url_date(spark):
    cases = {"/a/1917/04/03.htm": (1917, 4, 3, "day"), "/1978/28.htm": (1978, None, None, "year"), "/1905/13/": (1905, None, None, "year"), "/1905/12/": (1905, 12, None, "month"), "/1905/12/40.htm": (1905, 12, None, "month"), "/1499/": None, "/1917": None}
    assert [r and tuple(r) for r in column(spark, list(cases), dates.url_date)] == list(cases.values())


def test_year_ranges(spark):
    assert column(spark, ["from 1844-45, 1848–1850 and 1844", "none"], dates.years_of_ranges) == [[1844, 1845, 1848, 1850], []]


def test_sentences(spark):
    assert column(spark, ["One. Two! “Three” is? 4 ends. not split.", "  a b.   C ", ""], text.sentences) == [["One.", "Two!", "“Three” is?", "4 ends. not split."], ["a b.", "C"], []]


def test_urls(spark):
    cases = {" HTTP://Ex.org/A b/?q=1#f": "http://ex.org/Ab/", "//Ex.org/x": "https://ex.org/x", "https://e.org": "https://e.org"}
    once = column(spark, list(cases), urls.canonical_url)
    assert once == list(cases.values()) and column(spark, once, urls.canonical_url) == once
    assert column(spark, ["https://e.org/a/b/c.htm?x", "https://e.org/a/b/"], urls.directory) == ["https://e.org/a/b", "https://e.org/a"]
    assert column(spark, ["https://e.org/a.PDF", "https://e.org/a.htm", "https://e.org/"], urls.is_html) == [False, True, True]
    assert column(spark, ["https://e.org/subject/archive/x.htm", "https://e.org/archive/x?y", "https://e.org/archive/a/b/c/d/e/f", "https://e.org/a/b/c/d/e/f", "https://e.org/a/b/c/d/e/f.htm", "https://e.org"], urls.likely_content) == [False, False, True, False, True, True]


def test_titles():
    assert names.title_form("579.  THE STATE OF\tTHE USSR AND VOL. IV") == "579. The State of the USSR and Vol. IV"
    assert names.title_form("Already Fine Title") == "Already Fine Title" and names.title_form("SHORT") == "SHORT" and names.title_form(None) is None


@settings(max_examples=60)
@given(st.text("ABC def'.1", max_size=30))
def test_titles_settle(title):
    once = names.title_form(title)
    assert names.title_form(once) == once or once.isupper()


def test_names(spark):
    assert column(spark, ["Karl  Marx Jr.", "V. I. Lenin III"], names.match_form) == ["karl marx", "v i lenin"]
    assert names.ratio("tide", "diet") == 0.25 and names.ratio("diet", "tide") == 0.5
    assert column(spark, ["Karl Heinrich Marx", "Plato"], names.sort_name) == ["Marx, Karl Heinrich", "Plato"]


def test_name_clusters_against_all_pairs(spark):
    people = ["Vladimir Lenin", "V. I. Lenin", "Lenin", "Karl Marx", "K. Marx", "Karl Marks", "Rosa Luxemburg", "Rosa Luxembourg", "Leon Trotsky", "Lev Trotskii", "Mao", "Antonio Gramsci", "A Gramschi"]
    rows = [(i, n, len(people) - i) for i, n in enumerate(people)]
    frame = spark.createDataFrame(rows, "id long, name string, works int")
    forms = column(spark, people, names.match_form)
    group = list(range(len(people)))
    for a, b in itertools.combinations(range(len(people)), 2):
        if names.same_author_forms(forms[a], forms[b], 0.85):
            group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    assert {r.id: r.component for r in name_clusters(frame).collect()} == dict(enumerate(group))


def test_graphs(spark):
    nodes = spark.range(12)
    edges = spark.createDataFrame([(i, i + 1) for i in range(5)] + [(8, 7), (9, 8)], "src long, dst long")
    assert sorted(tuple(r) for r in components(nodes, edges).collect()) == [(i, 0 if i <= 5 else 7 if 7 <= i <= 9 else i) for i in range(12)]
    links = spark.createDataFrame([(0, 1, 0), (0, 2, 1), (2, 3, 0), (1, 3, 1), (3, 0, 0), (3, 4, 1), (4, 5, 0)], "src long, dst long, place int")
    assert sorted(tuple(r) for r in breadth_first(spark.createDataFrame([(0,)], "id long"), links, 3).collect()) == [(0, 0, None), (1, 1, 0), (2, 1, 0), (3, 2, 1), (4, 3, 3)]


PAGE = """<html><head><title>Preface by Frederick Engels</title></head><body><div class="topnav">x</div><div id="content"><p>Lead text<br>goes on<p class="information"><span class="info">Written:</span> 4 March 1919;<br>
<span class="info">Source:</span> Pravda No. 4<p class="intro">Intro</p><h2>Preface by Frederick Engels</h2><p>One.</p><p>Back to top</p><ul><li><p>Item</ul><script>var a = "</p>";</script><h3></h3><h3>Notes</h3></div></body></html>"""


def test_html_blocks():
    got = html_blocks.blocks(PAGE)
    assert [(b["title"], b["level"], b["author"], b["paragraphs"]) for b in got] == [(None, 1, None, ["Lead text goes on"]), ("Preface by Frederick Engels", 2, "Frederick Engels", ["One.", "Item"]), ("Notes", 3, None, [])]
    assert html_blocks.header_fields(PAGE) == {"Written": "4 March 1919;", "Source": "Pravda No. 4"}
    assert html_blocks.blocks("<body>just\n text</body>")[0]["paragraphs"] == ["just text"] and html_blocks.blocks(None) == []
    assert html_blocks.links('<a href="#x"></a><a href="b?c">1</a><area href="/d"><a href="mailto:e">', "http://h.org/a/") == ["http://h.org/a/b?c", "http://h.org/d"]


def test_lifespan_boundaries_and_ties(spark):
    d = "struct<year:int,month:int,day:int,precision:string>"
    rows = [(1, "first_publication_date", (1905, None, None, "year"), 0.9, "openlibrary"), (2, "first_publication_date", (1906, None, None, "year"), 0.9, "openlibrary"), (3, "first_publication_date", (1906, None, None, "year"), 0.8, "wikidata"), (4, "first_publication_date", (1809, None, None, "year"), 0.8, "wikidata"), (5, "first_publication_date", (1810, None, None, "year"), 0.8, "wikidata")]
    frame = spark.createDataFrame([(*r, None, None, 1820, 1900) for r in rows], f"work_id int, role string, date {d}, confidence double, source string, locator string, notes string, birth int, death int")
    got = {r.work_id: (r.role, round(r.confidence, 3), r.notes) for r in date_pipeline.within_lifespan(frame).collect()}
    first = "first_publication_date"
    assert got == {1: (first, 0.9, None), 2: ("edition_publication_date", 0.4, "after_death_openlibrary_demoted"), 3: (first, 0.12, "after_death_penalized"), 4: (first, 0.12, "before_birth_penalized"), 5: (first, 0.8, None)}
    tied = spark.createDataFrame([(1, first, (1900 + i, None, None, "year"), 0.9, s, loc, None) for i, (s, loc) in enumerate([("b", None), ("a", "z"), ("a", None)])], f"work_id int, role string, date {d}, confidence double, source string, locator string, notes string")
    assert [(r.display_year, r.display_source) for r in date_pipeline.bundle(tied).collect()] == [(1902, "a")]


def test_json_objects():
    assert extraction.first_json_object('x {bad} ```json\n{"a": {"b": "}"}}``` {"c": 1}') == '{"a": {"b": "}"}}'
    assert extraction.first_json_object(None) is None and extraction.first_json_object("[1]") is None


def test_sinks(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, insert_absent(old, new, ["k"]).collect()), key=repr) == [(1, "a"), (2, None), (3, "c")]
    assert sorted(map(tuple, overwrite(old, new.filter("v <> 'd'"), ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_header_years():
    from scriptorium.plans.catalog import header_years

    lines = ["Title", "First Published:", "in Pravda, 4 May 1917;", "Source: Works 1964", "Published", ": February 1848; Transcribed 1999", "Translation: x", "first  edition: 1850, translation published 1901"]
    assert header_years(lines) == [(1917, 0.92, "first_published"), (1848, 0.86, "published"), (1850, 0.84, "edition")]
    assert header_years(["Fragment first published in 1940"]) == [] and header_years([]) == []


def test_files(spark, tmp_path):
    from scriptorium.sources import files

    (tmp_path / "raw").mkdir()
    for name in ("a", "b"):
        (tmp_path / "raw" / f"{name}.html").write_text("<p>é</p>")
    objects = files.raw_objects(spark, str(tmp_path / "raw")).collect()
    assert [o.html for o in objects] == ["<p>é</p>"] and files.raw_objects(spark, str(tmp_path / "raw"), 3).collect() == []
    (tmp_path / "m.json").write_text('{"root_url": "r", "snapshots": [{"url": "u1", "sha256": "s1"},\n {"url": "u2"}, {"url": "u3"}]}')
    (tmp_path / "bad.json").write_text("{'root_url': 'r'}")
    pages = files.manifest_pages(spark, str(tmp_path / "m.json"), 2)
    assert [(p.root_url, p.place, p.url, p.sha256) for p in pages.collect()] == [("r", 0, "u1", "s1"), ("r", 1, "u2", None)]
    assert files.manifest_pages(spark, str(tmp_path / "bad.json")).collect() == []
    files.write_manifests(pages, str(tmp_path / "out"))
    again = spark.read.json(str(tmp_path / "out")).collect()[0]
    assert [s.url for s in again.snapshots] == ["u1", "u2"]
    rows = files.mapping(spark, "Karl Marx: [K. Marx, Marx]\nLenin:\n  display: V. I. Lenin\n  aliases: [Ulyanov]\n").collect()
    assert [tuple(r) for r in rows] == [("K. Marx", "Karl Marx", "Karl Marx"), ("Marx", "Karl Marx", "Karl Marx"), ("Ulyanov", "Lenin", "V. I. Lenin")]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"a": oops}\n')
    assert sorted((r.a or 0, r._corrupt or "") for r in files.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [(0, '{"a": oops}'), (1, "")]


def test_replies(spark):
    import pytest

    from scriptorium.functions import replies

    assert replies.canonical_json('{"b": [1, 2],\n "a": null}') == '{"a":null,"b":[1,2]}' and replies.canonical_json("{") is None
    assert replies.repaired_keys({"gloss:": "x", " label ": [{"k :": 1}]}) == {"gloss": "x", "label": [{"k": 1}]}
    prose = "A long explanation in prose of the term."
    assert replies.repaired_keys({"original_term_vernacular:": prose}) == {"original_term_vernacular": None, "gloss": prose}
    frame = spark.createDataFrame([("is",), (None,)], "m string")
    assert frame.select(replies.checked_label(F.col("m"), ("is", "must"), "modality")).count() == 2
    with pytest.raises(Exception, match="unknown modality"):
        spark.createDataFrame([("might",)], "m string").select(replies.checked_label(F.col("m"), ("is",), "modality")).collect()


def test_completions(spark):
    from scriptorium.sources.model import completions, pending

    def client():
        seen = {}

        def answer(prompt):
            n = seen[prompt] = seen.get(prompt, 0) + 1
            if prompt.startswith("down"):
                raise OSError("offline")
            if prompt.startswith("late") and n < 2:
                raise OSError("offline")
            if prompt == "prose":
                return "no object here"
            return 'Sure: {"b": 1, "a": 2}' if prompt != "null" else "[]"

        return answer

    prompts = spark.createDataFrame([(1, "fine"), (2, "late"), (3, "down"), (4, "prose"), (5, "null")], "key long, prompt string").coalesce(1)
    got = {r.key: (r.reply, r.attempts, r.error) for r in completions(prompts, client).collect()}
    good = '{"a":2,"b":1}'
    assert got == {1: (good, 1, None), 2: (good, 2, None), 3: (None, 3, "OSError: offline"), 4: (good, 2, None), 5: (good, 2, None)}
    done = spark.createDataFrame([(1, "a", "v1", "success"), (1, "b", "v1", "success"), (2, "a", "v1", "success"), (3, "a", "v0", "success"), (3, "b", "v1", "failed")], "key long, task string, version string, status string")
    assert sorted(r.key for r in pending(prompts, done, "v1", ("a", "b")).collect()) == [2, 3, 4, 5]


def test_contracts():
    from scriptorium.functions import contracts

    good = {"claims": [{"claim_text": "x", "evidence": [0, 2.0], "polarity": None, "confidence": 1}]}
    assert contracts.violations(good, contracts.CLAIMS) == [] and contracts.violations({"claims": []}, contracts.CLAIMS) == []
    bad = {"claims": [{"claim_text": "", "evidence": [True, -1], "polarity": "maybe", "confidence": "1"}, 3]}
    assert contracts.violations(bad, contracts.CLAIMS) == [
        "$.claims[0].claim_text: too short", "$.claims[0].polarity: not allowed", "$.claims[0].confidence: not number or null", "$.claims[0].evidence[0]: not integer", "$.claims[0].evidence[1]: below 0", "$.claims[1]: not object",
    ]
    closed = {"type": "object", "properties": {"a": {"type": ["string", "integer"]}, "b": {"type": "array", "items": {"type": "boolean"}}}, "additionalProperties": False}
    assert contracts.violations({"a": 1.5, "c": 0}, closed) == ["$.c: unknown", "$.a: not string or integer"]
    assert contracts.ddl(closed) == "struct<`a`:string,`b`:array<boolean>>" and contracts.columns(closed) == [("a", "string", False), ("b[]", "boolean", False)]


def test_integrity_gates_of_a_broken_build(spark):
    from scriptorium.plans.corpus import integrity_gates, paragraphs, sentence_spans

    docs = spark.createDataFrame([(1, "One. Two.\n\nThree.", "s", "en"), (2, "Four.", "s", "en")], "doc_id long, text string, source string, lang string")
    paras, spans = paragraphs(docs), sentence_spans(docs)
    gates = lambda p, s: {r.gate: r.violations for r in integrity_gates(p, s).collect()}
    assert set(gates(paras, spans).values()) == {0}
    lost = paras.withColumn("text", F.when(F.col("doc_id") == 2, F.lit(" ")).otherwise(F.col("text")))
    assert gates(lost, spans)["empty_paragraph"] == 1 and gates(paras.withColumn("text", F.lit(None).cast("string")), spans)["empty_paragraph"] == 3
    assert gates(paras, spans.unionAll(spans.filter("sent_index = 1")))["duplicate_span"] == 1
    assert gates(paras.filter("doc_id = 1"), spans)["orphan_sentence"] == 1


def test_a_batch_done_twice_adds_nothing(spark, tmp_path):
    from scriptorium.streaming.incremental import keyed_append

    path, rows = str(tmp_path / "rows"), lambda *keys: spark.createDataFrame([(k, "v") for k in keys], "k int, v string")
    sink = keyed_append(path, ["k"], "a")
    sink(rows(1, 2, 2), 0)
    sink(rows(2, 3), 1)
    sink(rows(2, 3), 1)  # as after a crash between write and commit
    keyed_append(path, ["k"], "b")(rows(1, 3, 4), 0)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_names_do_not_all_meet_by_a_common_word(spark):
    import hashlib

    from scriptorium.operators.identity_resolution import candidate_pairs

    h = lambda i: hashlib.md5(str(i).encode()).hexdigest().translate(str.maketrans("0123456789abcdef", "bcdfghklmnprstvz"))
    rows = [(i, i, f"{h(i)[:8]} karl {h(i)[8:18]}") for i in range(300)]
    pairs = candidate_pairs(spark.createDataFrame(rows, "id long, rank long, form string"))
    assert pairs.count() < 300 * 299 // 2 // 4


def test_names_alike_by_last_word_or_as_a_whole_are_all_candidates(spark):
    import random

    from scriptorium.operators.identity_resolution import candidate_pairs, key_plan, longest, subsequence_keys

    draw = random.Random(1)
    letters = lambda n, of="bcdfghklmnprstvz": "".join(draw.choice(of) for _ in range(n))

    def edited(s):
        for _ in range(draw.randint(1, 4)):
            i = draw.randrange(len(s) + 1)
            s = draw.choice([s[:i] + letters(1) + s[i:], s[:i] + s[i + 1 :], s[:i] + letters(1) + s[i + 1 :]])
        return s

    # every pair of short strings that reaches the ratio has a key in common
    base = [letters(draw.randint(1, 21), draw.choice(["ab", "bcdfghklmnprstvz"])) for _ in range(150)]
    strings = sorted({s for b in base for s in (b, edited(b), edited(b)) if 0 < len(s) <= longest(0.85)})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(strings))), pa.array(strings), pa.array(range(len(strings)))], ["id", "text", "skip"])
    keys = [set() for _ in strings]
    for found in subsequence_keys(key_plan(sorted({len(s) for s in strings}), 0.85))([batch]):
        for key, i in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
            keys[i].add(key)
    alike = [(i, j) for i, j in itertools.permutations(range(len(strings)), 2) if names.reaches(strings[i], strings[j], 0.85)]
    assert len(alike) > 100 and all(keys[i] & keys[j] for i, j in alike)

    # links of all kinds, of short and long names, with last words that are alike though the names are not
    people = [f"{a} {b}" for a in ("karl", "rosa maria", "k", "maximilianusbonaventura", "wolfgangtheophilusamadeus") for b in ("petersen", "petersan", "zetkin")]
    people += ["petersen", "petersan", "hjalmar horace greeley schacht", "hjalmar horace greely schacht", "hjalmar schacht", "", "éva kovács", "éva kovacs"]
    frame = spark.createDataFrame([(i, i, n) for i, n in enumerate(people)], "id long, rank long, form string")
    got = {(r.src, r.dst) for r in candidate_pairs(frame).collect() if names.same_author_forms(r.x, r.y, 0.85)}
    assert got == {(i, j) for i, j in itertools.combinations(range(len(people)), 2) if names.same_author_forms(people[i], people[j], 0.85)}

    # names without a likeness make hardly any pair
    many = spark.createDataFrame([(i, i, f"{letters(8)} {letters(10)}") for i in range(3000)], "id long, rank long, form string")
    assert candidate_pairs(many).count() < 30


def test_settled_clusters_hold_no_chance_likeness(spark):
    people = ["Rosa Luxemburg", "R. Luxemburg", "Rosa Luxembourg", "Antonio Gramsci", "A. Gramschi", "Lenin", "Vladimir Lennin", "Karl Petersen", "Rosa Petersan", "K. Petersan"]
    frame = spark.createDataFrame([(i, n, len(people) - i) for i, n in enumerate(people)], "id long, name string, works int")
    got = lambda **how: [c for _, c in sorted((r.id, r.component) for r in name_clusters(frame, **how).collect())]
    assert got() == [0, 0, 0, 3, 3, 5, 5, 7, 7, 7]
    assert got(settle=True) == [0, 0, 0, 3, 3, 5, 5, 7, 8, 7]  # two first names are two authors; K. Petersan can only be Karl


@pytest.mark.parametrize("name", ["gr04_name_clusters", "q27_merge_proposal"])
def test_authors_with_last_names_alike_by_chance(spark, tmp_path, name):
    from oracle import rows_of

    from scriptorium import registry

    registry.load()
    # last names of full names, of initials, and of lone words that differ in a letter or two
    keys = [44711, 72652, 40992, 61041, 19798, 16253, 5130, 152170, 22186, 423008, 9743, 388723, 1, 2, 3, 30]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = registry.QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = db.execute(registry.ORACLES[name])
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())


def test_resume_where_ids_of_pages_reach_those_of_children(spark, tmp_path):
    from oracle import rows_of

    from scriptorium import registry

    registry.load()
    rows = [(i, kind) for i, kind in [(0, "view"), (1, "error"), (7, "view"), (1_000_000, "click"), (1_000_001, "error"), (1_000_007, "view"), (2_000_007, "error")]]
    spark.createDataFrame(rows, "event_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.QUERIES["gr03_resume"](spark, str(tmp_path))
    want = {(i,) for i, kind in rows if kind == "error"} | {(i + 1_000_000,) for i, kind in rows if kind == "view"}
    assert rows_of(got.columns, got.collect()) == sorted(want, key=repr)


def test_time_to_live_to_the_microsecond(spark, tmp_path):
    from datetime import datetime

    from oracle import rows_of

    from scriptorium import registry

    registry.load()
    at = lambda *x: datetime(2024, 1, 30, *x)
    rows = [(1, at(23, 59, 25, 261702)), (2, at(22, 59, 25, 261702)), (3, at(22, 59, 25, 261701)), (4, at(22, 59, 25)), (5, at(22, 59, 26)), (6, None), (7, at(1)), (7, at(23))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.QUERIES["st06_time_to_live"](spark, str(tmp_path))
    want = [(1, True), (2, True), (3, False), (4, False), (5, True), (6, None), (7, False), (7, True)]
    assert rows_of(["event_id", "fresh"], got.select("event_id", "fresh").collect()) == sorted(want, key=repr)


def test_dates_in_titles_and_bodies(spark):
    from scriptorium.plans.page_rules import body_dates, title_dates

    pages = spark.createDataFrame([(1, "u", "<title>In 1848</title><body><h1>None</h1><h2>Of 4 May 1917</h2></body>"), (2, "u", "<title>In 1848</title><body><h1>None</h1></body>"), (3, "u", None)], "page_id long, url string, html string")
    assert sorted((r.page_id, r.title, r.date.year, r.date.day) for r in title_dates(pages).collect()) == [(1, "Of 4 May 1917", 1917, 4), (2, "In 1848", 1848, None)]
    texts = ["It was first published in March 4, 1899, and written on May 2 1898. Published in 1901", "First published on Brumaire 1, 1799; published in 9999 and published in 1888 and published in 1777", "published 1900"]
    rows = spark.createDataFrame([(i, [t]) for i, t in enumerate(texts)], "i int, p array<string>")
    found = [[(d.year, d.precision) for d in r.d] for r in rows.orderBy("i").select(body_dates(F.col("p")).alias("d")).collect()]
    assert found == [[(1899, "day"), (1898, "year"), (1901, "year")], [(1888, "year")], []]


def test_outcomes_of_tries(spark):
    from scriptorium.sources.queries import fetch_outcomes

    tries = [("a", 1, 500), ("a", 2, 304), ("b", 1, 500), ("b", 2, 500), ("b", 3, 500), ("b", 4, 200), ("c", 1, 404)]
    got = {r.url: (r.outcome, r.attempts, r.waited) for r in fetch_outcomes(spark.createDataFrame(tries, "url string, attempt int, status int")).collect()}
    assert got == {"a": ("cached", 2, 2), "b": ("error", 3, 6), "c": ("error", 1, 0)}


def test_relational_scan(spark):
    from scriptorium.sources.tables import jdbc_table

    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(20).selectExpr("id", "id % 3 AS k").write.format("jdbc").options(url="jdbc:derby:memory:works;create=true", dbtable="works", **options).mode("overwrite").save()
    rows = jdbc_table(spark, "jdbc:derby:memory:works", "works", "ID", (0, 20), 4, **options)
    assert rows.rdd.getNumPartitions() == 4 and rows.filter("k = 1").count() == 7


def test_places_of_a_hot_group(spark):
    from scriptorium.operators.windows import placed

    rows = [("hot" if i % 4 else None if i % 8 else "cold", i, i % 5) for i in range(400)]
    frame = spark.createDataFrame(rows, "g string, i long, c long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = placed(frame, ["g"], ["i"], "c").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 400
    for g in ("hot", "cold", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: r.i)
        assert [r.place for r in own] == list(range(len(own)))
        assert [r.spent_before for r in own] == list(itertools.accumulate([0, *(r.c for r in own[:-1])]))
