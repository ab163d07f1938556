import time

from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm import html_text
from scriptorium.llm.html_text import Page, common_lines, decide, extract, lines


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_alignment_is_longest(a, b):
    keep = sorted(common_lines(a, b))
    assert len(keep) == lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in keep)


def test_blocks():
    page = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="x">menu</a></li></ul></nav><div class="ad big">buy</div><article><header><h1>A &amp; B</h1></header><p><b>one<br>two<p>three  &eacute;\n x<ul><li>i1<li>i2</ul><aside>side</aside><form>f</form><div id="comments"><p>c</p></div><!-- <p>no</p> --></article><footer>foot</footer></body></html>'
    assert lines(page) == [(t, 2) for t in ("A & B", "one two", "three é x", "i1", "i2")]
    assert lines("<main><p>crumbs</p><article>text</article></main>") == [("crumbs", 1), ("text", 2)] and lines("<main>text</main>") == [("text", 1)]
    assert lines(None) == [] and lines("") == [] and lines("a < b <p>c") == [("a < b", 0), ("c", 0)]


def test_names_that_only_hold_marked_words_stay():
    for kept in ('div class="layout has-sidebar"', 'p class="social-contract"', 'p class="ad-hoc"', 'p id="related-work"', 'p data-id="ad"'):
        assert lines(f"<body><{kept}>text</body>") == [("text", 0)], kept
    for dropped in ('div class="big ad"', "div id=sidebar-left", "section class='comment-list'", 'div role="navigation"', 'div class="x cookie_notice"'):
        assert lines(f"<body><{dropped}>text</div></section><p>y</body>")[-1:] in ([("y", 0)], []) and ("text", 0) not in lines(f"<body><{dropped}>text</body>"), dropped


def test_markup_takes_linear_time():
    for page in ("<a " * 100_000, "<span>" * 50_000 + "</b>" * 50_000 + "<p>x" * 1000, '<a href="x ' * 50_000, "<!-- " * 50_000, "<li>" * 50_000):
        began = time.perf_counter()
        lines(page)
        assert time.perf_counter() - began < 2


def page_of(found, path="/a"):
    return Page((hash(path), 0), "h", path, tuple(hash(t) for t, _ in found), tuple(len(t) for t, _ in found), tuple(d for _, d in found))


def test_evidence():
    story = [(f"paragraph {i} of one story", 2) for i in range(4)]
    other = [(f"paragraph {i} of another", 2) for i in range(4)]
    third = [(f"paragraph {i} of a third", 2) for i in range(4)]
    share, side = ("Tell your friends", 2), ("Popular today", 0)
    both = decide(page_of([side, *other, share], "/1"), page_of([side, *story, share], "/2"), page_of([side, *third, share], "/3"))
    assert both == [1, 2, 3, 4]
    # a line amid the article's own stays
    amid = decide(page_of([*other[:2], share, *other[2:]], "/1"), page_of([*story[:2], share, *story[2:]], "/2"), page_of([*third[:2], share, *third[2:]], "/3"))
    assert amid == [0, 1, 2, 3, 4]
    # one neighbour is no proof against an article's line; a copy is none at all
    assert decide(page_of([side, *other, share], "/1"), page_of([side, *story, share], "/2"), None) == [1, 2, 3, 4, 5]
    assert decide(page_of([*story, share], "/1"), page_of([*story, share], "/2"), page_of([*third, share], "/3")) == [0, 1, 2, 3, 4]
    # a teaser in an article element does not hide the page
    long = [(f"a long line of the page, number {i}, that goes on and on", 1) for i in range(5)]
    assert decide(None, page_of([("teaser", 2), *long]), None) == [0, 1, 2, 3, 4, 5]
    assert decide(None, page_of([]), None) == []


def test_differencing_drops_shared_lines_outside_articles(spark):
    page = lambda body: f"<body><div>Site name</div><p>{body}</p><div>All about us</div></body>"
    rows = [(1, "http://h.org/a/1", page("first text")), (2, "http://www.h.org/a/2?x=1", page("second text")), (3, "http://other.org/a/1", page("alone")), (4, None, None), (5, "http://h.org/a/9", "<article><p>same</p></article>"), (6, "http://h.org/a/9", "<article><p>same</p></article>"), (7, None, page("x")), (7, None, page("x")), (None, "http://h.org/a/1", "")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int")
    want = {1: ("first text", 10), 2: ("second text", 11), 3: ("Site name\nalone\nAll about us", 28), 4: ("", 0), 5: ("same", 4), 6: ("same", 4), 7: ("Site name\nx\nAll about us", 24), None: ("", 0)}
    for partitions in ("1", "3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = extract(pages).collect()
        assert len(got) == len(rows) and {r.page_id: (r.text, r.n_chars) for r in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert extract(pages.limit(0)).collect() == []


def test_tables_by_brute_force(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    split = pages.selectExpr("page_id", "html", r"regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^(www|m)\\.', '') AS host", "regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path").collect()
    rows = sorted((r.host, r.path, r.page_id, r.html) for r in split)
    read = [Page((r[2], 0), r[0], r[1], tuple(t for t, _ in f), tuple(len(t) for t, _ in f), tuple(d for _, d in f)) for r in rows for f in [lines(r[3])] if f]
    expected = lambda: {p.key[0]: "\n".join(p.hashes[i] for i in decide(a, p, b)) for a, p, b in zip([None, *read], read, [*read[1:], None], strict=False)}
    want, results = expected(), []
    for partitions in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append({r.page_id: r.text for r in extract(pages).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == {r[2]: want.get(r[2], "") for r in rows}
    monkeypatch.setattr(html_text, "common_lines", lambda a, b: set())
    assert expected() != want  # without alignment the tables come out otherwise
