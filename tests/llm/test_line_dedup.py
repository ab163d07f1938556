import random
import time

import pytest

from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm import line_dedup
from scriptorium.llm.line_dedup import duplicate_lines, line_keys, rests, tolerated, within, without_duplicate_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@given(st.text("abc", max_size=24), st.text("abc", max_size=24), st.integers(0, 4))
def test_distance(a, b, k):
    assert within(a, b, k) == (distance(a, b) <= k)


@given(st.text("abcdefgh", min_size=10, max_size=60), st.lists(st.tuples(st.sampled_from("ird"), st.integers(0, 59), st.sampled_from("abx")), max_size=5), st.integers(0, 4))
def test_distance_of_near_lines(line, edits, k):
    other = edited(line, edits)
    assert within(line, other, k) == (distance(line, other) <= k) == within(other, line, k)


def edited(line, edits):
    for kind, at, c in edits:
        at = min(at, len(line))
        line = line[:at] + ("" if kind == "d" else c) + line[at + (kind != "i") :]
    return line


@given(st.text("ab", min_size=20, max_size=40), st.lists(st.tuples(st.sampled_from("ird"), st.integers(0, 39), st.sampled_from("abx")), max_size=3))
def test_close_lines_share_a_key(line, edits):
    other = edited(line, edits)
    for most in (1, 2, 3):
        if distance(line, other) <= tolerated(min(len(line), len(other)), 7, most):
            keys, owners = line_keys([line, other], 7, most)
            assert set(keys[owners == 0]) & set(keys[owners == 1])


@given(st.text("ab", max_size=30), st.lists(st.tuples(st.sampled_from("ird"), st.integers(0, 29), st.sampled_from("abx")), max_size=2))
def test_close_rests_share_a_name(rest, edits):
    other = edited(rest, edits)
    for t in (1, 2):
        if distance(rest, other) <= t:
            mine, its = dict.fromkeys(rests(rest, t)), dict.fromkeys(rests(other, t))
            shared = {(n, left is None) for n, left in mine} & {(n, left is None) for n, left in its}
            assert shared
            # some shared name leaves rests that are as close, so cutting can go on
            assert any(final or min(distance(x, y) for n, x in mine if n == name and x is not None for m, y in its if m == name and y is not None) <= t for name, final in shared)


def brute(rows, per_edit, most):
    """First lines stay; a line linked over any chain to an earlier first is removed."""
    spots = [(d is None, d or 0, i, line.strip()) for d, text in dict.fromkeys(rows) if text is not None for i, line in enumerate(text.split("\n")) if line.strip()]
    lines = sorted({s[3] for s in spots})
    group = {s: s for s in lines}

    def find(s):
        while group[s] != s:
            s = group[s]
        return s

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if distance(a, b) <= tolerated(min(len(a), len(b)), per_edit, most):
                group[find(a)] = find(b)
    first = {}
    for s in sorted(spots):
        first.setdefault(find(s[3]), s[:3])
    removed = {}
    for s in spots:
        if first[find(s[3])] != s[:3]:
            removed.setdefault(None if s[0] else s[1], set()).add(s[2])
    return sorted((repr(d), len(text.split("\n")) if text is not None else 0, sorted(removed.get(d, ()))) for d, text in dict.fromkeys(rows))


def got(df):
    return sorted((repr(r.doc_id), r.n_lines, list(r.removed)) for r in df.collect())


@pytest.mark.parametrize("hot", [1024, 2])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(8, 45))).strip() for _ in range(10)]
    base += [f"one beginning that many lines share {rng.randrange(10**6):06d}" for _ in range(8)]

    def near(line):
        at = rng.randrange(len(line))
        return rng.choice([line, line[:at] + "z" + line[at:], line[:at] + line[at + 1 :], line[:at] + "q" + line[at + 1 :]])

    rows = [(d, "\n".join(near(rng.choice(base)) for _ in range(rng.randint(1, 5)))) for d in range(30)]
    rows += [(90, None), (91, ""), (92, "a\n\n a \nb"), (93, "b\n" + base[0] * 300), (94, base[0] * 300 + "\nx"), (94, base[0] * 300 + "\nx"), (None, "b\nnew")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, version int")
    for per_edit, most in ((10, 2), (20, 1), (1, 1)) if hot > 2 else ((10, 2),):
        assert got(duplicate_lines(docs, per_edit, most)) == brute(rows, per_edit, most)


def test_many_lines_with_one_beginning(spark):
    """Lines that share a beginning and link with none do not meet one another."""
    rng = random.Random(9)
    took = {}
    for n in (1000, 4000, 16_000):
        lines = ["a beginning that every line of the log shares: " + "".join(rng.choice("0123456789abcdef") for _ in range(24)) for _ in range(n)]
        docs = spark.createDataFrame([(d, "\n".join(lines[d : d + 100])) for d in range(0, n, 100)] + [(n, lines[7] + "!")], "doc_id long, text string")
        began = time.perf_counter()
        assert [(r.doc_id, list(r.removed)) for r in duplicate_lines(docs).filter("n_removed > 0").collect()] == [(n, [0])]
        took[n] = time.perf_counter() - began
    assert took[16_000] < 6 * max(took[4000], 4)


def test_tables_exact_lines(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    seen, want = set(), 0
    for _, text in sorted(rows):
        for line in text.split("\n"):
            want += bool(line.strip()) and line.strip() in seen
            seen.add(line.strip())
    assert sum(r.n_removed for r in duplicate_lines(docs, 10**9).collect()) == want
    assert sum(r.n_removed for r in duplicate_lines(docs).collect()) >= want


def test_rebuilt_texts(spark):
    rows = [(1, "one line that repeats itself\nown", "en", "s", 32), (2, "one line that repeats itself!\nother", "en", None, 36), (3, "one line that repeats itself", None, "s", 28), (4, None, None, None, None), (5, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: (r.text, r.n_chars) for r in without_duplicate_lines(docs).collect()}
    assert left == {1: (rows[0][1], 32), 2: ("other", 5), 4: (None, None), 5: ("", 0)}
    assert without_duplicate_lines(docs.limit(0)).collect() == []
