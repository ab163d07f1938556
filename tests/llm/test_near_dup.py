import numpy as np
import pytest

from scriptorium.llm import near_dup
from scriptorium.llm.common import WordIds, ascii_words
from scriptorium.llm.graph import connected_components
from scriptorium.llm.near_dup import likelihood_jaccard, near_duplicates, registers, shingle_set


def brute(rows, k, percent):
    """Components by comparing all pairs of plain shingle sets."""
    sets = []
    for _, text in rows:
        w = ascii_words(text)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(groups[find(i)]), d == min(groups[find(i)])) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_tables_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(near_duplicates(docs, 2)) == brute(rows, 2, 80)
    assert got(near_duplicates(docs)) == brute(rows, 5, 80)


@pytest.mark.parametrize("hot", [near_dup.HOT, 1])
def test_near_copies_chains_ties_and_small_sets(spark, monkeypatch, hot):
    monkeypatch.setattr(near_dup, "HOT", hot)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(12)]
    rows += [(20, " ".join(base)), (21, " ".join(base)), (22, ""), (23, "  \t"), (24, "one"), (25, "ONE"), (26, "one two"), (27, "é É"), (28, "É É")]
    step = [f"c{i}" for i in range(40)]
    rows += [(40 + t, " ".join(step[t : t + 30])) for t in range(8)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_shingles string")
    assert got(near_duplicates(docs, 2)) == brute(rows, 2, 80)


def test_nulls_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(1, None), (5, "a b c"), (5, "a b c"), (3, "a b c")], "doc_id long, text string")
    assert got(near_duplicates(docs, 2)) == [(1, 0, 1, True), (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False)]
    lost = spark.createDataFrame([(None, "q r s"), (None, None)], "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(lost, 2).collect()} == {(None, 2, None, True), (None, 0, None, True)}
    assert near_duplicates(docs.limit(0), 2).collect() == []


def test_registers_merge_and_estimate(spark):
    ids = WordIds()
    a, b = [shingle_set(ids.array([b"%d" % i for i in r]), 1) for r in (range(900), range(100, 1000))]
    ra, rb, union = registers([a]), registers([b]), registers([np.union1d(a, b)])
    assert (np.maximum(ra, rb) == union).all()
    est = likelihood_jaccard(ra, rb, np.array([900.0]), np.array([900.0]))[0]
    assert abs(est - 0.8) < 0.12


def test_components_against_search(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for s in sorted(near):
        todo = [s] if s not in want else []
        while todo:
            n = todo.pop()
            if n not in want:
                want[n] = s
                todo += near[n]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {n: r for n, r in want.items() if near[n] != {n}}


@pytest.mark.parametrize("hot", [near_dup.HOT, 1])
def test_half_alike_pages_and_links_among_them(spark, monkeypatch, hot):
    monkeypatch.setattr(near_dup, "HOT", hot)
    rng = np.random.default_rng(11)
    template = [f"t{i}" for i in range(90)]
    rows = []
    for i in range(60):
        own = [f"o{i}_{j}" for j in range(int(rng.integers(18, 30)))]
        rows.append((i, " ".join(template + own)))
        if i % 7 == 0:
            rows.append((100 + i, " ".join([*template[:-2], *own])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicates(docs, 2)) == brute(rows, 2, 80)


def test_sets_with_one_first_hash_stay_apart(spark):
    rows = [(1, 0, 5, 10, 2), (2, 0, 5, 11, 3), (3, 0, 5, 10, 2), (4, 0, 6, 10, 2), (5, 0, None, 1, 0)]
    sketch = spark.createDataFrame([(*r, [1], [1], b"") for r in rows], near_dup._SKETCH)
    told, classes, moved = near_dup._told_apart(sketch)
    assert moved == {(5, 11)}
    assert sorted((r.doc_id, r.nid) for r in told.filter("nid is not null").collect()) == sorted([(1, 5), (3, 5), (4, 6), (2, near_dup._moved(5, 11))])
    assert sorted((r.nid, r.n) for r in classes.collect()) == sorted([(5, 2), (6, 2), (near_dup._moved(5, 11), 3)])
    assert near_dup._told_apart(sketch.filter("proof <> 11"))[2] == frozenset()


def test_components_tell_versions_of_a_document(spark):
    rows = [(3, "a b c"), (3, "x y z"), (1, "a b c"), (None, "x y z"), (None, "only here"), (3, "x y z")]
    found = [(r.doc_id, r.least.doc_id) for r in near_dup.components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()]
    assert sorted(found, key=repr) == sorted([(3, 1), (3, 3), (1, 1), (None, 3), (None, None), (3, 3)], key=repr)
