import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm.mixing import BLOCK, mix, sainte_lague, targets


@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 60))
def test_highest_quotients(votes, seats):
    given_ = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given_[i] + 1), -i) if votes[i] else (-1, -i))
        given_[i] += 1
    assert sainte_lague(np.array(votes), seats).tolist() == given_


def test_targets_stop_at_twice_the_size():
    got = targets(np.array([10, 100, 100]), np.array([3, 1, 2]), 315)
    assert got[0] == 20 and abs(got[1] - 295 / 3) < 1e-9 and abs(got[2] - 2 * 295 / 3) < 1e-9
    assert targets(np.zeros(2), np.ones(2), 0).tolist() == [0, 0]


def test_contract(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mix(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(docs.repartition(7)).collect()))
    texts = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    names = sorted(set(source.values()))
    sizes = np.array([sum(len(texts[d].encode().split()) for d in texts if source[d] == s) for s in names])
    want = targets(sizes, np.array([(3, 1, 2)[i % 3] for i in range(len(names))]), 1.5 * sizes.sum())
    for i, s in enumerate(names):
        own = [r for r in rows if source[r.doc_id] == s]
        assert {r.source_size for r in own} == {sizes[i]} and all(abs(r.target - want[i]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[i]) <= 2 * BLOCK
    assert all(r.size == len(texts[r.doc_id].encode().split()) and 0 <= r.taken <= 2 * r.size for r in rows)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, "a b c d e f g h i j", "s", 0), (1, "a b c d e f g h i j", "s", 0), (2, None, None, 1), (None, "x y", None, 2), (4, "", "é", 3), (5, " \t", "Z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mix(docs).collect()
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(d), len((t or "").split())) for d, t, _, _ in rows)
    assert all(r.taken <= 2 * r.size for r in got) and {r.source_size for r in got if r.doc_id == 1} == {20}
    assert mix(docs.limit(0)).collect() == []
