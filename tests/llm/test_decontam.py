import random
from itertools import combinations

import pytest
from oracle import actual, expected

from scriptorium.llm import decontam
from scriptorium.llm.decontam import ORACLE, contamination


@pytest.mark.parametrize("broadcast", [decontam.BROADCAST_SEEDS, 0])
def test_tables_match_sql(spark, sf_dir, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", broadcast)
    got = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert actual(got) == expected(ORACLE, sf_dir)


@pytest.mark.parametrize("broadcast", [decontam.BROADCAST_SEEDS, 0])
def test_substitutions_and_short_items(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", broadcast)
    rng = random.Random(1)
    w = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    item, short, tiny = w(20), w(6), w(3)
    changed = lambda at: [("x" if i in at else t) for i, t in enumerate(item)]
    docs = [
        (1, w(9) + item + w(9), True), (2, w(9) + changed({4, 12}) + w(9), True), (3, w(5) + changed({0, 3, 6, 9, 12, 15, 18}), False), (4, item[:13], True), (5, item[:10] + w(4), False),
        (6, w(3) + short, True), (7, short[:5] + w(2), False), (8, tiny * 4, False), (9, [], False), (10, [t.upper() + "!" for t in item], True),
    ]
    frame = spark.createDataFrame([(d, " ".join(t), "a") for d, t, _ in docs] + [(11, None, "a"), (1, " ".join(docs[0][1]), "b"), (None, " ".join(item), "c")], "doc_id long, text string, items string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, " ".join(tiny)), (4, None), (5, "")], "item_id long, text string")
    rows = contamination(frame, items).collect()
    assert sorted((repr(r.doc_id), r.contaminated) for r in rows) == sorted([(repr(d), c) for d, _, c in docs] + [("11", False), ("1", True), ("None", True)])
    assert {r.doc_id: r.items for r in rows}[1] == "1"
    assert contamination(frame.limit(0), items).collect() == [] and not any(r.contaminated for r in contamination(frame, items.limit(0)).collect())


def test_every_tolerated_substitution_is_found(spark):
    rng = random.Random(2)
    w = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    items = {1: w(11), 2: w(12), 3: w(13), 4: w(20)}
    passages = [(i, items[i]) for i in (1, 2, 3)] + [(4, items[4][3:16]), (4, items[4][:14])]
    docs = []
    for i, passage in passages:
        for n in (0, 1, 2, 3):
            for at in combinations(range(len(passage)), n):
                most = max(sum(p not in at for p in range(max(s, 0), min(s + 13, len(passage)))) for s in range(-12, len(passage)))
                docs.append((len(docs), w(5) + ["x" if p in at else t for p, t in enumerate(passage)] + w(5), i if most >= min(len(items[i]), 13) - 2 else None))
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t, _ in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = {r.doc_id: r.items for r in contamination(frame, bench).collect()}
    assert [d for d, _, i in docs if got[d] != (None if i is None else str(i))] == []


def test_a_very_long_item(spark):
    rng = random.Random(3)
    item = [f"t{rng.randrange(10**9)}" for _ in range(100_000)]
    docs = spark.createDataFrame([(1, " ".join(item[70_000:70_013])), (2, " ".join(item[5:15] + ["x"] * 5)), (3, " ".join(["y"] * 50_000 + item[99_987:])), (3, " ".join(["y"] * 50_000 + item[99_987:]))], "doc_id long, text string")
    got = contamination(docs, spark.createDataFrame([(1, " ".join(item)), (2, "a b c d e f")], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.items) for r in got if r.contaminated) == [(1, "1"), (3, "1"), (3, "1")]
