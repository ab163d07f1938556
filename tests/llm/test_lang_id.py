import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from scriptorium.llm.lang_id import accepted, fit, forward_backward, language_id, learn, posteriors, predict, spread, time_major


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 1, 4])
    scores, move, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    order, widths = time_major(lengths)
    gamma = np.empty_like(scores)
    found, pairs, z = forward_backward(scores[order], move, start, widths)
    gamma[order] = found
    assert np.allclose(found, posteriors(scores[order], move, start, widths))
    at, total, want_pairs = 0, 0.0, np.zeros((3, 3))
    for n in lengths:
        weight, mass, both = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.exp(start[path[0]] + sum(scores[at + i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            mass += p
            for i, y in enumerate(path):
                weight[i, y] += p
            for a, b in itertools.pairwise(path):
                both[a, b] += p
        assert np.allclose(gamma[at : at + n], weight / mass)
        want_pairs += both / mass
        total += np.log(mass)
        at += n
    assert np.allclose(pairs, want_pairs) and np.isclose(z, total)


def test_code_switched_words():
    model = fit([("de", "der hund und die katze sind nicht hier " * 4), ("en", "the dog and the cat are not here today " * 4)] * 5)
    assert predict(model, ["the cat and the dog", "die katze und der hund", "", None, "12 !?"])[:2] == [("en", predict(model, ["the cat and the dog"])[0][1]), ("de", predict(model, ["die katze und der hund"])[0][1])]
    assert [p[0] for p in predict(model, ["", None, "12 !?", " "])] == ["und"] * 4
    assert predict(None, ["a"]) == [("und", 0.0)] and fit([]) is None


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id(docs).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) >= 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, "the dog and the cat", "en", "s", 1), (2, None, "en", "s", None), (3, "42", None, None, 2), (4, "el perro y el gato", "es", "s", 3), (4, "el perro y el gato", "es", "s", 3), (None, "the cat", None, "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang_pred for r in language_id(docs).collect()}
    assert got[2] == got[3] == "und" and got[None] in ("en", "es") and len(language_id(docs).collect()) == 6
    assert sorted(repr(r.doc_id) for r in accepted(docs).collect()) == ["1", "4", "4", "None"]
    assert language_id(docs.limit(0)).collect() == []


def test_all_letters_of_long_runs_count():
    model = fit([("de", "der hund und die katze sind nicht hier " * 4), ("en", "the dog and the cat are not here today " * 4)] * 5)
    german = "derhundunddiekatzesindnichthier"
    english = "thedogandthecatarenotheretoday"
    # both ends are English, all between is German
    assert predict(model, [english + german * 40 + english])[0][0] == "de"
    assert predict(model, [german + english * 40 + german])[0][0] == "en"


def test_fitting_reads_all_of_a_text(spark):
    # only the middle and the end of long texts hold words that tell the languages apart
    same = "abcdefghij klmnopqrst " * 400
    rows = [(d, f"{same}{own * 30}{same}{own * 80}", lang) for d in range(40) for own, lang in [("der hund und die katze ", "de") if d % 2 else ("the dog and the cat ", "en")]]
    rows += [(100 + d, "never learned words", f"rare{d}") for d in range(3)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert [p[0] for p in predict(model, ["die katze und der hund", "the cat and the dog"])] == ["de", "en"]
    assert spread(list("abcdef"), 10) == list("abcdef") and len(spread(list(range(10_000)))) == 150 and spread(list(range(10_000)))[-1] == 9999


def test_fitting_reads_all_sample_words(spark):
    # the first 1,200 characters hold no word that tells the languages apart
    same = " ".join(["abcdefghijklmnopqrstuvwxyzabcd"] * 45)
    rows = [(d, f"{same} {'der hund und die katze ' * 15 if d % 2 else 'the dog and the cat '  * 15}", "de" if d % 2 else "en") for d in range(40)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert [p[0] for p in predict(model, ["die katze und der hund", "the cat and the dog"])] == ["de", "en"]
