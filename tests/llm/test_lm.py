import zlib
from collections import Counter
from math import exp, isclose, log10

import numpy as np
import xxhash

from scriptorium.llm import lm
from scriptorium.llm.lm import GATE, GATE_HALF, ORDERS, REACH, SLOT_BITS, STEP, Block, Code, Mixer, count_bits, language_model_scores, prefix_code, refined, stretched, subtotals


def test_base_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_001, None), (10_002, ""), (10_003, "New zzz"), (10_003, "New zzz")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    counts = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = language_model_scores(frame).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        own = tokens(text[r.doc_id])
        want = sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(counts[w] > 0 for w in own), n)
        assert abs(r.base_score - want) < 1e-6 * max(1, abs(want)) and r.score < 0
    # the base gives every unseen word the same mass and never spells it; seen words show what the contexts add
    seen = [r for r in got if r.n_known == r.n_tokens]
    assert sum(r.score for r in seen) > sum(r.base_score for r in seen)
    assert language_model_scores(frame.limit(0)).collect() == []


def word_hash(word):
    return xxhash.xxh3_64_intdigest(word) & ~1


TEXTS = [b"the owl saw the old fox and the fox saw an owl".split(), b"the the xyzzy owl \xc3\xa9".split(), [], b"old owl old owl old owl old fox".split()]


def fitted(texts=TEXTS):
    counts = Counter(w for t in texts for w in [*t, b""])
    frequent = [w for w, n in counts.most_common() if n > 1]
    code = Code(np.array([word_hash(w) for w in frequent], np.uint64), np.array([counts[w] for w in frequent]), sum(n for n in counts.values() if n == 1), np.bincount(np.frombuffer(b" ".join(w for t in texts for w in t), np.uint8), minlength=256))
    letters, tables = np.zeros(256, np.int32), [np.zeros(2 << SLOT_BITS, np.int32) for _ in range(ORDERS)]
    block = Block.of(texts, code)
    count_bits(code, letters, tables, [block])
    tables = [code.node_bits(np.concatenate([code.counts, [sum(n for n in counts.values() if n == 1)], letters])), *map(subtotals, tables)]
    plain, without = zip(*map(stretched, tables), strict=True)
    mixer = Mixer(code, list(plain), list(without))
    mixer.learn(block)
    mixer.settle(mixer.statistics(block))
    return mixer, tables, block


def test_prefix_codes_are_complete():
    for weights in ([1, 1], [5, 1, 1, 9], list(range(1, 60))):
        depth, paths = prefix_code(np.array(weights))
        assert sum(2.0 ** -int(d) for d in depth) == 1
        codes = {tuple(paths[:d, i] & 1) for i, d in enumerate(depth)}
        assert len(codes) == len(weights) and not any(a != b and a == b[: len(a)] for a in codes for b in codes)
        best = sum(w * d for w, d in zip(weights, depth, strict=True))
        heap = sorted(weights)
        cost = 0
        while len(heap) > 1:
            a, b, *heap = sorted(heap)
            heap.append(a + b)
            cost += a + b
        assert best == cost


def slow_bits(code, words):
    """(kind, level, 2 * node + bit, contexts) of every bit of one document, in whole numbers."""
    m1, m2, top = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1

    def mix(x):
        x = ((x ^ x >> 32) * m2) & top
        return x ^ x >> 29

    known = {int(h): i for i, h in enumerate(code.hashes)}
    history = []
    for word in [*words, b""]:
        h = word_hash(word)
        symbol = known.get(h, code.escape)
        one, two = ([0, 0, *history])[-1], ([0, 0, *history])[-2]
        common = next((x for x in reversed(history) if known.get(x, 10**9) < 256), 0)
        own = mix((one * m1 + 1) & top)
        bits = [(0, symbol, [own, mix(((own + two) * m1 + 2) & top), mix((common * m1 + 3) & top)])]
        if symbol == code.escape:
            for i, byte in enumerate(word + b" "):
                last = lambda n, i=i, word=word: sum(word[i - j] << 8 * (j - 1) for j in range(1, n + 1) if i >= j)
                bits.append((1, code.escape + 1 + byte, [mix(((last(2) + mix((common * m1 + 4) & top)) * m1 + 5) & top), mix((last(3) * m1 + 6) & top), mix((last(5) * m1 + 7) & top)]))
        out = []
        for kind, s, contexts in bits:
            for level in range(code.depth[s]):
                packed = int(code.paths[level][s])
                if level % 4 == 0:
                    lines, inner = [((((c + (packed >> 1) * m1) * m2) & top) >> (64 - SLOT_BITS)) // 16 * 16 for c in contexts], 1
                out.append((kind, level, packed, [line + inner for line in lines]))
                inner = inner * 2 + (packed & 1)
        yield word, out
        history.append(h)


def test_scores_against_a_slow_scalar_mixer():
    mixer, tables, block = fitted()
    want_tables = [np.zeros(len(t), np.int64) for t in tables]
    got, at = mixer.log10(block), 0
    for words in TEXTS:
        for _word, bits in slow_bits(mixer.code, words):
            total = 0.0
            for kind, level, packed, slots in bits:
                bit = packed & 1
                x = [mixer.plain[0][packed >> 1], *(mixer.plain[k + 1][s] for k, s in enumerate(slots))]
                z = sum(w * int(v) / 10 for w, v in zip(mixer.weights[kind * 32 + min(level, 31)], x, strict=True))
                z = max(-REACH, min(REACH, round(z * STEP) / STEP))
                hits = mixer.hits[(packed >> 1) - mixer.code.words if kind else 256 + level][round(max(-REACH, min(REACH, np.rint(z * 2)))) + REACH]
                p = min(1 - 1e-6, max(1e-6, 0.5 / (1 + exp(-z)) + 0.5 * hits[1] / hits.sum()))
                total += log10(p if bit else 1 - p)
                want_tables[0][packed] += 1
                for k, s in enumerate(slots):
                    want_tables[k + 1][s * 2 + bit] += 1
            assert isclose(got[at], total, rel_tol=1e-3, abs_tol=0.05)
            at += 1
    assert at == len(got) and len(tables) == ORDERS + 1 and all((a == b).all() for a, b in zip(tables, want_tables, strict=True))


def test_next_words_are_a_probability():
    mixer, _, _ = fitted()
    known = [b"the", b"owl", b"saw", b"old", b"fox", b""]
    short = [bytes([x]) for x in range(256) if x not in b"\t\n\v\f\r "] + [bytes([x, y]) for x in b"xa\xc3" for y in range(256) if y not in b"\t\n\v\f\r "]
    words = [*known, *(w for w in short if w not in known)]
    total = sum(10 ** mixer.log10(Block.of([[b"old", w] if w else [b"old"]], mixer.code))[1] for w in words)
    assert 0.5 < total < 1
    after = lambda words: mixer.log10(Block.of([words], mixer.code))[-2]
    assert after([b"old", b"owl"]) > after([b"the", b"xyzzz"])


def test_documents_refine_their_words():
    rng = np.random.default_rng(5)
    texts = [[[b"a", b"b", b"c"][i] for i in rng.integers(0, 3, n)] for n in (0, 1, 5, 40)]
    block = Block.of(texts)
    p = np.log10(rng.uniform(0.01, 0.9, len(block.h)))
    got, at = refined(p, block), 0
    for words in texts:
        seen = Counter()
        for t, w in enumerate([*words, b""]):
            g = GATE * t / (t + GATE_HALF)
            assert isclose(got[at], log10((1 - g) * 10 ** p[at] + (g * seen[w] / t if t else 0)), abs_tol=1e-9)
            seen[w] += 1
            at += 1


def test_rows_without_ids_score_alike_over_partitions(spark):
    rows = [(None, w) for w in ("apple", "bread", "house", "table", "water", "stone")] + [(7, "apple bread"), (7, "stone"), (7, "stone"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    result = lambda n: sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 9), round(r.score, 6)) for r in language_model_scores(frame.repartition(n)).collect())
    assert result(4) == result(1) and len(result(4)) == len(rows)
    assert len({r[2] for r in result(4)}) >= 3


def test_unseen_words_have_no_floor(spark):
    held = [d for d in range(1000, 2000) if zlib.crc32(str(d).encode()) % 5 == 1][:3]
    rng = np.random.default_rng(3)
    unseen = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    rows = [(d, "red fox saw old owl") for d in range(50)] + [(held[0], unseen(100)), (held[1], unseen(1000)), (held[2], unseen(20_000))]
    got = {r.doc_id: r.score for r in language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 500 and got[held[1]] > got[held[2]] + 5000


def test_the_corpus_tells_of_documents_that_occur_twice(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    train = [d for d in range(1000) if zlib.crc32(str(d).encode()) % 5 != 1]
    rows = [(d, " ".join(rng.choice(words, 300))) for d in train[:60]]
    rows += [(train[60 + i], rows[i][1]) for i in range(5)]
    got = {r.doc_id: r.bits_per_byte for r in language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    twice = [got[rows[i][0]] for i in range(5)] + [got[r[0]] for r in rows[60:]]
    assert max(twice) < 0.5 * min(got[r[0]] for r in rows[5:60])


def test_word_order_counts(spark):
    # both orders hold the same words equally often; only one follows the training text
    rows = [(d, "red fox saw old owl " * 8) for d in range(200)]
    held = [d for d in range(1000, 2000) if zlib.crc32(str(d).encode()) % 5 == 1][:2]
    rows += [(held[0], "red fox saw old owl " * 8), (held[1], "owl old saw fox red " * 8)]
    got = {r.doc_id: r for r in language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, b = got[held[0]], got[held[1]]
    assert abs(a.base_score - b.base_score) < 1e-9 and a.score > b.score + 5


def test_all_training_text_makes_code_and_weights(spark, monkeypatch):
    # more documents, and longer ones, than any sample: each has bytes at its end that its beginning lacks
    made, fit, rng = [], lm.fit, np.random.default_rng(6)
    monkeypatch.setattr(lm, "fit", lambda *a: made.append(fit(*a)) or made[-1])
    rows = [(d, " ".join([*(f"w{i}" for i in rng.integers(0, 99, 700)), *(f"q\u017e{d}x{i}" for i in range(60))])) for d in range(400)]
    language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).count()
    (got,) = made
    texts = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    words = [t.encode().split() for t in texts]
    letters = np.bincount(np.frombuffer(b"".join(w + b" " for ws in words for w in ws), np.uint8), minlength=256)
    assert (got.code.depth[got.code.escape + 1 :] == prefix_code(letters + 1)[0]).all()

    block, seen, tables = Block.of(words, got.code), np.zeros(256, np.int32), [np.zeros(2 << SLOT_BITS, np.int32) for _ in range(ORDERS)]
    count_bits(got.code, seen, tables, [block])
    others = sum(len(ws) + 1 for ws in words) - int(got.code.counts.sum())
    plain, without = zip(*map(stretched, [got.code.node_bits(np.concatenate([got.code.counts, [others], seen])), *map(subtotals, tables)]), strict=True)
    want = Mixer(got.code, list(plain), list(without))
    turns = [[ws for t, ws in zip(texts, words, strict=True) if lm.turn_of(t) == turn] for turn in range(lm.TURNS)]
    assert all(turns) and sum(map(len, turns)) == len(words)  # each text is learned from once
    for own in turns:
        want.learn(Block.of(own, got.code))
    assert np.allclose(got.weights, want.weights, atol=1e-3) and np.allclose(got.hits, want.hits, rtol=0.01, atol=5)
