"""Language of documents by a linear-chain conditional random field over their words.

States are the learned languages. Emissions sum weights of hashed affix, character n-gram and lexicon features of a
word; transition weights are learned from sequences that splice stretches of several languages. Forward-backward gives
each word's posterior; a document's language has the largest sum of posteriors. Runs of more than LONGEST code points, as
in scripts without spaces, are split into pieces that each stand in the chain.

Fitting takes a bounded sample (LANGUAGES languages, SAMPLE_DOCS rows of each, lowest text hash first, SAMPLE_WORDS words
of each, from all over the text) of labelled rows; prediction covers every word of every text.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tidied

SAMPLE_DOCS, SAMPLE_WORDS, STRETCHES = 400, 150, 10
#: Languages that are learned, the most frequent ones.
LANGUAGES = 100
DIMENSIONS = 1 << 16
#: Words of the lexicon: seen at least so often in the sample.
LEXICON_LEAST = 3
SEQUENCE, EPOCHS, RATE, DECAY = 60, 40, 0.3, 1e-4
#: Code points of a word at most; longer runs are split into pieces.
LONGEST = 40
UNKNOWN = "und"


def clean(word: str) -> str:
    """Lower-case letters of a word; empty if it has none."""
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def words_of(text: str) -> list[str]:
    """Words between white space, runs over LONGEST in successive pieces."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _slot(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + np.uint64(kind)) * _Q
    h = (h ^ (h >> np.uint64(32))) * _P
    return (h >> np.uint64(48)).astype(np.int64) & (DIMENSIONS - 1)


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of cleaned words as (feature, word number): affixes of 1 to 4, edged n-grams of 2 and 3, lexicon."""
    some = [i for i, w in enumerate(words) if w]
    if not some:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept = [words[i] for i in some]
    code = np.frombuffer(("<" + "><".join(kept) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.fromiter(map(len, kept), np.int64, len(kept))
    size = n + 2
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(kept)), size)
    flat, who = [], []
    two = code[:-1] * _P + code[1:]
    inside = owner[:-1] == owner[1:]
    flat.append(_slot(two[inside], 2))
    who.append(owner[:-1][inside])
    three = two[:-1] * _P + code[2:]
    inside = owner[:-2] == owner[2:]
    flat.append(_slot(three[inside], 3))
    who.append(owner[:-2][inside])
    for length in range(1, 5):
        own = np.flatnonzero(n >= length)
        for kind, at in ((10, start[own] + 1), (20, start[own] + 1 + n[own] - length)):
            h = np.zeros(len(own), np.uint64)
            for j in range(length):
                h = h * _P + code[at + j]
            flat.append(_slot(h, kind + length))
            who.append(own)
    flat.append(np.fromiter((lexicon.get(w, 0) for w in kept), np.int64, len(kept)))
    who.append(np.arange(len(kept)))
    return np.concatenate(flat), np.asarray(some)[np.concatenate(who)]


class Field:
    """Weights of a fitted field: languages, emission table, transitions, starts, lexicon."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.emit, self.move, self.start = np.zeros((DIMENSIONS, k)), np.zeros((k, k)), np.zeros(k)

    def scores(self, words: list[str]) -> np.ndarray:
        """Mean feature weight of each word, scaled by the square root of the count; zeros without letters."""
        return _gathered(self.emit, *features(words, self.lexicon), len(words))


def _gathered(table: np.ndarray, flat: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    sizes = np.maximum(np.bincount(owner, minlength=count), 1)
    return np.stack([np.bincount(owner, table[flat, c], count) for c in range(table.shape[1])], 1) / np.sqrt(sizes)[:, None]


def forward_backward(scores: np.ndarray, move: np.ndarray, start: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors of states, expected transitions and log likelihood of the normaliser.

    scores: rows of all sequences in time-major order, the sequences sorted by falling length; widths[t]: how many
    sequences have a word at time t. Probabilities are rescaled at each step.
    """
    n, k = scores.shape
    peak = scores.max(1, keepdims=True) if n else scores
    e = np.exp(scores - peak)
    t = np.exp(move)
    at = np.concatenate([[0], np.cumsum(widths)])
    alpha, scale = np.empty((n, k)), np.empty((n, 1))
    for i, w in enumerate(widths):
        own = slice(at[i], at[i] + w)
        a = e[own] * (np.exp(start) if i == 0 else alpha[at[i - 1] : at[i - 1] + w] @ t)
        c = a.sum(1, keepdims=True)
        alpha[own], scale[own] = a / c, c
    beta = np.ones((n, k))
    for i in range(len(widths) - 2, -1, -1):
        w = widths[i + 1]
        later = slice(at[i + 1], at[i + 1] + w)
        beta[at[i] : at[i] + w] = (e[later] * beta[later] / scale[later]) @ t.T
    gamma = alpha * beta
    pairs = np.zeros((k, k))
    for i in range(1, len(widths)):
        w, own = widths[i], slice(at[i], at[i] + widths[i])
        pairs += alpha[at[i - 1] : at[i - 1] + w].T @ (e[own] * beta[own] / scale[own])
    return gamma, pairs * t, float(np.log(scale).sum() + peak.sum())


def posteriors(scores: np.ndarray, move: np.ndarray, start: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """As forward_backward, states only."""
    n, k = scores.shape
    e = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
    t, back = np.exp(move), np.exp(move).T.copy()
    at = np.concatenate([[0], np.cumsum(widths)])
    alpha = np.empty((n, k))
    for i, w in enumerate(widths):
        a = e[at[i] : at[i] + w] * (np.exp(start) if i == 0 else alpha[at[i - 1] : at[i - 1] + w] @ t)
        alpha[at[i] : at[i] + w] = a / a.sum(1, keepdims=True)
    beta = np.ones((n, k))
    for i in range(len(widths) - 2, -1, -1):
        w = widths[i + 1]
        b = (e[at[i + 1] : at[i + 1] + w] * beta[at[i + 1] : at[i + 1] + w]) @ back
        beta[at[i] : at[i] + w] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    return gamma / gamma.sum(1, keepdims=True)


def time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences laid end to end: positions in time-major order (longest sequence first), and widths."""
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    longest = int(sorted_lengths[0]) if len(lengths) else 0
    widths = np.searchsorted(-sorted_lengths, -np.arange(longest), side="left")
    begin = (np.cumsum(lengths) - lengths)[order]
    step = np.repeat(np.arange(longest), widths)
    lane = np.arange(len(step)) - np.repeat(np.cumsum(widths) - widths, widths)
    return begin[lane] + step, widths


def fit(samples: list[tuple[str, str]]) -> Field | None:
    """Fit on (language, text) rows, in the order given; None if there are none."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    index = {lang: i for i, lang in enumerate(languages)}
    texts = [(index[lang], [c for w in spread(words_of(text)) if (c := clean(w))]) for lang, text in samples]
    counts = Counter(w for _, words in texts for w in words)
    # slot 0 stands for words outside the lexicon
    model = Field(languages, {w: 1 + zlib.crc32(w.encode("utf-8", "surrogatepass")) % (DIMENSIONS - 1) for w, n in counts.items() if n >= LEXICON_LEAST})
    rng = np.random.default_rng(5)
    stretches = [(y, words[i : i + SEQUENCE // 2]) for y, words in texts for i in range(0, len(words), SEQUENCE // 2)]
    rng.shuffle(stretches)
    runs: list[tuple[list[str], list[int]]] = []
    for i in range(0, len(stretches), 2):  # half of the sequences switch language where their halves meet
        two = stretches[i : i + 2]
        if rng.random() < 0.5 and len({y for y, _ in two}) > 1:
            runs.append(([w for _, words in two for w in words], [y for y, words in two for _ in words]))
        else:
            runs += [(words, [y] * len(words)) for y, words in two]
    runs = [r for r in runs if r[0]]
    if not runs:
        return model
    lengths = np.array([len(w) for w, _ in runs])
    order, widths = time_major(lengths)
    vocabulary: dict[str, int] = {}
    word = np.array([vocabulary.setdefault(w, len(vocabulary)) for words, _ in runs for w in words])[order]
    gold = np.array([y for _, ys in runs for y in ys])[order]
    first = np.arange(widths[0])
    before = np.concatenate([np.arange(widths[i]) + at for i, at in zip(range(1, len(widths)), np.cumsum(widths) - widths, strict=False)]) if len(widths) > 1 else np.empty(0, int)
    after = np.arange(widths[0], len(word))
    k = len(languages)
    flat, owner = features(list(vocabulary), model.lexicon)
    sizes = np.bincount(owner, minlength=len(vocabulary))
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (gold[before], gold[after]), 1)
    seen_start = np.bincount(gold[first], minlength=k)
    total = len(word)
    state = [np.full_like(w, 1e-8) for w in (model.emit, model.move, model.start)]
    root = np.sqrt(sizes)[:, None]
    for _ in range(EPOCHS):
        gamma, pairs, _ = forward_backward(_gathered(model.emit, flat, owner, len(vocabulary))[word], model.move, model.start, widths)
        delta = -gamma
        delta[np.arange(total), gold] += 1
        by_word = np.stack([np.bincount(word, delta[:, c], len(vocabulary)) for c in range(k)], 1) / root
        emit = np.stack([np.bincount(flat, by_word[owner, c], DIMENSIONS) for c in range(k)], 1)
        grads = (emit / total - DECAY * model.emit / 100, (seen_pairs - pairs) / total, (seen_start - gamma[first].sum(0)) / total)
        for w, g, s in zip((model.emit, model.move, model.start), grads, state, strict=True):
            s += g * g
            w += RATE * g / np.sqrt(s)
    return model


def spread(words: list[str], most: int = SAMPLE_WORDS) -> list[str]:
    """All words, or most of them in STRETCHES runs that lie evenly over the whole text."""
    if len(words) <= most:
        return words
    size = most // STRETCHES
    starts = [(len(words) - size) * i // (STRETCHES - 1) for i in range(STRETCHES)]
    return [w for a in starts for w in words[a : a + size]]


def _sampled(batches):
    for batch in batches:
        texts = [" ".join(spread(words_of(t))) for t in batch.column("text").to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def learn(docs: DataFrame, training) -> Field | None:
    """Fit on the rows of docs(doc_id, text, lang) that satisfy training and have a language and a text.

    A bounded sample: of the LANGUAGES most frequent languages, SAMPLE_DOCS rows each, by lowest text hash; only their
    texts are read again. SAMPLE_WORDS words of each come from all over the text.
    """
    rows = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "doc_id", F.xxhash64("text").alias("h"), "text")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    ranked = rows.select("lang", "h", "doc_id").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).filter(F.col("r") <= SAMPLE_DOCS)
    drawn = ranked.join(F.broadcast(common), "lang", "left_semi").groupBy("lang", "h", "doc_id").agg(F.count("*").cast("int").alias("times"))
    same = F.col("d.h").eqNullSafe(F.col("s.h")) & (F.col("d.lang") == F.col("s.lang")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    found = rows.alias("d").join(F.broadcast(drawn.alias("s")), same).select("d.lang", "d.h", "d.doc_id", "text", "times").dropDuplicates(["lang", "h", "doc_id"])
    texts = found.mapInArrow(_sampled, found.schema).orderBy("lang", "h", "doc_id").collect()  # LANGUAGES * SAMPLE_DOCS rows at most
    return fit([(r.lang, r.text) for r in texts for _ in range(r.times)])


class _Emissions(dict):
    """Word -> row of scores, and whether the word has a letter, kept up to a bound."""

    LIMIT = 300_000

    def __init__(self, model: Field):
        super().__init__()
        self.model, self.rows, self.lettered = model, np.zeros((0, len(model.languages))), np.zeros(0)

    def matrix(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self]
        if len(self) + len(new) > self.LIMIT:
            self.clear()
            self.rows, self.lettered = self.rows[:0], self.lettered[:0]
            new = list(dict.fromkeys(words))
        if new:
            self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
            cleaned = [clean(w) for w in new]
            self.rows = np.concatenate([self.rows, self.model.scores(cleaned)])
            self.lettered = np.concatenate([self.lettered, [float(bool(w)) for w in cleaned]])
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


#: Tokens whose posteriors are held at once.
CHUNK = 200_000


def predict(model: Field | None, texts: list[str | None], memory: _Emissions | None = None) -> list[tuple[str, float]]:
    """(language, score) of each text; the score is the mean posterior of that language over words with letters."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if model is None:
        return out
    memory = memory or _Emissions(model)
    sizes = [(len(t), i) for i, t in enumerate(texts) if t]
    chunk: list[tuple[int, list[str]]] = []
    held = 0
    for _, i in sorted(sizes, reverse=True):
        words = words_of(texts[i])
        if not words:
            continue
        chunk.append((i, words))
        held += len(words)
        if held >= CHUNK:
            _label(model, memory, chunk, out)
            chunk, held = [], 0
    if chunk:
        _label(model, memory, chunk, out)
    return out


def _label(model: Field, memory: _Emissions, chunk: list[tuple[int, list[str]]], out: list) -> None:
    lengths = np.array([len(w) for _, w in chunk])
    ids = memory.matrix([w for _, words in chunk for w in words])
    scores = memory.rows[ids]
    order, widths = time_major(lengths)
    gamma = np.empty_like(scores)
    gamma[order] = posteriors(scores[order], model.move, model.start, widths)
    weight = memory.lettered[ids]
    starts = np.cumsum(lengths) - lengths
    sums, n = np.add.reduceat(gamma * weight[:, None], starts, axis=0), np.add.reduceat(weight, starts)
    for (i, _), s, count in zip(chunk, sums, n, strict=True):
        if count:
            best = int(s.argmax())
            out[i] = (model.languages[best], min(1.0, float(s[best] / count)))


def predicted(docs: DataFrame, model: Field | None, schema: str, *carried: str) -> DataFrame:
    """The carried columns of docs, then lang_pred and score, read from text only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memory = _Emissions(shared.value) if shared.value else None
        for batch in batches:
            found = predict(shared.value, batch.column("text").to_pylist(), memory)
            columns = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*carried, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*carried, "text"])).mapInArrow(tidied(run), f"{schema}, lang_pred string, score double")


def _remainder(m: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % m


def language_id(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang) -> doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id as text) mod 4 is not 2 and whose lang is not null. lang_pred is one of their
    languages, or und (score 0) where the text is null or has no letter, or nothing could be learned. A null doc_id
    isn't held out and isn't learned from. Repeated rows get equal results; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(docs, _remainder(4) != 2)
    rows = docs.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "text")
    return predicted(rows, model, "doc_id long, held_out boolean", "doc_id", "held_out")


#: Documents whose best language keeps less of the posterior than this are rejected by the pipeline's stage.
LEAST_SCORE = 0.4


def accepted(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) whose text has a recognisable language; rejected: und, or a score under LEAST_SCORE."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    model = learn(docs, _remainder(4) != 2)
    return predicted(docs.select(*columns), model, schema, *columns).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*columns)
