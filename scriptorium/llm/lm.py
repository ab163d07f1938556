"""Language-model scores by online logistic context mixing.

A document is its words and one end. Every word is written in bits: frequent words (up to LEXICON of them) by a prefix
code, all others as an escape and their bytes, each byte by a prefix code of its own. All of these bits are predicted by
the mixer. Bit predictors look up counts under hashed contexts: none; for words the previous word, the two previous
words, and the last very common word; for bytes the last two and that common word, the last three, the last five. Their
counts are summed over the running text of all training documents. A logistic mixer combines the stretched
probabilities with weights gated by code and bit number, and an adaptive probability map refines the result.

The code of bytes is that of all training words. Weights and map learn online from all training text, in TURNS turns;
each training document belongs to one of them, by the hash of its text. Gradient and curvature of the loss, and the map's
hits, are summed over a turn, each occurrence without its own counts; then the weights take a Newton step by the curvature
of all turns so far. No sum depends on partitions.

Two refinements follow the text. Document: after t tokens, a word has (1 - g) * p + g * (earlier places) / t with the
gate g = GATE * t / (t + GATE_HALF). Corpus: words end a segment by their hash, and a segment of words has
(1 - m) * p + m * (its share of all training segments), m the share of segments that occur again; a training document's
own segments are left out, else its memory of itself would hide what other documents tell.

Fixed-size parts (code, slot tables, mixer, map) are broadcast; counts of all words and segments never are: blocks of
documents send hashes of rare words and segments to the partitions of these counts and get counts back.
"""

from __future__ import annotations

import copy
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, tidied

#: Words with a code of their own at most, and how many of these count as very common.
LEXICON, COMMON = 262_144, 256
#: Hashed orders beside order 0, and slots of each.
ORDERS, SLOT_BITS = 3, 20
SLOTS = 1 << SLOT_BITS
#: Gates of the mixer: words' bits, then bytes' bits.
DEPTH = 32
GATES = 2 * DEPTH
GATE, GATE_HALF = 0.4, 150.0
#: A word ends a segment with chance 1 / SEGMENT.
SEGMENT = 32
#: Turns of the online pass over all training documents, and the largest weight: two words of one count are told apart by
#: leaving out each one's own, which would drive weights of the deepest bits without end.
TURNS, WEIGHT = 4, 2.0
#: The map: contexts (byte nodes, then word levels), coarse buckets of 1/2 for its hits, fine ones of 1/STEP.
PLACES, REACH, STEP = 256 + DEPTH, 16, 16
#: Hashes that a look-up bucket is asked for, and characters that one counting task reads, about.
BUCKET_ROWS, TASK_CHARS = 125_000, 48_000_000
#: Characters of a block of documents, about, and tokens predicted at once.
BLOCK_CHARS, CHUNK = 8_000_000, 32_768
#: Numbers of a table that travel as one row, and rows of a piece that are summed at once.
PIECE, FAN_IN = 1 << 17, 8
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LN10 = np.log(10.0)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def prefix_code(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Huffman code of at least two symbols: depth of each, and (levels, symbols) of 2 * node + bit from the root."""
    n = len(weights)
    order = np.argsort(weights, kind="stable")
    first, second, parent, bit = list(zip(weights[order].tolist(), order.tolist(), strict=True)), [], np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
    i = j = 0
    for node in range(n, 2 * n - 1):
        total = 0
        for b in (0, 1):
            if i < n and (j >= len(second) or first[i][0] <= second[j][0]):
                w, child = first[i]
                i += 1
            else:
                w, child = second[j]
                j += 1
            parent[child], bit[child] = node, b
            total += w
        second.append((total, node))
    at, depth, steps = np.arange(n), np.zeros(n, np.int64), []
    while (live := at < 2 * n - 2).any():
        steps.append(np.where(live, (parent[at] - n) * 2 + bit[at], -1))
        depth += live
        at = np.where(live, parent[at], at)
    paths = np.zeros((int(depth.max()), n), np.int64)
    for s, step in enumerate(steps):
        live = step >= 0
        paths[depth[live] - 1 - s, np.flatnonzero(live)] = step[live]
    return depth, paths


class Code:
    """Bits of words. Symbols: frequent words (by count), the escape, then bytes; a byte 0x20 ends an escaped word."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, others: int, letters: np.ndarray):
        self.hashes, self.counts, self.escape = hashes.astype(np.uint64), counts.astype(np.int64), len(hashes)
        words = np.append(self.counts, max(1, others))
        words = np.maximum(words, 1 + words.sum() // (1 << 22))  # bounds the depth
        if len(words) == 1:
            words = np.append(words, 1)
        depth, paths = prefix_code(words)
        own, bytes_ = prefix_code(letters.astype(np.int64) + 1)
        self.nodes = len(words) - 1 + 255
        self.words = self.nodes - 255
        self.depth = np.concatenate([depth[: self.escape + 1], own]).astype(np.int8)
        self.paths = np.zeros((max(len(paths), len(bytes_)), self.escape + 257), np.int32)
        self.paths[: len(paths), : self.escape + 1] = paths[:, : self.escape + 1]
        self.paths[: len(bytes_), self.escape + 1 :] = bytes_ + 2 * self.words

        order = np.argsort(self.hashes)
        self._sorted, self._ranks = np.append(self.hashes[order], np.uint64(0)), np.append(order, self.escape).astype(np.int32)

        # of each four bits: the node of the first, and the place they reach in a tree of sixteen nodes
        groups = range(0, len(self.paths), 4)
        self.heads = np.stack([self.paths[g] >> 1 for g in groups])
        self.tails = np.ones((len(groups), len(self.depth)), np.int8)
        for g in groups:
            for level in range(g, min(g + 4, len(self.paths))):
                live = self.depth > level
                self.tails[g // 4, live] = self.tails[g // 4, live] * 2 + (self.paths[level, live] & 1)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._sorted[:-1], hashes)
        return np.where(self._sorted[at] == hashes, self._ranks[at], np.int32(self.escape))

    def node_bits(self, counts: np.ndarray) -> np.ndarray:
        """Order 0: of each node and bit, the count of the symbols below it."""
        out = np.zeros(2 * self.nodes, np.int64)
        for level, path in enumerate(self.paths):
            live = np.flatnonzero(self.depth > level)
            np.add.at(out, path[live], counts[live].astype(np.int64))
        return out


class _Numbers(dict):
    """Word -> its number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self)
        return i


def encode(texts: list[list[bytes]]) -> tuple[np.ndarray, list[bytes]]:
    """Tokens of documents, each with its end, as numbers of distinct words; number 0 is the end."""
    numbers = _Numbers({b"": 0})
    flat: list[bytes] = []
    for words in texts:
        flat += words
        flat.append(b"")
    return np.fromiter(map(numbers.__getitem__, flat), np.uint32, len(flat)), list(numbers)


class Block:
    """The tokens of some documents: numbers, hashes, symbols, and what stands before each."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, words: list[bytes], code: Code | None = None):
        self.ids, self.lengths, self.words = tokens.astype(np.int64), lengths, words
        self.starts = np.cumsum(lengths) - lengths
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & ~np.uint64(1)
        self.h = self.hashes.take(self.ids)
        if code:
            self.symbols, self.common = code.symbols(self.hashes).take(self.ids), min(COMMON, code.escape)

    @classmethod
    def of(cls, texts: list[list[bytes]], code: Code | None = None) -> "Block":
        tokens, words = encode(texts)
        return cls(tokens, np.fromiter(map(len, texts), np.int64, len(texts)) + 1, words, code)

    def before(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the previous word, the one before it, and the last very common word; 0 where there is none."""
        one, two = np.zeros_like(self.h), np.zeros_like(self.h)
        one[1:] = self.h[:-1]
        one[self.starts] = 0
        two[1:] = one[:-1]
        two[self.starts] = 0
        last = np.full(len(self.h), -1)
        last[1:] = np.maximum.accumulate(np.where(self.symbols < self.common, np.arange(len(self.h)), -1))[:-1]
        common = self.h[last]
        common[last < np.repeat(self.starts, self.lengths)] = 0
        return one, two, common

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash (odd) and first token of each segment, in order; a document's end ends one."""
        ends = self.h >> np.uint64(13) & np.uint64(SEGMENT - 1) == 0
        ends[self.starts + self.lengths - 1] = True
        first = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
        place = np.arange(len(self.h)) - np.repeat(first, np.diff(np.append(first, len(self.h))))
        return np.add.reduceat(_mix((self.h + place.astype(np.uint64)) * _M1), first) | np.uint64(1), first

    def streams(self, code: Code):
        """Chunks of symbols with their hashed contexts: (kind, symbols, contexts, word of each); kind 1 is bytes."""
        one, two, common = self.before()
        for lo in range(0, len(self.h), CHUNK):
            part = slice(lo, lo + CHUNK)
            a, c, symbols = one[part], common[part], self.symbols[part]
            own = _mix(a * _M1 + np.uint64(1))
            yield 0, symbols, [own, _mix((own + two[part]) * _M1 + np.uint64(2)), _mix(c * _M1 + np.uint64(3))], np.arange(lo, lo + len(symbols))
            rare = np.flatnonzero(symbols == code.escape)
            if not len(rare):
                continue
            words = [self.words[i] for i in self.ids[lo + rare].tolist()]
            text = np.frombuffer(b" ".join(words) + b" ", np.uint8)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            last, wide, sums = np.zeros(len(text), np.uint64), text.astype(np.uint64), []
            for n in range(1, 6):
                byte = np.zeros(len(text), np.uint64)
                byte[n:] = wide[:-n]
                byte[place < n] = 0
                last = last | byte << np.uint64(8 * (n - 1))
                sums.append(last)
            shared = np.repeat(_mix(c[rare] * _M1 + np.uint64(4)), sizes)
            contexts = [_mix((sums[1] + shared) * _M1 + np.uint64(5)), _mix(sums[2] * _M1 + np.uint64(6)), _mix(sums[4] * _M1 + np.uint64(7))]
            yield 1, code.escape + 1 + text.astype(np.int32), contexts, np.repeat(lo + rare, sizes)


def levels(code: Code, symbols: np.ndarray, contexts: list[np.ndarray]):
    """Bit by bit: (level, how many symbols have it, 2 * node + bit, slots of each hashed order); deep symbols first.

    Four bits share a line of sixteen slots, found by context and the node of the first; they walk a tree within it.
    """
    depth, inner, lines = code.depth.take(symbols), None, []
    for level in range(len(code.paths)):
        n = int(np.count_nonzero(depth > level))
        if not n:
            return
        packed = code.paths[level].take(symbols[:n]).astype(np.int64)
        if level % 4 == 0:
            node = (packed >> 1).astype(np.uint64) * _M1
            lines = [line_of(c[:n], node) for c in contexts]
            inner = np.ones(n, np.int64)
        yield level, n, packed, [line[:n] + inner[:n] for line in lines]
        inner = inner[:n] * 2 + (packed & 1)


def deep_first(code: Code, symbols: np.ndarray, contexts: list[np.ndarray], words: np.ndarray):
    order = np.argsort(-code.depth.take(symbols), kind="stable")
    return symbols[order], [c[order] for c in contexts], words[order]


def count_bits(code: Code, letters: np.ndarray, tables: list[np.ndarray], blocks) -> None:
    """Add all blocks to tables: bytes of escaped words, and of each hashed order where every four bits end in their line."""
    one = np.int32(1)
    for block in blocks:
        for kind, *stream in block.streams(code):
            symbols, contexts, _ = deep_first(code, *stream)
            if kind:
                letters += np.bincount(symbols - code.escape - 1, minlength=256)
            depth = code.depth.take(symbols)
            for g, (heads, tails) in enumerate(zip(code.heads, code.tails, strict=True)):
                n = int(np.count_nonzero(depth > 4 * g))
                if not n:
                    break
                node, tail = heads.take(symbols[:n]).astype(np.uint64) * _M1, tails.take(symbols[:n]).astype(np.int64)
                for table, c in zip(tables, contexts, strict=True):
                    np.add.at(table, line_of(c[:n], node) * 2 + tail, one)


def line_of(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """First of the sixteen slots of a context and the node of four bits, as hashed."""
    return ((context + node) * _M2 >> np.uint64(64 - SLOT_BITS)).view(np.int64) & -16


def subtotals(ends: np.ndarray) -> np.ndarray:
    """From where four bits end in each line: how often each bit (2 * slot + bit) was met."""
    out = ends.reshape(-1, 32)
    for j in range(15, 1, -1):
        out[:, j] += out[:, 2 * j] + out[:, 2 * j + 1]
    return ends


def stretched(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (zeros, ones): stretched probabilities in tenths, and the same by bit without that bit's own count."""
    zeros, ones = counts[::2].astype(np.float64), counts[1::2].astype(np.float64)
    tenths = lambda a, b: np.clip(np.rint(10 * np.log((np.maximum(b, 0) + 0.2) / (np.maximum(a, 0) + 0.2))), -127, 127).astype(np.int8)
    without = np.empty(len(counts), np.int8)
    without[::2], without[1::2] = tenths(zeros - 1, ones), tenths(zeros, ones - 1)
    return tenths(zeros, ones), without


class Mixer:
    """Stretched tables, gated weights and the adaptive map."""

    def __init__(self, code: Code, plain: list[np.ndarray], without: list[np.ndarray]):
        self.code, self.plain, self.without = code, plain, without
        self.weights, self.curves = np.full((GATES, ORDERS + 1), 0.4), np.zeros((GATES, ORDERS + 1, ORDERS + 1))
        self.hits = self._prior()
        self._logs = None

    @staticmethod
    def _prior() -> np.ndarray:
        one = 1 / (1 + np.exp(-np.arange(-REACH, REACH + 1) / 2))
        return np.tile(np.stack([1 - one, one], 1) * 8, (PLACES, 1, 1))

    def scorer(self) -> "Mixer":
        """Without what only learning needs."""
        out = Mixer.__new__(Mixer)
        out.__dict__ |= self.__dict__ | {"without": None, "_logs": self._log_table()}
        return out

    def _log_table(self) -> np.ndarray:
        """log10 p by (place, fine bucket, bit): the logistic estimate and the map's share, half each."""
        z = np.arange(-REACH * STEP, REACH * STEP + 1) / STEP
        share = self.hits[:, :, 1] / self.hits.sum(2)
        coarse = np.clip(np.rint(z * 2), -REACH, REACH).astype(int) + REACH
        p = np.clip(0.5 / (1 + np.exp(-z)) + 0.5 * share[:, coarse], 1e-6, 1 - 1e-6)
        return np.log10(np.stack([1 - p, p], 2)).ravel()

    def _inputs(self, tables: list[np.ndarray], packed: np.ndarray, slots: list[np.ndarray], loo: bool) -> np.ndarray:
        x = np.empty((ORDERS + 1, len(packed)), np.float32)
        bit = packed & 1
        x[0] = tables[0].take(packed if loo else packed >> 1)
        for k, s in enumerate(slots, 1):
            x[k] = tables[k].take(s * 2 + bit if loo else s)
        x *= np.float32(0.1)
        return x

    def _place(self, kind: int, level: int, packed: np.ndarray) -> np.ndarray | int:
        return (packed >> 1) - self.code.words if kind else 256 + min(level, DEPTH - 1)

    def learn(self, block: Block) -> None:
        """One online step, of a turn that is one block."""
        self.settle(self.statistics(block))

    def statistics(self, block: Block) -> np.ndarray:
        """Gradient and curvature of each gate's loss, then the map's hits, summed over the block; no bit sees its own count."""
        slopes, curves, hits = np.zeros((GATES, ORDERS + 1)), np.zeros((GATES, ORDERS + 1, ORDERS + 1)), np.zeros(self.hits.size)
        weights = self.weights.astype(np.float32)
        for kind, *stream in block.streams(self.code):
            symbols, contexts, _ = deep_first(self.code, *stream)
            for level, _, packed, slots in levels(self.code, symbols, contexts):
                gate = kind * DEPTH + min(level, DEPTH - 1)
                x, y = self._inputs(self.without, packed, slots, True), packed & 1
                z = np.clip(weights[gate] @ x, -REACH, REACH)
                p = 1 / (1 + np.exp(-z))
                slopes[gate] += x @ (y.astype(np.float32) - p)
                curves[gate] += (x * (p * (1 - p))) @ x.T
                bucket = np.clip(np.rint(z * 2), -REACH, REACH).astype(np.int64) + REACH
                lo, width = (0, 256) if kind else (self._place(kind, level, packed), 1)
                own = ((self._place(kind, level, packed) - lo) * (2 * REACH + 1) + bucket) * 2 + y
                size = 2 * (2 * REACH + 1)
                hits[lo * size : (lo + width) * size] += np.bincount(own, minlength=width * size)
        return np.concatenate([slopes.ravel(), curves.ravel(), hits])

    def sums(self) -> int:
        """Length of statistics()."""
        return GATES * (ORDERS + 1) * (ORDERS + 2) + self.hits.size

    def settle(self, sums: np.ndarray) -> None:
        """One online step: the weights move by a turn's gradient and the curvature of all turns so far; its hits join the map's."""
        k = ORDERS + 1
        slopes, curves, hits = np.split(sums, [GATES * k, GATES * k * (1 + k)])
        self.curves = self.curves + curves.reshape(-1, k, k)
        damp = 1 + 1e-3 * np.trace(self.curves, axis1=1, axis2=2) / k
        moved = self.weights + np.linalg.solve(self.curves + damp[:, None, None] * np.eye(k), slopes.reshape(-1, k)[:, :, None])[:, :, 0]
        self.weights, self.hits = np.clip(moved, -WEIGHT, WEIGHT), self.hits + hits.reshape(self.hits.shape)

    def log10(self, block: Block) -> np.ndarray:
        """log10 probability of each token after those before it: the sum over its bits."""
        total = np.zeros(len(block.h))
        logs, weights = self._log_table() if self._logs is None else self._logs, self.weights.astype(np.float32)
        for kind, *stream in block.streams(self.code):
            symbols, contexts, words = deep_first(self.code, *stream)
            own = np.zeros(len(symbols))
            for level, n, packed, slots in levels(self.code, symbols, contexts):
                z = weights[kind * DEPTH + min(level, DEPTH - 1)] @ self._inputs(self.plain, packed, slots, False)
                bucket = np.clip(np.rint(z * STEP), -REACH * STEP, REACH * STEP).astype(np.int64) + REACH * STEP
                own[:n] += logs.take((self._place(kind, level, packed) * (2 * REACH * STEP + 1) + bucket) * 2 + (packed & 1))
            first = int(words.min()) if len(words) else 0
            sums = np.bincount(words - first, own)
            total[first : first + len(sums)] += sums
        return total


def refined(p: np.ndarray, block: Block) -> np.ndarray:
    """The document's refinement of log10 probabilities: earlier places of the same word in it."""
    t = np.arange(len(p)) - np.repeat(block.starts, block.lengths)
    doc = np.repeat(np.arange(len(block.starts)), block.lengths)
    _, dense = np.unique(block.ids, return_inverse=True)
    bits = max(1, int(len(p)).bit_length())
    key = np.sort(((doc * (int(dense.max()) + 1) + dense) << bits) + np.arange(len(p)))
    at, group = key & ((1 << bits) - 1), key >> bits
    first = np.concatenate([[True], group[1:] != group[:-1]])
    earlier = np.empty(len(p), np.int64)
    earlier[at] = np.arange(len(p)) - np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))
    gate = GATE * t / (t + GATE_HALF)
    out, again = p + np.log10(1 - gate), np.flatnonzero(earlier)
    out[again] = np.logaddexp(out[again] * _LN10, np.log(gate[again] * earlier[again] / t[again])) / _LN10
    return out


def _held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def turn_of(text: str | None) -> int:
    """The turn in which a document is learned from: by hash, 1/64, 3/64, 12/64 and 48/64 of all."""
    top = xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 64 - 2 * (TURNS - 1)
    return (top.bit_length() + 1) // 2


_ENCODED = "number long, docs array<struct<doc_id:bigint,n_tokens:bigint,n_bytes:bigint,held:boolean,turn:int>>, tokens binary, words binary, letters array<bigint>"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("held", pa.bool_()), ("turn", pa.int32())]))


def _encoded(batches):
    """Blocks of documents: their tokens as numbers of the block's distinct words, and bytes of the training words, a 0x20 after each."""
    docs, texts, held, number = [], [], 0, TaskContext.get().partitionId() << 32

    def made():
        tokens, words = encode(texts)
        learned = np.repeat([not d["held"] for d in docs], [d["n_tokens"] for d in docs])
        counts, flat = np.bincount(tokens[learned], minlength=len(words)), b" ".join(words)
        counts[0] = 0
        text = np.frombuffer(flat + b" ", np.uint8)
        letters = np.bincount(text, np.repeat(counts, np.fromiter(map(len, words), np.int64, len(words)) + 1), 256)
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([docs], _DOCS), pa.array([tokens.tobytes()], pa.binary()), pa.array([flat], pa.binary()), pa.array([letters.astype(np.int64)])], ["number", "docs", "tokens", "words", "letters"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            texts.append(words)
            docs.append({"doc_id": doc_id, "n_tokens": len(words) + 1, "n_bytes": len(text.encode("utf-8", "surrogatepass")) if text else 0, "held": _held_out(doc_id), "turn": turn_of(text)})
            held += len(text or "")
            if held >= BLOCK_CHARS:
                yield made()
                docs, texts, held, number = [], [], 0, number + 1
    if docs:
        yield made()


def _blocks(batches, code: Code | None = None, training: bool = True, turn: int | None = None):
    """(number, documents, block) of encoded rows; of training documents only (all, or those of a turn), or of all."""
    for batch in batches:
        for i in range(batch.num_rows):
            docs = batch.column(1)[i].as_py()
            tokens = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint32)
            lengths = np.fromiter((d["n_tokens"] for d in docs), np.int64, len(docs))
            if training:
                keep = np.fromiter((not d["held"] and turn in (None, d["turn"]) for d in docs), bool, len(docs))
                tokens, lengths = tokens[np.repeat(keep, lengths)], lengths[keep]
            if len(lengths):
                words = batch.column(3)[i].as_py().split(b" ")
                met = np.zeros(len(words), bool)
                met[tokens] = True
                yield batch.column(0)[i].as_py(), docs, Block((np.cumsum(met) - 1)[tokens], lengths, list(compress(words, met.tolist())), code)


def _counted(batches):
    """(h, n): hashes of words (even) and segments (odd) of a block's training texts, and their counts."""
    for _, _, block in _blocks(batches):
        counts = np.bincount(block.ids, minlength=len(block.words))
        own = np.flatnonzero(counts)
        segments, n = np.unique(block.segments()[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([block.hashes[own], segments]).view(np.int64)), pa.array(np.concatenate([counts[own], n]))], ["h", "n"])


_SUMS = "order int, lo int, part int, sums binary"


def _pieces(tables: list[np.ndarray]):
    part = TaskContext.get().partitionId()
    for k, table in enumerate(tables):
        for lo in range(0, len(table), PIECE):
            own = table[lo : lo + PIECE]
            if own.any():
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (k, lo, part)), pa.array([own.tobytes()], pa.binary())], ["order", "lo", "part", "sums"])


def _tables(shared):
    """Pieces of the counts of a task's text: order 0 holds its bytes of escaped words."""

    def run(batches):
        code = shared.value
        tables = [np.zeros(256, np.int32), *(np.zeros(2 * SLOTS, np.int32) for _ in range(ORDERS))]
        count_bits(code, tables[0], tables[1:], (block for _, _, block in _blocks(batches, code)))
        yield from _pieces([t.astype(np.float64) if k == 0 else t for k, t in enumerate(tables)])

    return run


def _mixer_sums(shared, weights: np.ndarray, turn: int):
    """Statistics of a turn's text in a task, under these weights."""

    def run(batches):
        mixer, total = copy.copy(shared.value), None
        mixer.weights = weights
        for _, _, block in _blocks(batches, mixer.code, turn=turn):
            sums = mixer.statistics(block)
            total = sums if total is None else total + sums
        if total is not None:
            yield from _pieces([total])

    return run


def _piece_sum(table: pa.Table) -> pa.Table:
    """The sum of pieces; counts of a task are 32-bit numbers, all else is in doubles, exact up to 2**53."""
    total = None
    for c in table.column("sums"):
        own = np.frombuffer(c.as_buffer(), np.int32 if len(c.as_buffer()) == 4 * PIECE else np.float64).astype(np.float64)
        total = own if total is None else total + own
    return pa.table({"order": table.column("order").slice(0, 1), "lo": table.column("lo").slice(0, 1), "part": pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def _summed(pieces: DataFrame, tasks: int, sizes: list[int]) -> list[np.ndarray]:
    """Tables of fixed size, summed over tasks by a tree in which no task reads more than FAN_IN rows of a piece."""
    while True:
        pieces = pieces.groupBy("order", "lo", F.floor(F.col("part") / FAN_IN)).applyInArrow(lambda table: _piece_sum(table), _SUMS)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            break
    totals = [np.zeros(n) for n in sizes]
    for r in pieces.toLocalIterator():
        own = np.frombuffer(r.sums)
        totals[r.order][r.lo : r.lo + len(own)] = own
    return totals


def fit(encoded: DataFrame, hashes: np.ndarray, counts: np.ndarray, total: int) -> Mixer:
    """Mixer with codes, tables, weights and map from all training texts; its code has the given frequent words."""
    context = encoded.sparkSession.sparkContext
    letters = np.zeros(256, np.int64)
    for r in encoded.select(F.posexplode("letters").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n")).collect():
        letters[r.byte] = r.n
    others = total - int(counts.sum())
    code = Code(hashes, counts, others, letters)
    chars = encoded.agg(F.coalesce(F.sum(F.expr("aggregate(docs, 0L, (a, d) -> a + d.n_bytes)")), F.lit(0))).first()[0]
    tasks = max(1, -(-chars // TASK_CHARS))
    spread = encoded.coalesce(tasks)
    shared = context.broadcast(code)
    letters, *totals = _summed(spread.mapInArrow(tidied(_tables(shared)), _SUMS), tasks, [256, *[2 * SLOTS] * ORDERS])
    shared.destroy()
    orders = [code.node_bits(np.concatenate([counts, [others], letters])), *map(subtotals, totals)]
    plain, without = zip(*map(stretched, orders), strict=True)
    mixer = Mixer(code, list(plain), list(without))
    shared = context.broadcast(mixer)
    for turn in range(TURNS):
        (sums,) = _summed(spread.mapInArrow(tidied(_mixer_sums(shared, mixer.weights, turn)), _SUMS), tasks, [mixer.sums()])
        mixer.settle(sums)
    shared.destroy()
    return mixer.scorer()


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash, so a sorted array falls into runs."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_BLOCK = {"block": pa.int64(), "bucket": pa.int64(), "data": pa.binary(), "docs": pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_rare", pa.int64()), ("n_segments", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.float64())])), "rare": pa.binary(), "segments": pa.binary(), "own": pa.binary(), "logs": pa.binary()}
_BLOCKS = "block long, bucket long, data binary, docs array<struct<doc_id:bigint,n_tokens:bigint,n_known:bigint,n_rare:bigint,n_segments:bigint,n_bytes:bigint,base:double>>, rare binary, segments binary, own binary, logs binary"


def _block_rows(number: int, docs: list, block: Block, mixer: Mixer, buckets: int):
    """One row of the block's documents, rare words and segments as places in its sorted hashes; then those by bucket."""
    code = mixer.code
    p = refined(mixer.log10(block), block)
    rare = block.symbols == code.escape
    found, first = block.segments()
    h, where = np.unique(np.concatenate([block.h[rare], found]), return_inverse=True)
    n_rare = int(rare.sum())
    doc = np.searchsorted(block.starts, first, "right") - 1
    key, place, often = np.unique(np.stack([doc, where[n_rare:]]), axis=1, return_inverse=True, return_counts=True)
    held = np.fromiter((d["held"] for d in docs), bool, len(docs))
    own = np.where(held[doc], 0, often[place.ravel()])
    known = np.append(np.log10(code.counts + 0.5), 0.0)
    per = zip([d["doc_id"] for d in docs], block.lengths.tolist(), np.add.reduceat(~rare, block.starts, dtype=np.int64).tolist(), np.add.reduceat(rare, block.starts, dtype=np.int64).tolist(), np.bincount(doc, minlength=len(docs)).tolist(), [d["n_bytes"] for d in docs], np.add.reduceat(known.take(block.symbols), block.starts).tolist(), strict=True)
    names = ("doc_id", "n_tokens", "n_known", "n_rare", "n_segments", "n_bytes", "base")
    yield number, None, None, [dict(zip(names, x, strict=True)) for x in per], where[:n_rare].astype("<u4").tobytes(), where[n_rare:].astype("<u4").tobytes(), own.astype("<u4").tobytes(), np.add.reduceat(p, first).tobytes()
    which = _bucket_of(h, buckets)
    cuts = np.flatnonzero(np.diff(which)) + 1
    for part, b in zip(np.split(h, cuts), which[np.concatenate([[0], cuts])], strict=True):
        yield number, int(b), part.tobytes(), None, None, None, None, None


def _blocked(buckets: int, shared):
    def run(batches):
        for number, docs, block in _blocks(batches, shared.value.code, False):
            made = list(_block_rows(number, docs, block, shared.value, buckets))
            for lo in range(0, len(made), 64):
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in made[lo : lo + 64]], t) for c, t in enumerate(_BLOCK.values())], list(_BLOCK))

    return run


def _answered(asked: pa.Table, counted: pa.Table) -> pa.Table:
    """For each block's hashes of a bucket: counts, in the same order; 0 where training has none."""
    h = counted.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    h, n = np.append(h[order], np.uint64(0)), np.append(counted.column("n").to_numpy()[order], 0)
    out = []
    for data in asked.column("data"):
        own = np.frombuffer(data.as_buffer(), np.uint64)
        at = np.minimum(np.searchsorted(h[:-1], own), len(h) - 1)
        out.append(np.where(h[at] == own, n[at], 0).astype(np.int64).tobytes())
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "data": pa.array(out, pa.binary())})


def _scored(total: int, distinct: int, segments: int, memory: float):
    """base_score, n_known and score of the documents of a block, from the counts of its rare words and segments."""
    base_of = np.log10(total + 0.5 * (distinct + 1))

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist(), strict=True))
        counts = np.concatenate([np.frombuffer(d, np.int64) for _, d in parts]) if parts else np.zeros(0, np.int64)
        rows = []
        for r in blocks.to_pylist():
            rare, at = counts[np.frombuffer(r["rare"], "<u4")], np.frombuffer(r["segments"], "<u4")
            others, p = counts[at] - np.frombuffer(r["own"], "<u4"), np.frombuffer(r["logs"])
            seen = np.flatnonzero(others > 0)
            p = p + np.log10(1 - memory)
            p[seen] = np.logaddexp(p[seen] * _LN10, np.log(memory * others[seen] / segments)) / _LN10 if len(seen) else 0
            i = j = 0
            for d in r["docs"]:
                own = rare[i : i + d["n_rare"]]
                rows.append((d["doc_id"], d["n_tokens"], d["n_known"] + int((own > 0).sum()), d["base"] + float(np.log10(own + 0.5).sum()) - d["n_tokens"] * base_of, float(p[j : j + d["n_segments"]].sum()), d["n_bytes"]))
                i, j = i + d["n_rare"], j + d["n_segments"]
        return pa.table({k: pa.array([r[c] for r in rows], t) for c, (k, t) in enumerate({"doc_id": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64(), "n_bytes": pa.int64()}.items())})

    return run


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, LEXICON at most, by count: all words above a count that all share."""
    words = counted.filter("h & 1 = 0 and n > 1")
    power = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r.power: r["count"] for r in words.groupBy(power.alias("power")).count().collect()}  # a few hundred powers at most
    least, left = None, LEXICON
    for p in sorted(sizes, reverse=True):
        left -= sizes[p]
        if left < 0:
            break
        least = p
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = words.filter(power >= least).select("h", "n").toArrow()  # LEXICON rows at most
    h, n = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.lexsort([h, -n])
    return h[order], n[order]


def language_model_scores(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1 (a null doc_id is learned from). Tokens are the words
    [^\\x20\\x09-\\x0D]+ with A-Z lowered, then one end. base_score is the add-half unigram log10 probability; score is the model's. bits_per_byte
    is null for a text without bytes. Null and empty texts are one end token; repeated rows count and score each on
    their own; other columns are ignored; an empty table gives an empty result. Words and segments are told apart by
    64-bit hashes. One row of a single text is held in memory whole, with about ten times its size.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    encoded = cut(plain.mapInArrow(tidied(_encoded), _ENCODED), "encoded")
    parts = encoded.mapInArrow(tidied(_counted), "h long, n long")
    counted = cut(parts.groupBy("h").agg(F.sum("n").alias("n"), F.count("*").cast("int").alias("blocks")), "counted")
    word = F.col("h").bitwiseAND(1) == 0
    sums = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(a) for a, c in {"total": F.when(word, F.col("n")), "segments": F.when(~word, F.col("n")), "again": F.when(~word & (F.col("n") > 1), F.col("n")), "asked": F.col("blocks")}.items()), F.count(F.when(word, 1)).alias("distinct")).first()
    mixer = fit(encoded, *_frequent(counted), sums["total"])
    memory = (sums["again"] + 0.5) / (sums["segments"] + 2)
    buckets = max(partitions(spark), -(-sums["asked"] // BUCKET_ROWS))
    unsigned = F.shiftrightunsigned("h", 32)
    ranged = counted.select(F.shiftright(unsigned * buckets, 32).alias("bucket"), "h", "n")
    blocks = cut(encoded.mapInArrow(tidied(_blocked(buckets, spark.sparkContext.broadcast(mixer))), _BLOCKS), "blocks")
    asked = blocks.filter("bucket is not null").select("block", "bucket", "data")
    answers = asked.groupBy("bucket").cogroup(ranged.groupBy("bucket")).applyInArrow(_answered, "block long, bucket long, data binary")
    texts = blocks.filter("bucket is null").select("block", "docs", "rare", "segments", "own", "logs")
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(sums["total"], sums["distinct"], sums["segments"], memory), "doc_id long, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * F.log2(F.lit(10.0)) / F.col("n_bytes"))
    return scored.select("doc_id", held().alias("held_out"), "n_tokens", "n_known", F.lit(sums["total"]).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))
