"""Personal data: exact identifiers, and terms that reveal them.

Identifiers (e-mail, IP, card, phone) are the protected entities. A context is a line; equal lines are one context
throughout, so copies change nothing. Over all contexts of the corpus, pointwise mutual information PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t))) says how much a term t reveals of an entity
e, whose whole information is IC(e) = log2(N / n(e)). Terms of e's contexts that disclose at least GENERALISE of IC(e)
are generalised to their kind wherever they stand, in any text; those that disclose at least REMOVE are removed. A term needs SUPPORT different
contexts with e, so that chance neighbours of an entity seen once, or copies of one line, prove nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, maybe_members, membership, tidied

KINDS = ("email", "ip", "card", "phone")
GENERALISE, REMOVE, SUPPORT = 0.8, 0.95, 3

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[@0-9]")
_WORD = re.compile(r"\S+")
_TERM = re.compile(r"\w[\w'-]*")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: an address ends at the @ that its local run reaches, so each @ is looked at once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[::-2]) + sum(int(c) * 2 - 9 * (c > "4") for c in digits[-2::-2])
    return total % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; ends exclusive, in code points."""
    if not text or not _HINT.search(text):
        return []
    out = [("email", *s) for s in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-8:]) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group()) if m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def neighbours(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Each line with identifiers: its hash, its entities, and its terms, identifiers themselves left out."""
    ends = [i for i, c in enumerate(text) if c == "\n"] + [len(text)]
    lines: dict[int, list[tuple[str, int, int]]] = {}
    for span in spans:
        lines.setdefault(bisect_left(ends, span[1]), []).append(span)
    out = []
    for i, own in lines.items():
        lo, hi = ends[i - 1] + 1 if i else 0, ends[i]
        entities = {_hash(f"{kind}:{text[s:e]}") for kind, s, e in own}
        terms = {_hash(term) for a, b in outside(text, own, lo, hi) if (term := term_of(text[a:b].lower()))}
        out.append({"context": _hash(text[lo:hi]), "entities": sorted(entities), "terms": sorted(terms)})
    return out


def outside(text: str, spans: list[tuple[str, int, int]], lo: int, hi: int):
    """(start, end) of the words from lo to hi that overlap no span."""
    held = sorted((x, y) for _, x, y in spans)
    at, last = 0, lo  # of the spans that start before the word ends, the furthest end
    for m in _WORD.finditer(text, lo, hi):
        a, b = m.span()
        while at < len(held) and held[at][0] < b:
            last = max(last, held[at][1])
            at += 1
        if a >= last:
            yield a, b


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_FOUND = "doc_id long, version long, base string, counts array<bigint>, near array<struct<context:bigint,entities:array<bigint>,terms:array<bigint>>>"
_NEAR = pa.list_(pa.struct([("context", pa.int64()), ("entities", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64()))]))


def _scan(batches):
    for batch in batches:
        base, counts, near = [], [], []
        for text in batch.column(1).to_pylist():
            spans = identifiers(text or "")
            base.append(_joined(spans))
            kinds = [s[0] for s in spans]
            counts.append([kinds.count(k) for k in KINDS])
            near.append(neighbours(text, spans) if spans else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(base, pa.string()), pa.array(counts, pa.list_(pa.int64())), pa.array(near, _NEAR)], ["doc_id", "version", "base", "counts", "near"])


def term_of(word: str) -> str | None:
    """The term of a lower-case word: its first run of word characters, apostrophes and hyphens."""
    if word.isalnum():
        return word
    m = _TERM.search(word)
    return m.group() if m else None


class Wanted:
    """Words whose term a bitmap lets pass; words that don't are remembered up to a bound, so that most texts cost set operations only."""

    LIMIT = 600_000

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.cold = bitmap, set()
        self.hot: dict[str, int] = {}

    def learn(self, words: list[set[str]]) -> None:
        """Sort the words of a batch into cold and hot ones."""
        if len(self.cold) + len(self.hot) > self.LIMIT:
            self.cold, self.hot = set(), {}
        new = [w for w in set().union(*(own - self.cold for own in words)) if w not in self.hot]
        terms = [(w, _hash(t)) for w in new if (t := term_of(w.lower()))]
        if terms:
            keep = np.flatnonzero(maybe_members(self.bitmap, np.array([h for _, h in terms], np.int64)))
            self.hot.update(terms[i] for i in keep.tolist())
        self.cold.update(w for w in new if w not in self.hot)

    def of(self, words: set[str]) -> set[str]:
        return {w for w in words - self.cold if w in self.hot}


#: Texts whose words are held at once.
SLICE = 512


def _term_lines(shared, most: int):
    """(term, line): hashes of wanted terms and of the different lines that hold them; with term 0, the hash of every line.

    Of a term with more than most lines in a batch, so many that it discloses nothing, one more than most are enough.
    """

    def run(batches):
        wanted = Wanted(shared.value)
        for batch in batches:
            found: dict[int, set[int]] = {}
            hashes = []
            for at in range(0, batch.num_rows, SLICE):
                texts = [t for t in batch.column(0).slice(at, SLICE).to_pylist() if t]
                hashes.append(np.unique(np.array([_hash(line) for t in texts for line in t.split("\n")], np.int64)))
                words = [set(t.lower().split()) for t in texts]
                wanted.learn(words)
                for text, own in zip(texts, words, strict=True):
                    if hit := wanted.of(own):
                        for line in text.split("\n"):
                            for w in hit.intersection(line.lower().split()):
                                places = found.setdefault(wanted.hot[w], set())
                                if len(places) <= most:
                                    places.add(_hash(line))
            lines = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.int64)
            terms, held = [t for t, own in found.items() for _ in own], [h for own in found.values() for h in own]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(len(lines), np.int64), np.array(terms, np.int64)])), pa.array(np.concatenate([lines, np.array(held, np.int64)]))], ["term", "line"])

    return run


def _marked(shared):
    """Places of the terms that a broadcast bitmap lets pass, outside identifiers."""

    def run(batches):
        wanted = Wanted(shared.value)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                words = [set(t.split()) if t else set() for t in texts]
                wanted.learn(words)
                for doc_id, text, version, own in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), words, strict=True):
                    if hit := wanted.of(own):
                        for a, b in outside(text, identifiers(text), 0, len(text)):
                            if (word := text[a:b]) in hit:
                                out.append((doc_id, version, wanted.hot[word], *_TERM.search(text, a, b).span()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["doc_id", "version", "term", "start", "stop"])

    return run


def disclosures(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity, term, share): how much of the entity's information a term gives away, where it is at least GENERALISE."""
    context = texts.sparkSession.sparkContext
    lines = cut(found.select(F.explode("near").alias("x")).select("x.*").dropDuplicates(["context"]), "lines")

    def often(column: str) -> tuple[DataFrame, DataFrame]:
        """(context, value) of the values with at least SUPPORT contexts, and those values' numbers of contexts."""
        rows = lines.select("context", F.explode(column).alias("value"))
        counts = rows.groupBy("value").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT)
        return rows.join(counts.select("value"), "value", "left_semi"), counts

    (with_entity, entities), (with_term, terms) = often("entities"), often("terms")
    both = with_entity.withColumnRenamed("value", "entity").join(with_term.withColumnRenamed("value", "term"), "context")
    pairs = both.groupBy("entity", "term").agg(F.count("*").alias("support")).filter(F.col("support") >= SUPPORT)
    pairs = pairs.join(entities.select(F.col("value").alias("entity"), F.col("n").alias("contexts")), "entity")
    # a share of GENERALISE needs n(t) <= n(e, t) * (N / n(e)) ** (1 - GENERALISE); copies make N no smaller, contexts with identifiers n(t) no larger
    copies = texts.agg(F.coalesce(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1), F.lit(1))).first()[0]
    most = F.col("support") * F.pow(F.lit(float(copies)) / F.col("contexts"), F.lit(1 - GENERALISE)) + 1
    pairs = cut(pairs.join(terms.select(F.col("value").alias("term"), F.col("n").alias("least")), "term").filter(F.col("least") <= most).withColumn("most", most), "pairs")
    bound = pairs.agg(F.coalesce(F.max("most"), F.lit(0.0))).first()[0]
    wanted = context.broadcast(membership(pairs, "term"))
    spread = cut(texts.select("text").mapInArrow(tidied(_term_lines(wanted, int(bound))), "term long, line long"), "lines")
    total = spread.filter("term = 0").select("line").distinct().count()
    counts = spread.filter("term <> 0").distinct().groupBy("term").agg(F.count("*").alias("n"))
    scored = pairs.join(counts, "term")
    pmi = F.log2(F.col("support") * F.lit(float(total)) / (F.col("contexts") * F.col("n")))
    whole = F.log2(F.lit(float(total)) / F.col("contexts"))
    return scored.withColumn("share", F.when(whole > 0, pmi / whole).otherwise(0.0)).filter(F.col("share") >= GENERALISE).select("entity", "term", "share")


def _finish(batches):
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_terms"]
    for batch in batches:
        base, terms = batch.column("base").to_pylist(), batch.column("terms").to_pylist()
        counts = batch.column("counts").to_pylist()
        shown, added = [], []
        for b, found in zip(base, terms, strict=True):
            extra = sorted({(t["kind"], t["start"], t["stop"]) for t in found or []})
            shown.append(",".join(filter(None, [b, _joined(extra)])))
            added.append(len(extra))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))), pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()), pa.array(shown, pa.string()), pa.array(added, pa.int64())],
            names,
        )


def personal_data(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms; one row for each row.

    spans lists kind:start:end (code points, end exclusive): identifiers by kind as in KINDS, then start; then terms to
    be generalised and to be removed (kinds term_general and term_remove). base_sha256 covers the identifiers' part.
    Null and empty texts have no span; repeated rows get equal results; other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("version"))
    found = cut(plain.mapInArrow(tidied(_scan), _FOUND), "found")
    risky = cut(disclosures(found, plain.select("text")).groupBy("term").agg(F.max("share").alias("share")), "risky")
    shared = docs.sparkSession.sparkContext.broadcast(membership(risky, "term"))
    places = plain.mapInArrow(tidied(_marked(shared)), "doc_id long, version long, term long, start int, stop int")
    kind = F.when(F.col("share") >= REMOVE, "term_remove").otherwise("term_general").alias("kind")
    terms = places.join(risky, "term").groupBy(F.col("doc_id").alias("d"), F.col("version").alias("v")).agg(F.collect_set(F.struct(kind, "start", "stop")).alias("terms"))
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_terms long"
    return found.select("doc_id", "version", "base", "counts").join(terms, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left").select("doc_id", "base", "counts", "terms").mapInArrow(_finish, schema)


def sanitised(text: str | None, spans: str) -> str | None:
    """The text with identifiers and terms of a spans string replaced by their kinds, and terms to be removed cut out."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for s, e, kind in sorted((int(x[1]), int(x[2]), x[0]) for x in (span.split(":") for span in spans.split(","))):
        if s < at:
            continue
        parts += [text[at:s], "" if kind == "term_remove" else "[TERM]" if kind == "term_general" else f"[{kind.upper()}]"]
        at = e
    return "".join([*parts, text[at:]])
