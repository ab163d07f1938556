"""License scans: exact phrases, and fuzzy search of short notices.

A notice with up to k errors is cut into k + 1 pieces; one of them must stand in the text unchanged (pigeonhole). An
Aho-Corasick automaton finds the pieces in one pass; around each a window of bounded size must share enough trigrams
with the notice, and then the bounded-error matching of the regex library verifies it and reports its span and edits.
Words that tell one license from another (EXACT, and digits) take no edits.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices in normal form (words in lower case, one space between), and their labels. They are the
#: names and standard opening sentences of the common open licenses, as published with the licenses themselves.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "apache license version 2 0 january 2004": "apache-2.0",
    "spdx license identifier apache 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "spdx license identifier mit": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "spdx license identifier bsd 2 clause": "bsd-2-clause",
    "spdx license identifier bsd 3 clause": "bsd-3-clause",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "subject to the terms of the mozilla public license": "mpl",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "mozilla public license version 1 1": "mpl-1.1",
    "mozilla public license version 2 0": "mpl-2.0",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license as published by the free software foundation either version 2": "gpl-2.0-or-later",
    "gnu general public license as published by the free software foundation either version 3": "gpl-3.0-or-later",
    "spdx license identifier gpl 2 0": "gpl-2.0",
    "spdx license identifier gpl 3 0": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3.0",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3.0",
    "gnu free documentation license": "gfdl",
    "eclipse public license": "epl",
    "eclipse public license version 1 0": "epl-1.0",
    "eclipse public license version 2 0": "epl-2.0",
    "european union public licence": "eupl",
    "artistic license 2 0": "artistic-2.0",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "creative commons zero": "cc0",
    "dedicated to the public domain under cc0": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "boost software license version 1 0": "bsl-1.0",
    "permission to use copy modify and or distribute this software": "isc",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable": "zlib",
    "open data commons open database license": "odbl",
    "sil open font license version 1 1": "ofl-1.1",
    "all rights are reserved by the author": "reserved",
    "may not be reproduced without written permission": "reserved",
}
#: Words of notices that must stand as they are, as all digits must.
EXACT = frozenset(("apache", "mit", "bsd", "mozilla", "gpl", "lesser", "affero", "documentation", "eclipse", "european", "artistic", "cc", "by", "nc", "sa", "nd", "noncommercial", "sharealike", "noderivatives", "zero", "cc0", "boost", "database", "font", "gnu"))
#: Characters of a notice, without exact words, for each tolerated edit.
PER_EDIT = 10

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATORS else c for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


def parts(notice: str) -> list[tuple[str, bool]]:
    """(text, whether it takes edits) of a notice, in order; spaces beside an exact word belong to it."""
    out: list[tuple[str, bool]] = []
    words = notice.split(" ")
    for i, w in enumerate(words):
        soft = w not in EXACT and not w.isdigit()
        if out and out[-1][1] == soft:
            out[-1] = (f"{out[-1][0]} {w}", soft)
        else:
            if out and out[-1][1]:
                out.append((f" {w}", soft))
            elif out:
                out[-1] = (f"{out[-1][0]} ", False)
                out.append((w, soft))
            else:
                out.append((w, soft))
    return out


def allowed(notice: str) -> int:
    soft = sum(len(text) for text, edits in parts(notice) if edits)
    return max(1, soft // PER_EDIT) if soft else 0


def pieces(notice: str, count: int) -> list[tuple[int, str]]:
    """(offset, piece) of a notice cut evenly."""
    cuts = [len(notice) * i // count for i in range(count + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _trigrams(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(len(text) - 2)}


@cache
def _machine():
    auto, owners, fuzzy = ahocorasick.Automaton(), {}, {}
    for notice in NOTICES:
        k = allowed(notice)
        body = "".join(f"(?:{regex.escape(text)}){{e<={k}}}" if edits else regex.escape(text) for text, edits in parts(notice))
        grams = _trigrams(notice)
        fuzzy[notice] = (regex.compile(f"(?b)(?<![^ ]){body}(?![^ ])"), k, grams, len(grams) - 3 * k)
        for at, piece in pieces(notice, k + 1):
            owners.setdefault(piece, []).append((notice, at))
    for piece, who in owners.items():
        auto.add_word(piece, (len(piece), who))
    auto.make_automaton()
    return auto, fuzzy


class _Verified(dict):
    """(notice, window) -> (start, end, edits) in it, or None; emptied when large."""

    def __missing__(self, key: tuple[str, str]):
        if len(self) > 20_000:
            self.clear()
        notice, window = key
        rx, k, grams, least = _machine()[1][notice]
        found = None
        if len(grams & _trigrams(window)) >= least and (m := rx.search(window)) and sum(m.fuzzy_counts) <= k:
            found = (*m.span(), sum(m.fuzzy_counts))
        self[key] = found
        return found


_VERIFIED = _Verified()


def candidates(line: str) -> list[tuple[str, int, int, int]]:
    """(notice, start, end, edits) of every fuzzy notice in text in normal form: whole words, exact words unedited."""
    auto, fuzzy = _machine()
    starts: dict[str, set[int]] = {}
    for last, (size, who) in auto.iter(line):
        for notice, at in who:
            starts.setdefault(notice, set()).add(last + 1 - size - at)
    found = set()
    for notice, spots in starts.items():
        k, n, first, ends = fuzzy[notice][1], len(notice), None, None
        groups = []
        for a in sorted(spots):
            if a >= 0 and line.startswith(notice, a) and (a == 0 or line[a - 1] == " ") and line[a + n : a + n + 1] in ("", " "):
                found.add((notice, a, a + n, 0))
            elif first is not None and a <= first + 2 * k:
                groups[-1][1] = a
            else:
                first = a
                groups.append([a, a])
        for first, ends in groups:
            # a match starts within k of where its unchanged piece puts it, and is at most k longer
            lo, hi = max(0, first - k), min(len(line), ends + n + 2 * k)
            while lo > 0 and line[lo - 1] != " ":
                lo -= 1
                if first - lo > 4 * k:
                    break
            if lo and line[lo - 1] != " ":
                lo = line.find(" ", lo) + 1 or len(line)
            stop = line.find(" ", hi, hi + 2 * k + 1)
            hi = len(line) if stop < 0 and len(line) - hi <= 2 * k else stop if stop >= 0 else line.rfind(" ", 0, hi)
            if hi > lo and (hit := _VERIFIED[notice, line[lo:hi]]):
                found.add((notice, lo + hit[0], lo + hit[1], hit[2]))
    return sorted(found, key=lambda f: (f[1], f[2], f[0]))


_LONGEST = 2 * max(map(len, NOTICES))


def notices(line: str) -> list[tuple[str, int, int, int]]:
    """The candidates that stand: one goes where a longer notice covers it, or overlaps it, is no shorter and has fewer edits."""
    found = candidates(line)
    begins = [f[1] for f in found]
    out = []
    for f in found:
        n, s, e, edits = f
        near = found[bisect_left(begins, s - _LONGEST) : bisect_left(begins, e)]
        covered = any(g[1] <= s and e <= g[2] and len(g[0]) > len(n) for g in near)
        beaten = any(g[2] > s and g[3] < edits and len(g[0]) >= len(n) for g in near)
        if not covered and not beaten:
            out.append(f)
    return out


_EXACT = {phrase: re.compile(rf"(?<![^ ]){re.escape(phrase)}(?![^ ])") for phrase in PHRASES}


def scan(text: str | None) -> dict:
    """Words, exact places and fuzzy notices of one text; starts are word numbers from 0."""
    words = normal_words(text)
    line = b" ".join(words).decode("utf-8", "surrogatepass")
    places = [(m.start(), PHRASES[p]) for p, rx in _EXACT.items() if p in line for m in rx.finditer(line)]
    fuzzy = notices(line)
    spaces = [i for i, c in enumerate(line) if c == " "] if places or fuzzy else []
    starts = sorted(bisect_left(spaces, at) for at, _ in places)
    base = {label for _, label in places}
    spans = [(NOTICES[n], bisect_left(spaces, s), bisect_left(spaces, e), edits, 1 - edits / len(n)) for n, s, e, edits in fuzzy]
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": starts[0] if starts else None,
        "last_word": starts[-1] if starts else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s[0] for s in spans})),
        "score": 1.0 if base else max((s[4] for s in spans), default=0.0),
        "spans": [f"{label}:{a}:{b}:{edits}" for label, a, b, edits, _ in spans],
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are runs of digits, a-z (A-Z lowered) and non-ASCII characters. n_base counts the places where a phrase's
    words stand consecutively; first_word and last_word are their smallest and largest start (null without any).
    labels adds those of fuzzy notices; score is 1 for an exact phrase, else the best share of a notice without edits,
    else 0. spans lists fuzzy notices as label:first word:last word:edits. Null and empty texts have no words; repeated rows get equal
    results; other columns are ignored.
    """
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]

    def run(batches):
        for batch in batches:
            found = [scan(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[n] for f in found], t) for n, t in zip(names[1:], types[1:], strict=True))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
