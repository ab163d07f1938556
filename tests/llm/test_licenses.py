import random
import re
import time

from scriptorium.llm.licenses import EXACT, NOTICES, PHRASES, allowed, candidates, license_scan, notices, parts, pieces, scan


def test_base_against_word_search():
    texts = ["CC-BY and cc  by!", "general public LICENSE; General... Public license", "All rights reserved", "allrights reserved", "ccc by cc byé", "", None, "é cc\nby"]
    for t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        got = scan(t)
        assert got["n_words"] == len(words) and got["n_base"] == len(places)
        assert got["first_word"] == min((i for i, _ in places), default=None) and got["last_word"] == max((i for i, _ in places), default=None)
        assert got["base_labels"] == ",".join(sorted({label for _, label in places}))


def test_pieces_cover_notices():
    for n in NOTICES:
        cut = pieces(n, allowed(n) + 1)
        assert "".join(p for _, p in cut) == n and all(p for _, p in cut) and "".join(p for p, _ in parts(n)) == n


def soft_places(notice):
    at, out = 0, []
    for text, edits in parts(notice):
        out += [i for i in range(at, at + len(text)) if edits]
        at += len(text)
    return out


def test_fuzzy_notices_with_edits():
    lead = "some words before "
    for n, label in NOTICES.items():
        soft = soft_places(n)
        for at in [i for i in soft[1:-1:7] if i + 1 in soft and i - 1 in soft]:
            for text in (n[:at] + "x" + n[at:], n[:at] + n[at + 1 :], n[:at] + "x" + n[at + 1 :], n):
                line = lead + text + " and words after"
                found = {NOTICES[f[0]] for f in candidates(line)}
                assert label in found and label in {NOTICES[f[0]] for f in notices(line)}, (n, text)
    assert notices("nothing of the kind stands in this line at all") == []


def test_licenses_are_told_apart():
    labels = lambda t: scan(t)["labels"]
    assert labels("Licensed under CC BY 4.0") == "cc-by"
    assert labels("licensed under cc by nd") == "cc-by,cc-by-nd"
    assert labels("licensed under CC BY-NC 4.0") == "cc-by,cc-by-nc" and labels("licensed under CC BY-NC-SA 4.0") == "cc-by,cc-by-nc-sa"
    assert labels("Creative Commons Attribution-NonCommercial") == "cc-by-nc"
    assert labels("GNU Lesser General Public License version 2.1") == "gpl,lgpl-2.1"
    assert labels("GNU General Public Licence, version 3") == "gpl-3.0" and labels("the gnu general public licence, version") == "gpl"
    assert labels("Licensed under the Apache License, Version 1.0") == "" and labels("released under the bsd license") == ""


def distance(notice, line):
    """Fewest edits of soft characters that make the notice equal to some words of the line; slow and plain."""
    soft, big, best = set(soft_places(notice)), 10**6, 10**6
    words = line.split(" ")
    for a in range(len(words)):
        for b in range(a + 1, min(len(words), a + len(notice.split()) + 4) + 1):
            text = " ".join(words[a:b])
            if abs(len(text) - len(notice)) > allowed(notice):
                continue
            row = [0]
            for i in range(1, len(text) + 1):
                row.append(row[-1] + 1 if 0 in soft else big)
            for j, c in enumerate(notice):
                new = [row[0] + 1 if j in soft else big]
                for i, x in enumerate(text, 1):
                    insert = 1 if j in soft or j + 1 in soft else big
                    new.append(min(row[i - 1] + (0 if x == c else 1 if j in soft else big), row[i] + (1 if j in soft else big), new[-1] + insert))
                row = new
            best = min(best, row[-1])
    return best


def test_candidates_against_edit_distance():
    rng = random.Random(8)
    seen = 0
    for notice in NOTICES:
        k, soft = allowed(notice), soft_places(notice)
        for edits in {0, 1, k, k + 1, k + 2}:
            text = list(notice)
            for at in sorted(rng.sample(soft, min(edits, len(soft))), reverse=True):
                kind = rng.randrange(3)
                text[at : at + 1] = [] if kind == 0 else [rng.choice("qzx")] if kind == 1 else [text[at], rng.choice("qzx")]
            line = "a " + "".join(text) + " of b"
            line = " ".join(line.split())
            want, got = distance(notice, line), [f for f in candidates(line) if f[0] == notice]
            assert bool(got) == (want <= k) and (not got or min(f[3] for f in got) == want), (line, notice, want, got)
            seen += want <= k
    assert seen > 3 * len(NOTICES) // 2


def test_long_texts_take_linear_time():
    for text in ("Released under the MIT license. " * 32_000, "Releasd under the MIT licence. " * 32_000, " ".join(NOTICES) * 200):
        began = time.perf_counter()
        assert scan(text)["spans"]
        assert time.perf_counter() - began < 2
    assert EXACT.isdisjoint({"license", "the"})


def test_rows(spark):
    docs = spark.createDataFrame([(1, "Licenced under the Apache License, Version 2.0"), (2, None), (3, "plain"), (3, "plain"), (None, "cc by " * 3)], "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan(docs).collect()}
    assert rows[1].labels == "apache-2.0" and 0.9 < rows[1].score < 1 and rows[1].n_base == 0
    assert rows[2].n_words == 0 and rows[2].score == 0 and rows[3].labels == ""
    assert rows[None].n_base == 3 and rows[None].last_word == 4 and rows[None].score == 1
    assert license_scan(docs.limit(0)).collect() == []
