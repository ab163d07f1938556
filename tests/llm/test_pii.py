import hashlib
import random
import re
import time
from math import log2

from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm.pii import _TERM, GENERALISE, REMOVE, SUPPORT, identifiers, luhn, neighbours, personal_data, sanitised


def plain(text):
    """The contract's patterns, searched as they stand."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@given(st.text("a@.1+-( 9\n", max_size=40))
def test_patterns(text):
    assert identifiers(text) == plain(text)


def test_cards_and_long_runs():
    for text in ("4337166598464399", "4337 1665 9846 4399", "4337166598464398", "+1 (988) 555-2485", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.255", "a@b.c@d.e", "@a.b", "x@y"):
        assert identifiers(text) == plain(text)
    assert identifiers("1" * 300_000 + "@" * 1000 + "." * 1000) == []


def test_rows_terms_and_sanitising(spark):
    noise = [f"common words fill line number {'abcdefghij'[i % 10] * 3} here and there" for i in range(200)]
    rows = [(i, t) for i, t in enumerate(noise)]
    secret = ["Gardener Zyxw writes from bob.x@mail.org with ease", "mail bob.x@mail.org or ask zyxw again", "zyxw prefers bob.x@mail.org always"]
    rows += [(1000 + i, t) for i, t in enumerate(secret)] + [(2000, None), (2001, ""), (2002, "call +1 (988) 555-2485 now"), (2002, "call +1 (988) 555-2485 now")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in personal_data(docs).collect()}
    for d, t in rows:
        base = plain(t or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[d].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and got[d].spans.startswith(joined)
        assert [got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone] == [sum(k == b[0] for b in base) for k in ("email", "ip", "card", "phone")]
        if d < 1000:
            assert got[d].spans == ""
    for i, t in enumerate(secret):
        terms = [s.split(":") for s in got[1000 + i].spans.split(",")[1:]]
        assert [t[int(a) : int(b)].lower() for _, a, b in terms] == ["zyxw"] and terms[0][0] == "term_remove"
        assert "bob" not in sanitised(t, got[1000 + i].spans) and "yxw" not in sanitised(t, got[1000 + i].spans)
    assert len(personal_data(docs).filter("doc_id = 2002").collect()) == 2
    assert personal_data(docs.limit(0)).collect() == []


def test_far_terms_are_marked_everywhere(spark):
    far = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"common words fill line number {i} here and there {far}") for i in range(995)] * 2
    told = [f"Zyxw {x} {far} bob.x@mail.org" for x in ("once", "twice", "again", "often", "seldom")]
    rows += [(1000 + i, t) for i, t in enumerate(told)] + [(2000, "no address\nbut zyxw, twice: ZYXW"), (2001, "bob.x@mail.org\nzyxw"), (2001, "bob.x@mail.org\nzyxw"), (None, "zyxw")]
    got = personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    marked = lambda d: [r.spans for r in got if r.doc_id == d]
    assert all(marked(1000 + i)[0].endswith(",term_general:0:4") for i in range(5))
    assert marked(2000) == ["term_general:15:19,term_general:28:32"] and marked(None) == ["term_general:0:4"]
    assert marked(2001) == ["email:0:14,term_general:15:19"] * 2
    assert not any(r.spans for r in got if r.doc_id is not None and r.doc_id < 1000)


def slow_shares(texts):
    """Term -> largest share it discloses of an identifier, over different lines."""
    lines = {line for t in texts if t for line in t.split("\n")}
    held = {}
    for line in lines:
        spans = identifiers(line)
        covered = lambda a, b, spans=spans: any(s < b and a < e for _, s, e in spans)
        words = [(m.start(), m.end()) for m in re.finditer(r"\S+", line)]
        outside = {m.group().lower() for a, b in words if not covered(a, b) and (m := _TERM.search(line, a, b))}
        anywhere = {m.group() for w in line.lower().split() if (m := _TERM.search(w))}
        held[line] = ({f"{k}:{line[s:e]}" for k, s, e in spans}, outside, anywhere)
    out = {}
    for entity in {e for es, _, _ in held.values() for e in es}:
        own = [v for v in held.values() if entity in v[0]]
        for term in {t for v in own for t in v[1]}:
            n = sum(term in v[1] for v in own)
            if n >= SUPPORT:
                whole = log2(len(lines) / len(own))
                share = log2(n * len(lines) / (len(own) * sum(term in v[2] for v in held.values()))) / whole if whole > 0 else 0.0
                if share >= GENERALISE:
                    out[term] = max(out.get(term, 0.0), share)
    return out


def test_disclosures_by_brute_force_and_doubled(spark):
    rng = random.Random(6)
    people = [(f"p{i}@mail.org", f"Nickname{i}") for i in range(6)]
    common = [f"word{i}" for i in range(40)]
    line = lambda: " ".join(rng.choices(common, k=rng.randint(3, 9)))
    texts = []
    for _ in range(300):
        parts = [line()]
        if rng.random() < 0.4:
            address, name = rng.choice(people)
            parts.append(f"{line()} {address} {name if rng.random() < 0.8 else rng.choice(people)[1]} {rng.choice(common)}")
        if rng.random() < 0.1:
            parts.append(f"{rng.choice(people)[1].upper()} {line()}")
        texts.append("\n".join(parts))
    shares = slow_shares(texts)
    assert len(shares) >= 4
    once = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in once:
        text = texts[r.doc_id]
        want = sorted(("term_remove" if shares[m.group().lower()] >= REMOVE else "term_general", m.start(), m.end()) for w in re.finditer(r"\S+", text) if not any(s < w.end() and w.start() < e for _, s, e in identifiers(text)) and (m := _TERM.search(text, w.start(), w.end())) and m.group().lower() in shares)
        assert r.spans == ",".join([f"{k}:{s}:{e}" for k, s, e in [*plain(text), *want]])
    twice = personal_data(spark.createDataFrame([(i + 1000 * k, t) for k in range(2) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)).collect()
    spans = {r.doc_id: r.spans for r in once}
    assert len(twice) == 600 and all(r.spans == spans[r.doc_id % 1000] for r in twice)


def test_many_addresses_on_a_line():
    text = " ".join(f"user{i}@mail.org word{i}" for i in range(20_000))
    began = time.perf_counter()
    (found,) = neighbours(text, identifiers(text))
    assert time.perf_counter() - began < 1 and len(found["entities"]) == len(found["terms"]) == 20_000
