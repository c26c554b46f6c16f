import hashlib
import random
import re

from shoplens.llm import secret_grammar as sg


def plain_base(text):
    """The contract read literally."""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def check(docs):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text or "")
    found = sg.span_digest(sg.scan(docs)).collect()
    for r in found:
        want = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert ",".join(p for p in r.spans.split(",") if not p.startswith("format")) == want
        assert r.n_assign == want.count("assign:") and r.n_access == want.count("access:") and r.n_hex == want.count("hex:")
    return found


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


CASES = ["token: token = abcdefgh", "API_KEY='short' apikey=\"longenough1\"", "passwd:x secret=......", "PaSsWoRd=abc+/_.=-",
         "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "AKIA" + "C" * 20, "é" * 5 + " token='" + "f" * 40 + "' é", "0" * 23, "a" * 24,
         "toKen = abcdef", "ſecret=abcdefg", "", "token=" + "x" * 5000]


def test_base_patterns(make_docs, small_docs, odd_docs):
    check(make_docs(list(enumerate(CASES))))
    check(small_docs)
    check(odd_docs)


def test_learnt_formats_add_spans(make_docs):
    rng = random.Random(1)
    prose = "the thing was written by hand and nothing in it looks like anything but words of a language "
    docs = [(i, f"{prose} token = \"{hexes(rng, 40)}\" {prose}") for i in range(200)]
    bare = [(1000 + i, f"{prose} {hexes(rng, 8)}-{hexes(rng, 40)[:23]} {prose}") for i in range(3)]
    split = "".join(rng.choice("0123456789abcdef") for _ in range(21))
    bare += [(2000, f"{prose} {split} {prose}"), (2001, prose * 3), (2002, "w" * 60), (2003, "internationalisations " * 9)]
    found = {r.doc_id: r for r in sg.span_digest(sg.scan(make_docs(docs + bare))).collect()}
    assert found[2000].n_format == 1
    assert found[2001].n_format == found[2002].n_format == found[2003].n_format == 0


def test_automaton_merges_and_scores():
    rng = random.Random(2)
    machine = sg.Automaton([(hexes(rng, 40), 1) for _ in range(400)])
    assert len(machine.states) < 200
    inside = machine.log_likelihood(hexes(rng, 40))
    assert inside is not None and machine.log_likelihood("WITHUPPER") is None


def test_redaction(make_docs):
    docs = make_docs([(1, "a token = \"abcdefgh1\" b"), (2, "plain text"), (3, None), (4, "x " + "a1" * 15 + " y"), (5, "")])
    got = {r.doc_id: (r.text, r.n_chars) for r in sg.redact(docs).collect()}
    assert got == {1: ("a token = \"[SECRET]\" b", 22), 2: ("plain text", 10), 3: (None, None),
                   4: ("x [SECRET] y", 12), 5: ("", 0)}


def test_empty_and_clashing(make_docs, clashing, small_docs):
    assert sg.scan(make_docs([])).count() == 0
    assert (sorted(map(str, sg.span_digest(sg.scan(clashing)).collect()))
            == sorted(map(str, sg.span_digest(sg.scan(small_docs)).collect())))
    assert sg.redact(clashing).columns == clashing.columns
