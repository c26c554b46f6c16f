import hashlib

from pyspark.sql import functions as F

from shoplens.llm import simhash


def expected(rows):
    """(id, n_chars, edited_sha256) in plain Python, rows in the operator's order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_fingerprint(spark, text):
    """Votes bit by bit, with the term hashes of Spark."""
    import re
    words = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w]
    pairs = list(zip(words, words[1:])) or [(w, None) for w in words]
    if not pairs:
        return 0
    hashed = spark.createDataFrame(pairs, "x string, y string").select("x", "y", F.xxhash64("x", "y").alias("h")).collect()
    votes = [0] * 64
    for r in hashed:
        weight = len(r.x) + len(r.y or "")
        for b in range(64):
            votes[b] += weight if (r.h >> b) & 1 else -weight
    return sum(1 << b for b in range(64) if votes[b] > 0)


def check_edits(docs):
    found = simhash.edit_report(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == expected(
        [(r.doc_id, r.text) for r in docs.collect()])
    return found


def test_edits_and_fingerprints(spark, small_docs, odd_docs):
    check_edits(small_docs)
    found = check_edits(odd_docs)
    by_text = {}
    for r in odd_docs.collect():
        by_text.setdefault(r.doc_id, r.text)
    for r in found:
        text = by_text[r.doc_id] or ""
        if text.isascii() and len(text) < 300:
            assert int(r.fingerprint, 16) == plain_fingerprint(spark, text), text
    same = {r.doc_id: r.fingerprint for r in found}
    assert same[9] == same[10] and same[1] == same[2]


def test_copies_are_near_and_strangers_are_not(make_docs, small_docs):
    texts = [r.text for r in small_docs.orderBy("doc_id").collect() if r.text and len(r.text) > 1500][:30]
    found = simhash.edit_report(make_docs([(2 * i + j, t) for i, t in enumerate(texts) for j in (0, 1)])).collect()
    copies = [r.near_next for r in found if r.doc_id % 2 == 0]
    assert set(copies) == {1.0}
    edits = [r.near_edited for r in found if r.doc_id % 2]
    strangers = [r.near_next for r in found if r.doc_id % 2]
    assert sum(edits) / len(edits) > sum(strangers) / len(strangers) + 0.05


def test_block_tables_find_every_pair(spark):
    import random
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:40]:
        for flips in (1, 2, 3, 3, 4, 5):
            g = f
            for b in rng.sample(range(64), flips):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r.fp, r.other) for r in simhash.near(table, table).collect()}
    want = {(a, b) for a in signed for b in signed if a != b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    assert got == want and want


def test_empty_and_clashing(make_docs, clashing, small_docs):
    assert simhash.edit_report(make_docs([])).count() == 0
    assert (sorted(map(str, simhash.edit_report(clashing).collect()))
            == sorted(map(str, simhash.edit_report(small_docs).collect())))
