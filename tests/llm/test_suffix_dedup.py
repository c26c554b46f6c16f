import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import suffix_dedup
from shoplens.llm.induced_sort import suffix_array

SIZE = suffix_dedup.WINDOW


def brute(texts):
    """Per text: (bytes, removed, spans, hash of the rest), from a count of all windows."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i:i + SIZE] for r in raws for i in range(len(r) - SIZE + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - SIZE + 1):
            if counts[r[i:i + SIZE]] > 1:
                gone[i:i + SIZE] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs):
    rows = docs.collect()
    want = sorted(str((r.doc_id, *b)) for r, b in zip(rows, brute([r.text for r in rows])))
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == want


def words(rng, count):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(count))


def test_planted_repeats(make_docs, monkeypatch):
    rng = random.Random(3)
    shared, line = words(rng, 60), words(rng, 30)
    pairs = [(i, words(rng, rng.randrange(5, 90)) + (shared if i % 3 == 0 else "") + words(rng, 40)
              + (line if i % 2 else "")) for i in range(60)]
    pairs += [(70, pairs[5][1]), (71, pairs[6][1][:-1] + "!"), (72, "ab" * 700), (73, "a" * 199), (74, "a" * 199),
              (75, "c" * 201), (76, None), (77, ""), (None, shared), (78, shared + "x" + shared), (5, pairs[5][1])]
    check(make_docs(pairs))
    monkeypatch.setattr(suffix_dedup, "CROWDED", 3)  # crowded keys are counted by whole windows
    check(make_docs(pairs))
    monkeypatch.setattr(suffix_dedup, "STRETCH", 500)  # long texts are hashed in overlapping stretches
    check(make_docs(pairs))


def test_whole_table(small_docs):
    check(small_docs)


def test_empty_and_clashing(make_docs, clashing, small_docs):
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0
    assert (sorted(map(tuple, suffix_dedup.remove_repeats(clashing).collect()))
            == sorted(map(tuple, suffix_dedup.remove_repeats(small_docs).collect())))


@pytest.mark.parametrize("held", [4, 1 << 22])
def test_order_of_suffixes(held):
    rng = random.Random(5)
    for _ in range(200):
        size = rng.choice([1, 2, 3, 26, 700])
        text = [rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 150))] + [0]
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(np.array(text, np.int64), size + 1, held).tolist() == want
