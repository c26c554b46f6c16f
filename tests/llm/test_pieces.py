import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = pieces.PieceCodec(MODEL, memory=500)


def plain_viterbi(scores, ids, longest, unknown, text):
    """The whole lattice at once; ties go to the longer last piece."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            score = scores.get(text[start:end], unknown if start == end - 1 else None)
            if score is not None:
                options.append((best[start] + score, -start))
        top = max(options)
        best.append(top[0])
        back.append(-top[1])
    path, at = [], len(text)
    while at:
        path.append(text[back[at]:at])
        at = back[at]
    return [i for p in reversed(path) for i in ids(p)]


def check(text):
    v = CODEC.viterbi
    want = plain_viterbi(v.scores, v.ids, v.longest, v.unknown, CODEC.model.normalize(text)) if text else []
    assert CODEC.encode(text).tolist() == want
    return want


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    check(text)


def test_documents_and_round_trip(small_docs):
    for row in small_docs.limit(25).collect():
        check(row.text[:3000])
    report = pieces.encode_texts(small_docs, MODEL).collect()
    assert all(r.decoded_equal for r in report) and len(report) == small_docs.count()
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.n_tokens == len(r.ids) // 4 for r in report)
    decoded = {r.doc_id: r.text for r in pieces.decode_ids(pieces.encode_texts(small_docs, MODEL), MODEL).collect()}
    assert decoded == {r.doc_id: r.text for r in small_docs.collect()}


def test_window_stays_small_and_splits_do_not_matter():
    rng = random.Random(4)
    scores = {c: -2.0 for c in "ab"} | {"ab": -3.0, "ba": -3.5, "aab": -4.0, "bbb": -4.5}
    for _ in range(100):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 400)))
        stream = pieces.StreamingViterbi(scores, lambda p: [p], 3, -9.0)
        at = 0
        while at < len(text):
            step = rng.randrange(1, 50)
            stream.feed(text[at:at + step])
            at += step
            assert len(stream.best) < 120
        assert stream.close() == plain_viterbi(scores, lambda p: [p], 3, -9.0, text)


def test_odd_empty_clashing(odd_docs, make_docs, clashing, small_docs):
    report = pieces.encode_texts(odd_docs, MODEL).collect()
    texts = sorted((r.text or "") for r in odd_docs.collect())
    assert sorted(r.n_tokens for r in report) == sorted(len(CODEC.model.encode(t)) for t in texts)
    assert pieces.encode_texts(make_docs([]), MODEL).count() == 0
    assert pieces.encode_texts(clashing, MODEL, with_ids=False).count() == small_docs.count()
    assert np.array_equal(CODEC.encode(""), [])
