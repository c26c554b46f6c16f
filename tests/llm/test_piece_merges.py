import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = pieces.codec_of(MODEL)
TEXTS = ["the government of the people", "Die Regierung beschloss gestern ein neues Gesetz.", "word " * 500, "x" * 6000,
         "ab" * 3000, "日本語 の テキスト 🙂 é é", "  two   marks  ", "\u2581 mark", "<s> <unk> <0x41>", "a\tb\nc", "ﬁ①"]


def test_ids_are_those_of_the_models_encoder(small_docs, odd_docs, make_docs):
    texts = TEXTS + [r.text for r in small_docs.collect()] + [r.text or "" for r in odd_docs.collect()]
    for text in texts:
        assert CODEC.encode(text).tolist() == CODEC.model.encode(text)
    for r in pieces.encode_texts(small_docs, MODEL).join(small_docs, "doc_id").collect():
        assert list(memoryview(r.ids).cast("I")) == CODEC.model.encode(r.text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("aenrst i", max_size=60))
def test_any_text(text):
    assert CODEC.encode(text).tolist() == CODEC.model.encode(text)


def test_parts_of_a_stream_do_not_matter():
    for text in TEXTS:
        whole = CODEC.model.normalize(text)
        stream = pieces.StreamingPairs(CODEC.viterbi.scores, CODEC._ids, CODEC.viterbi.longest)
        for i in range(0, len(whole), 7):
            stream.feed(whole[i:i + 7])
        assert stream.close() == CODEC.encode(text).tolist()


def test_a_long_run_stays_within_the_window():
    import random
    rng = random.Random(2)
    run = "".join(rng.choice("aenrst") for _ in range(100_000)) + "x" * 300_000
    stream = pieces.StreamingPairs(CODEC.viterbi.scores, CODEC._ids, CODEC.viterbi.longest)
    whole = CODEC.model.normalize(run)
    for i in range(0, len(whole), 100):
        stream.feed(whole[i:i + 100])
        assert len(stream.back) <= 3 * stream.longest + 100 and len(stream.buffer) <= 3 * stream.longest + 100
    assert stream.close() == CODEC.model.encode(run)
    assert CODEC.encode(run).tolist() == CODEC.model.encode(run)


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces.StreamingPairs, "MEMORY", 50)
    small = pieces.MergeCodec(MODEL, memory=20)
    for text in TEXTS:
        assert small.encode(text).tolist() == CODEC.model.encode(text)


def test_the_model_names_its_type(tmp_path):
    assert pieces.model_type(MODEL) == pieces.BPE and isinstance(CODEC, pieces.MergeCodec)
    (tmp_path / "plain").write_bytes(b"\x12\x02\x18\x01")
    (tmp_path / "unset").write_bytes(b"\x0a\x00")
    assert pieces.model_type(tmp_path / "plain") == pieces.UNIGRAM == pieces.model_type(tmp_path / "unset")
