import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shoplens.llm import bitplanes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def want(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*TOKENIZER.encode(text, add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("block", [64, 65536])
def test_round_trip(small_docs, odd_docs, bits, block):
    for docs in (small_docs, odd_docs):
        found = bitplanes.round_trip(docs, VOCABULARY, block_ids=block, bits=bits).collect()
        assert sorted(map(tuple, found), key=str) == want(docs)


def test_real_ids_come_back(small_docs, tmp_path):
    path = bitplanes.write_ids(small_docs, VOCABULARY, str(tmp_path / "ids"), block_ids=1000)
    spark = small_docs.sparkSession
    slices = sorted(bitplanes.read_slices(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in slices])
    texts = small_docs.orderBy("doc_id").collect()
    assert stream.tolist() == [i for r in texts for i in [*TOKENIZER.encode(r.text, add_special_tokens=False).ids, 0]]
    index = spark.read.parquet(f"{path}/index").orderBy("first_id").collect()
    assert [r.first_id for r in index] == np.r_[0, np.cumsum([r.n_ids for r in index])[:-1]].tolist()


def test_empty_and_clashing(make_docs, clashing, small_docs):
    assert bitplanes.round_trip(make_docs([]), VOCABULARY).count() == 0
    assert sorted(map(tuple, bitplanes.round_trip(clashing, VOCABULARY).collect()), key=str) == want(small_docs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50), st.booleans())
def test_planes(ids, bits):
    block = bitplanes.pack_block(np.array(ids, "<u4"), zstandard.ZstdCompressor(), bits)
    assert bitplanes.unpack_block(block, len(ids), zstandard.ZstdDecompressor()).tolist() == ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=6))
def test_joined_crc(parts):
    assert bitplanes.join_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))
