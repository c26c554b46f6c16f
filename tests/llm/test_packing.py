import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shoplens.llm import packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


tokenizer = Tokenizer.from_file(VOCABULARY)


def expected_ids(text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(docs, capacity=2048):
    """Every id of every row in exactly one piece, pieces gapless in their sequence."""
    placed = packing.pack_documents(docs, VOCABULARY, capacity).collect()
    source = [(r.doc_id, expected_ids(r.text)) for r in docs.collect()]
    want = sorted((str(i), s, len(ids[s:s + capacity]),
                   zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()), len(ids))
                  for i, ids in source for s in range(0, len(ids), capacity))
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in placed) == want
    bins = defaultdict(list)
    for r in placed:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return placed, bins


def test_every_id_once(small_docs):
    placed, bins = check(small_docs)
    used = sum(r.length for r in placed)
    assert used / (2048 * len(bins)) > 0.93  # 200 documents; larger groups waste less


def test_odd_documents(odd_docs):
    check(odd_docs)
    check(odd_docs, capacity=64)


def test_empty_table_and_clashing_columns(make_docs, clashing, small_docs):
    assert packing.pack_documents(make_docs([]), VOCABULARY).count() == 0
    assert (sorted(map(tuple, packing.pack_documents(clashing, VOCABULARY).collect()))
            == sorted(map(tuple, packing.pack_documents(small_docs, VOCABULARY).collect())))


def test_null_ids_and_equal_rows_spread_over_groups(spark):
    from pyspark.sql import functions as F
    docs = spark.range(40_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    pieces = packing.staged(packing.cut_pieces(docs, VOCABULARY), "pieces")
    placed = packing.pack(pieces, group_pieces=500)
    groups = placed.groupBy((F.col("sequence_id") % 80).alias("g")).count().collect()
    assert len(groups) == 80 and max(r["count"] for r in groups) < 1500
    assert placed.count() == 40_000 and "copy" not in placed.columns


def test_real_sequences(make_docs):
    docs = make_docs([(i, "some words to pack " * (i + 1)) for i in range(40)])
    rows = packing.sequences(packing.pack_documents(docs, VOCABULARY, 128, with_ids=True), 128).collect()
    held = sorted(np.concatenate([np.frombuffer(r.ids, "<u4")[:r.used] for r in rows]).tolist())
    assert held == sorted(i for r in docs.collect() for i in expected_ids(r.text))
    assert all(len(r.ids) == 4 * 128 for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_tree_is_plain_first_fit(lengths):
    lengths, room, tree = sorted(lengths, reverse=True), [], packing.FirstFit(max(1, len(lengths)), 50)
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(50)
        assert tree.place(n) == (at, room[at])
        room[at] -= n
