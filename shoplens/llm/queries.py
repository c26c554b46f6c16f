"""The registered queries of this subpackage and their SQL twins (where SQL can express them)."""

import public_tokenizers
from pyspark.sql import functions as F

from shoplens.llm import (bitplanes, dimension_scan, fuzzy_lines, lexical_treap, mixing, order_minhash, packing, pieces,
                          repair, secret_grammar, simhash, string_kernel, suffix_dedup)
from shoplens.llm.common import read_table

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return register


@query("op1_packing")
def op1(spark, sf_dir):
    """Packs all documents into sequences of at most 2048 ids."""
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    """Removes from all documents what stands at two places, strings of 200 bytes and more."""
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


@query("op3_simhash")
def op3(spark, sf_dir):
    """Fingerprints of all documents, of their edited texts, and the searched neighbours of every 20th."""
    return simhash.edit_report(read_table(spark, sf_dir, "documents"))


@query("op4_order_minhash")
def op4(spark, sf_dir):
    """The class of near copies of each document."""
    return order_minhash.classes(read_table(spark, sf_dir, "documents"))


@query("op5_sentence_pieces")
def op5(spark, sf_dir):
    """Encodes all documents with the 32,000-piece vocabulary and decodes them again."""
    return pieces.encode_texts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                               with_ids=False)


@query("op6_secret_grammar")
def op6(spark, sf_dir):
    """Secrets in all documents: fixed patterns and learnt formats."""
    return secret_grammar.span_digest(secret_grammar.scan(read_table(spark, sf_dir, "documents")))


@query("op7_dimension_scan")
def op7(spark, sf_dir):
    """The five nearest vectors of every 50th vector."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return dimension_scan.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op8_fuzzy_lines")
def op8(spark, sf_dir):
    """The lines of each document that repeat an alike line of the corpus."""
    return fuzzy_lines.line_report(read_table(spark, sf_dir, "documents"))


@query("op9_token_planes")
def op9(spark, sf_dir):
    """Writes all documents' ids as byte planes and reads the files back."""
    return bitplanes.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_string_kernel")
def op10(spark, sf_dir):
    """Toxicity of all documents."""
    return string_kernel.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op12_hash_mixing", mixing.ORACLE)
def op12(spark, sf_dir):
    """How many words of each document a mix by target weights takes."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source", "hash")


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    """Faults and cheapest repair of all conversations after damage."""
    return repair.audits(repair.damaged(read_table(spark, sf_dir, "conversations")))


@query("op11_k2_treap", lexical_treap.ORACLE)
def op11(spark, sf_dir):
    """The 20 best documents of each benchmark item."""
    return lexical_treap.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
