"""Token ids as files of byte or bit planes.

File format. A dataset is two Parquet tables in one folder; what matters is inside the `payload` of a chunk.

`chunks`: (part, chunk, first_id, n_ids, payload, docs). `payload` holds `n_ids` ids: the block of little-endian
32-bit ids is transposed so that all lowest bytes (or bits) come first, then all second-lowest, and so on; each
plane is compressed by itself with zstandard. The payload starts with one byte for the kind of plane (8 byte
planes of bits are 1, bytes are 0), one for the number of planes, and the compressed length of each plane as a
little-endian 32-bit integer. A plane that is all zero has length 0 and no bytes.
`docs`: the slices of documents in the chunk, in order: (row, doc_id, at, offset, length), `row` the number of the
document in its part, `at` the ids of that document in earlier chunks, `offset` its place here.

`index`: (part, chunk, first_id, n_ids, n_bytes): where each chunk starts in the whole stream.
"""

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.llm.common import fresh_path, id_and_text
from shoplens.llm.words import encoder_factory

BLOCK_IDS = 65536  # ids of a chunk; the last chunk of a part is shorter
END_ID = 0
LEVEL = 3

SLICES = "array<struct<row:long,doc_id:long,at:long,offset:int,length:int>>"


def split_planes(ids, bits=False):
    """One block of ids -> list of planes, lowest first."""
    if bits:
        flags = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1,
                              bitorder="little")
        return [p.tobytes() for p in np.packbits(flags.T, axis=1, bitorder="little")]
    return [p.tobytes() for p in np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T]


def join_planes(planes, count, bits=False):
    if bits:
        flags = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes])
        return np.packbits(flags.T, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")


def pack_block(ids, compressor, bits=False):
    planes = [compressor.compress(p) if any(p) else b"" for p in split_planes(ids, bits)]
    return struct.pack(f"<BB{len(planes)}I", bits, len(planes), *map(len, planes)) + b"".join(planes)


def unpack_block(payload, count, decompressor):
    bits, planes = payload[0], payload[1]
    sizes = struct.unpack_from(f"<{planes}I", payload, 2)
    at, found, empty = 2 + 4 * planes, [], bytes(-(-count // 8) if bits else count)
    for size in sizes:
        found.append(decompressor.decompress(payload[at:at + size]) if size else empty)
        at += size
    return join_planes(found, count, bool(bits))


def write_ids(docs, vocabulary, path, block_ids=BLOCK_IDS, end_id=END_ID, bits=False):
    """Encodes every text, ends each document with `end_id` and writes the ids in ascending order of (id, text).

    Range partitions keep the order, so each task writes one stretch of the stream; the start of a stretch is
    the sum of the stretches before it, known once all are written, and goes to the index. A null or empty text
    is the end id alone, a null id comes first, repeated rows are kept, other columns are ignored.
    """
    encoder = encoder_factory(vocabulary, keeps_spaces=True)

    def encode(batches):
        compressor, get = zstandard.ZstdCompressor(level=LEVEL), encoder()
        part = row = chunk = held = 0
        ids, slices = [], []
        names = ("part", "chunk", "n_ids", "payload", "docs")
        kinds = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("n_ids", pa.int64()),
                           ("payload", pa.binary()), ("docs", pa.list_(pa.struct([
                               ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                               ("offset", pa.int32()), ("length", pa.int32())])))])

        def flush():
            nonlocal ids, slices, held, chunk
            block = pack_block(np.concatenate(ids), compressor, bits)
            record = pa.RecordBatch.from_pydict(
                dict(zip(names, ([part], [chunk], [held], [block], [slices]))), schema=kinds)
            ids, slices, held, chunk = [], [], 0, chunk + 1
            return record

        for batch in batches:
            part = batch["part"][0].as_py() if len(batch) else part
            for doc_id, own in zip(batch["doc_id"].to_pylist(), get.each(batch["text"])):
                own, at = np.append(own, np.uint32(end_id)).astype("<u4"), 0
                while at < len(own):
                    take = min(block_ids - held, len(own) - at)
                    ids.append(own[at:at + take])
                    slices.append({"row": row, "doc_id": doc_id, "at": at, "offset": held, "length": take})
                    at, held = at + take, held + take
                    if held == block_ids:
                        yield flush()
                row += 1
        if held:
            yield flush()

    spark = docs.sparkSession
    ordered = (id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
               .withColumn("part", F.spark_partition_id().cast("long")))
    raw = f"{path}/chunks"
    (ordered.mapInArrow(encode, f"part long, chunk long, n_ids long, payload binary, docs {SLICES}")
     .write.option("compression", "none").parquet(raw))
    chunks = spark.read.parquet(raw)
    # one row per part: as many as there were tasks
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    (chunks.select("part", "chunk", "n_ids", F.octet_length("payload").cast("long").alias("n_bytes"))
     .join(starts, "part")
     .select("part", "chunk", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
             .alias("first_id"), "n_ids", "n_bytes")
     .write.parquet(f"{path}/index"))
    return path


def read_slices(spark, path, with_ids=False):
    """Decodes every chunk by itself: one row per slice of a document, with its place in the whole stream."""
    schema = "part long, row long, doc_id long, at long, start long, length long, crc long"

    def decode(batches):
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for part, first, count, payload, docs in zip(*(batch[c].to_pylist() for c in (
                    "part", "first_id", "n_ids", "payload", "docs"))):
                ids = unpack_block(payload, count, decompressor).tobytes()
                for d in docs:
                    own = ids[4 * d["offset"]:4 * (d["offset"] + d["length"])]
                    out.append((part, d["row"], d["doc_id"], d["at"], first + d["offset"], d["length"],
                                zlib.crc32(own), *([own] if with_ids else [])))
            names = ["part", "row", "doc_id", "at", "start", "length", "crc"] + ["ids"] * with_ids
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                              for n, c in zip(names, columns)], names=names)

    chunks, index = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/index")
    return (chunks.join(index.select("part", "chunk", "first_id"), ["part", "chunk"])
            .select("part", "first_id", "n_ids", "payload", "docs")
            .mapInArrow(decode, schema + (", ids binary" if with_ids else "")))


def _shifted(crc, length):
    """crc32 of the same bytes with `length` zero bytes after them, without the register's fixed offset."""
    def times(matrix, vector):
        total, bit = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[bit]
            vector >>= 1
            bit += 1
        return total

    matrix = [0xEDB88320] + [1 << n for n in range(31)]  # one zero bit
    for _ in range(3):
        matrix = [times(matrix, m) for m in matrix]  # one zero byte
    while length:
        if length & 1:
            crc = times(matrix, crc)
        matrix = [times(matrix, m) for m in matrix]
        length >>= 1
    return crc


def join_crc(pieces):
    """crc32 of joined pieces from [(crc, bytes)], in order."""
    total = 0
    for crc, length in pieces:
        total = _shifted(total, length) ^ crc
    return total


def document_digests(spark, path):
    """Per document, from the files: (doc_id, start, n_tokens, ids_crc32). Long documents span chunks."""
    slices = read_slices(spark, path)
    whole = slices.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("length").alias("n_tokens"),
        F.count("*").alias("pieces"), F.min("crc").alias("crc"),
        F.sort_array(F.collect_list(F.struct("at", "crc", "length"))).alias("list"))

    @F.pandas_udf("long")
    def joined(lists: pd.Series) -> pd.Series:
        return pd.Series([join_crc([(p["crc"], 4 * p["length"]) for p in x]) if x is not None and len(x) else 0
                          for x in lists], dtype="int64")

    return whole.select("doc_id", "start", "n_tokens", F.when(F.col("pieces") == 1, F.col("crc")).otherwise(
        joined(F.when(F.col("pieces") > 1, F.col("list")))).alias("ids_crc32"))


def round_trip(docs, vocabulary, path=None, **options):
    path = path or fresh_path(docs.sparkSession, "token-ids")
    return document_digests(docs.sparkSession, write_ids(docs, vocabulary, path, **options))
