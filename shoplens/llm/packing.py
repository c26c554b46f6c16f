"""Packing of token sequences: first-fit decreasing with a tournament tree, in randomised groups."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, staged
from shoplens.llm.words import encoder_factory

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 2048  # pieces a group has on average; a group is one unit of work of bounded size

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, copy long"


def cut_pieces(docs, vocabulary, capacity=CAPACITY, end_id=END_ID, with_ids=False):
    """Tokenises every text and cuts it after each `capacity` ids: one row per piece.

    A null or empty text is the end id alone. Repeated rows are pieces of their own; other columns are ignored. `copy`
    numbers equal rows of a batch, so that they can be dealt to different groups. `with_ids` adds the ids as little-endian 32-bit integers.
    """
    encoder = encoder_factory(vocabulary, keeps_spaces=False)
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches):
        encode, end = encoder(), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy", "ids")}
            rows = {}
            for doc_id, own in zip(batch["doc_id"].to_pylist(), encode.each(batch["text"])):
                ids = own.tobytes() + end
                total = len(ids) // 4
                copy = None
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    crc = zlib.crc32(part)
                    if copy is None:  # rows that begin alike count as equal here, which is enough
                        row = doc_id, total, crc
                        copy = rows[row] = rows.get(row, -1) + 1
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(crc)
                    out["doc_tokens"].append(total)
                    out["copy"].append(copy)
                    if with_ids:
                        out["ids"].append(part)
            if not with_ids:
                del out["ids"]
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in out]))

    return id_and_text(docs).mapInArrow(cut, schema)


class FirstFit:
    """Tournament tree over the free room of bins: each inner node holds the larger room below it.

    Going down to the left whenever the left half has room finds the first bin that fits in log(bins) steps.
    """

    def __init__(self, bins, capacity):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length):
        """(bin, room that was used there before)."""
        room, node, leaves = self.room, 1, self.leaves
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        left = room[node]
        room[node] = left - length
        bin_, node = node - leaves, node // 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
        return bin_, left


def pack(pieces, capacity=CAPACITY, group_pieces=GROUP_PIECES, seed=0):
    """Adds `sequence_id` and `offset` to rows (doc_id, start, length, ...), lengths from 1 to `capacity`.

    Pieces are dealt to groups by a hash of their id, start, content and number among equal rows, so a group is a random
    sample of all lengths, and long documents, null ids and repeated rows spread over many groups; the number of groups follows the number of pieces, so a group
    fits a task at any size. Each group is packed on its own, longest first. Ties in length go by id and start.
    `pieces` is read twice (its rows are counted): pass a written table.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    names = [c for c in ("doc_id", "start", "length", "ids_crc32", "copy") if c in pieces.columns]
    kept = pieces.drop("copy")
    schema = kept.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", sequence_id long, offset long"

    def first_fit_decreasing(key, part):
        order = pc.sort_indices(part, [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")],
                                null_placement="at_start")
        part = part.take(order).drop_columns("pack_group")
        tree = FirstFit(len(part), capacity)
        places = [tree.place(n) for n in part["length"].to_pylist()]
        group = key[0].as_py()
        return (part.append_column("sequence_id", pa.array([b * groups + group for b, _ in places], pa.int64()))
                .append_column("offset", pa.array([capacity - left for _, left in places], pa.int64())))

    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64(*names, F.lit(seed)), F.lit(groups))).drop("copy")
    return dealt.groupBy("pack_group").applyInArrow(first_fit_decreasing, schema)


def sequences(packed, capacity=CAPACITY, pad_id=0):
    """The padded training rows of a packing that carries `ids`: (sequence_id, used, ids of exactly `capacity`)."""
    def fill(key, part):
        row = np.full(capacity, pad_id, "<u4")
        for offset, ids in zip(part["offset"], part["ids"]):
            piece = np.frombuffer(ids, "<u4")
            row[offset:offset + len(piece)] = piece
        return pd.DataFrame({"sequence_id": [key[0]], "used": [int(part["length"].sum())], "ids": [row.tobytes()]})

    return packed.select("sequence_id", "offset", "length", "ids").groupBy("sequence_id").applyInPandas(
        fill, "sequence_id long, used long, ids binary")


def pack_documents(docs, vocabulary, capacity=CAPACITY, with_ids=False):
    """Documents to placed pieces. The pieces (without ids: a few numbers a row) are written once."""
    return pack(staged(cut_pieces(docs, vocabulary, capacity, with_ids=with_ids), "pieces"), capacity)
