"""Removal of byte strings that occur more than once in the corpus, by suffix sorting.

Every window of WINDOW bytes is assigned to the smallest hash of the GRAM-byte strings inside it. Equal windows
have equal such keys, so windows of different keys need never be compared: a run of neighbouring windows of one
key is a segment, and all segments of a key go to one shard. Keys of one segment need no shard at all, and equal
segments of a key travel once, with their number. Each shard is suffix-sorted by external induced sorting
(`induced_sort`): windows that occur again are neighbours in the order, equal in WINDOW bytes. A key with more
than CROWDED different segments would make a shard of any size; its windows are keyed one level finer, by all of
their bytes, and counted by an aggregation.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, staged
from shoplens.llm.induced_sort import suffix_array

WINDOW, GRAM = 200, 100
CROWDED = 2000
SHARD_BYTES = 4_000_000  # bytes of a shard on average
STRETCH = 1_000_000  # bytes that are hashed at once

_FACTOR = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {}


def _powers(count):
    """factor^i and factor^-i modulo 2^64."""
    if _POWERS.get("count", 0) < count:
        up = np.full(count, _FACTOR, np.uint64)
        down = np.full(count, pow(_FACTOR, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(count=count, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _POWERS["up"], _POWERS["down"]


def mixed(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all strings of one stretch of bytes, from sums over its beginning."""

    def __init__(self, data):
        self.up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.up[:len(data)], out=self.sums[1:])

    def of(self, starts, ends):
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def sliding_minimum(values, width):
    """Smallest value of each `width` neighbours, by running minima from both ends of blocks of that width."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:count], forward[width - 1:width - 1 + count])


def segments(texts):
    """Segments of several byte strings: (text number, key, hash, start, length, again).

    `again`: the key's string stands more than once in the text, so windows may repeat inside the segment.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < WINDOW:
        return [np.empty(0, np.int64)] * 6
    hashes = Hashes(data)
    grams = np.arange(len(data) - GRAM + 1)
    values = hashes.of(grams, grams + GRAM)
    keys = sliding_minimum(values, WINDOW - GRAM + 1)
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(texts)), lengths)[:len(keys)]
    whole = np.arange(len(keys)) + WINDOW <= (begin + lengths)[owner]  # windows inside one text
    new = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]
    starts = np.flatnonzero(new & whole)
    stops = np.flatnonzero(whole & np.r_[(new[1:] | ~whole[1:]), True])
    found = keys[starts]
    low = np.flatnonzero(values <= found.max()) if len(found) else np.empty(0, np.int64)
    ranked = np.sort(values[low])
    double = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    again = np.isin(found, double)
    return (owner[starts], found.view(np.int64), hashes.of(starts, stops + WINDOW).view(np.int64),
            starts - begin[owner[starts]], stops - starts + WINDOW, again)


def _stretches(texts):
    """Groups of texts of about STRETCH bytes; longer texts are cut with an overlap: lists of (number, offset, bytes)."""
    held, size = [], 0
    for number, text in enumerate(texts):
        raw = text.encode()
        for offset in range(0, max(1, len(raw) - WINDOW + 1), STRETCH):
            part = raw[offset:offset + STRETCH + WINDOW - 1]
            held.append((number, offset, part))
            size += len(part)
            if size >= STRETCH:
                yield held
                held, size = [], 0
    if held:
        yield held


def _anchored(rows):
    """All segments of all texts: (key, seg, doc, at, len, again)."""
    names = ("key", "seg", "doc", "at", "len", "again")

    def run(batches):
        for batch in batches:
            docs = batch["doc"].to_numpy(zero_copy_only=False)
            for held in _stretches(t.as_py() for t in batch["text"]):
                number, key, seg, at, length, again = segments([raw for _, _, raw in held])
                rows = np.array([n for n, _, _ in held])[number] if len(number) else number
                offset = np.array([o for _, o, _ in held])[number] if len(number) else number
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(seg), pa.array(docs[rows] if len(rows) else np.empty(0, np.int64)),
                     pa.array((at + offset).astype(np.int64)), pa.array(length.astype(np.int32)),
                     pa.array(again.astype(bool))], names)

    return rows.select("doc", "text").mapInArrow(run, "key long, seg long, doc long, at long, len int, again boolean")


def repeated_windows(parts):
    """parts: [(bytes, number of its copies)]. For each part the starts of windows that occur more than once."""
    lengths = np.array([len(p) for p, _ in parts])
    symbols = np.empty(lengths.sum() + len(parts) + 1, np.int64)
    at, begins = 0, []
    for part, _ in parts:
        begins.append(at)
        symbols[at:at + len(part)] = np.frombuffer(part, np.uint8)
        at += len(part) + 1
    begins = np.array(begins)
    symbols += 2
    symbols[begins + lengths] = 1
    symbols[-1] = 0
    order = suffix_array(symbols, 258)
    valid = np.zeros(len(symbols), bool)
    owner = np.repeat(np.arange(len(parts)), lengths + 1)
    place = np.arange(len(owner))
    valid[:len(owner)] = place + WINDOW <= (begins + lengths)[owner]
    order = order[valid[order]]
    if not len(order):
        return [np.empty(0, np.int64) for _ in parts]
    windows = np.lib.stride_tricks.sliding_window_view((symbols - 2).astype(np.uint8), WINDOW)
    equal = np.zeros(len(order), bool)
    for a in range(1, len(order), 50_000):
        b = min(a + 50_000, len(order))
        equal[a:b] = (windows[order[a:b]] == windows[order[a - 1:b - 1]]).all(axis=1)
    group = np.cumsum(~equal) - 1
    copies = np.array([n for _, n in parts])[owner[order]]
    often = np.bincount(group, copies)[group] > 1
    hits = np.sort(order[often])
    of = owner[hits]
    cut = np.searchsorted(of, np.arange(len(parts) + 1))
    return [hits[cut[i]:cut[i + 1]] - begins[i] for i in range(len(parts))]


def runs(starts):
    """Neighbouring numbers as [(first, last)]."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.r_[0, gap + 1]].tolist(), starts[np.r_[gap, len(starts) - 1]].tolist()))


RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _sorted_shard(table):
    """One shard: rows (key, seg, n, part) -> (key, seg, ranges of window starts that occur again)."""
    found = repeated_windows(list(zip((p.as_py() for p in table["part"]), table["n"].to_pylist())))
    return pa.table([table["key"], table["seg"],
                     pa.array([[{"a": a, "b": b} for a, b in runs(x)] for x in found], RANGES)],
                    ["key", "seg", "ranges"])


def _cut(rows, places):
    """The bytes of the listed segments: places has (doc, list of (key, seg, n, at, len))."""
    def run(batches):
        for batch in batches:
            out = []
            for text, wanted in zip(batch["text"], batch["list"]):
                raw = text.as_py().encode()
                out += [(w["key"], w["seg"], w["n"], raw[w["at"]:w["at"] + w["len"]]) for w in wanted.as_py()]
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.binary())], ["key", "seg", "n", "part"])

    listed = places.groupBy("doc").agg(F.collect_list(F.struct("key", "seg", "n", "at", "len")).alias("list"))
    # repeated rows give a part again, which is dropped with its key
    return rows.join(listed, "doc").select("text", "list").mapInArrow(run, "key long, seg long, n long, part binary")


def _by_whole_windows(parts):
    """(key, seg, ranges) of segments of crowded keys: their windows counted by the hash of all their bytes."""
    def run(batches):
        for batch in batches:
            for key, seg, n, part in zip(*(batch[c] for c in ("key", "seg", "n", "part"))):
                data = np.frombuffer(part.as_py(), np.uint8)
                starts = np.arange(len(data) - WINDOW + 1)
                size = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, key.as_py())), pa.array(np.full(size, seg.as_py())),
                     pa.array(np.full(size, n.as_py())), pa.array(starts),
                     pa.array(Hashes(data).of(starts, starts + WINDOW).view(np.int64))],
                    ["key", "seg", "n", "at", "hash"])

    windows = parts.mapInArrow(run, "key long, seg long, n long, at long, hash long")
    often = windows.groupBy("key", "hash").agg(F.sum("n").alias("times")).where(F.col("times") > 1).select("key", "hash")
    return windows.join(often, ["key", "hash"]).groupBy("key", "seg").agg(
        F.transform(F.array_distinct(F.collect_list("at")), lambda x: F.struct(x.alias("a"), x.alias("b"))).alias("ranges"))


def repeated_ranges(rows):
    """(doc, first, last): window starts of each text that occur again anywhere. `rows`: (doc, text), doc a hash."""
    found = _anchored(rows)
    keys = found.groupBy("key").agg(F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high"),
                                    F.max("again").alias("again")).where((F.col("n") > 1) | F.col("again"))
    keys = keys.select("key", ((F.col("low") != F.col("high")) | F.col("again")).alias("differ"))
    shared = staged(found.join(keys, "key").select("key", "seg", "doc", "at", "len", "differ"), "segments")
    alike = shared.where(~F.col("differ")).select("doc", F.col("at").alias("first"),
                                                  (F.col("at") + F.col("len") - WINDOW).alias("last"))
    place = F.xxhash64("doc", "at")
    kinds = shared.where("differ").groupBy("key", "seg").agg(
        F.count("*").alias("n"), F.max_by("doc", place).alias("doc"), F.max_by("at", place).alias("at"),
        F.max("len").alias("len"))
    kinds = staged(kinds, "kinds")
    parts = staged(_cut(rows, kinds).dropDuplicates(["key", "seg"]), "parts")
    sizes = parts.groupBy("key").agg(F.count("*").alias("different"))
    shards = max(1, -(-(parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0) // SHARD_BYTES))
    sized = parts.join(sizes, "key")
    sorted_ = (sized.where(F.col("different") <= CROWDED)
               .select("key", "seg", "n", "part", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
               .groupBy("shard").applyInArrow(_sorted_shard, "key long, seg long, ranges array<struct<a:long,b:long>>"))
    crowded = _by_whole_windows(sized.where(F.col("different") > CROWDED).select("key", "seg", "n", "part"))
    hits = staged(sorted_.unionByName(crowded).where(F.size("ranges") > 0), "hits")
    mixed_ranges = (shared.where("differ").join(hits, ["key", "seg"]).select("doc", "at", F.explode("ranges").alias("r"))
                    .select("doc", (F.col("at") + F.col("r.a")).alias("first"), (F.col("at") + F.col("r.b")).alias("last")))
    return alike.unionByName(mixed_ranges)


def _covered(ranges):
    """[(first, last)] window starts -> ascending maximal runs of bytes [(start, end)]."""
    out = []
    for first, last in sorted(ranges):
        end = last + WINDOW
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def remove_repeats(docs):
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary).

    Texts are UTF-8 bytes, null texts empty. Each byte covered by a WINDOW-byte string that also starts anywhere
    else in the table goes, in all places where it stands; strings never cross documents and are judged on the
    input. Repeated rows are places of their own, so all they hold (from WINDOW bytes on) goes. Texts of fewer
    than WINDOW bytes stay whole. Null ids stay null, other columns are ignored.
    """
    rows = id_and_text(docs).withColumn("doc", F.xxhash64("doc_id", "text"))
    ranges = repeated_ranges(rows.select("doc", "text")).groupBy("doc").agg(
        F.collect_set(F.struct("first", "last")).alias("ranges"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch["doc_id"].to_pylist(), batch["text"], batch["ranges"]):
                raw, kept, at, gone = text.as_py().encode(), [], 0, 0
                spans = _covered([(r["first"], r["last"]) for r in found.as_py() or ()])
                for start, end in spans:
                    kept.append(raw[at:start])
                    gone, at = gone + end - start, end
                kept = b"".join([*kept, raw[at:]])
                out.append((doc_id, len(raw), gone, len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.join(ranges, "doc", "left").select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
