"""Nearest neighbours by cosine: inverted lists, scanned by blocks of rotated columns with early abandoning.

Unit vectors are rotated by a random orthogonal matrix, so any d of the D columns estimate the whole squared
distance: partial * D / d. A candidate is abandoned after a column block when that estimate exceeds the distance
to beat by more than the bound (1 + EPSILON / sqrt(d)), a test whose error falls off as exp(-c EPSILON^2).
Survivors get their exact cosine on the original vectors.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.llm.common import hash_share, staged

K = 5
SAMPLE = 20_000  # vectors that centroids, probe count and first distances to beat are fitted on
TARGET = 0.985  # share of true neighbours that the probed lists of sample queries hold
COLUMNS = 8  # columns of a block
EPSILON = 2.1
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024  # rows and queries that meet in one task at most, about
CALIBRATION = 256  # sample vectors that serve as queries to set the probe count


def usable(vectors, id_col, vector_col):
    """(vec_id, v array<double>) without vectors that are null, empty, zero or hold a null or non-finite number."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0)))


def matrix(column, width):
    return np.array([np.asarray(x, dtype=np.float64) for x in column], dtype=np.float64).reshape(-1, width)


def unit(v):
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # squares of huge or tiny numbers stay finite
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(rows, one):
    """Cosine of each row with one vector, in double precision on the vectors as given."""
    scale, own = np.abs(rows).max(axis=1, keepdims=True), np.abs(one).max()
    a, b = rows / scale, one / own
    if 1e-100 < own < 1e100 and (scale > 1e-100).all() and (scale < 1e100).all():
        a, b = rows, one
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum()))


class Index:
    """What is fitted on the sample: rotation, centroids, probe count."""

    def __init__(self, sample, sample_ids, total, k, seed=0):
        self.original, self.ids = sample, sample_ids
        rng = np.random.default_rng(seed)
        self.width = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((self.width, self.width)))[0]
        self.k, self.sample = k, unit(sample)
        lists = int(max(1, min(np.sqrt(total), len(sample) // 20)))
        centres = self.sample[rng.choice(len(sample), lists, replace=False)]
        for _ in range(8):
            nearest = np.argmax(self.sample @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, self.sample)
            filled = np.abs(sums).max(axis=1) > 1e-12
            centres[filled] = unit(sums[filled])
        self.centres = centres
        self.probes = self._calibrate()

    def lists_of(self, units):
        return np.argmax(units @ self.centres.T, axis=1)

    def _calibrate(self):
        """The fewest probes whose lists hold TARGET of the true neighbours of CALIBRATION sample vectors."""
        queries = self.sample[:CALIBRATION]
        near = queries @ self.sample.T
        near[np.arange(len(queries)), np.arange(len(queries))] = -9
        best = np.argsort(-near, axis=1)[:, :self.k]
        order = np.argsort(-(queries @ self.centres.T), axis=1)
        rank = np.argsort(order, axis=1)
        needed = np.take_along_axis(rank, self.lists_of(self.sample)[best], axis=1).ravel()
        return int(np.quantile(needed, TARGET, method="higher")) + 1

    def seeds(self, query_id, one):
        """The k nearest sample vectors: (places, squared distance of the k-th; no farther row is a result)."""
        near = self.sample @ unit(one[None])[0]
        near[self.ids == query_id] = -9
        best = np.argsort(-near, kind="stable")[:self.k + 1]
        best = best[near[best] > -2][:self.k]
        return best, 2 - 2 * near[best[-1]] if len(best) == self.k else 9.0


def scan_block(rotated, start, query, to_beat, k):
    """Places of the candidates that may be among the k nearest, by column blocks with early abandoning."""
    width, alive = rotated.shape[1], np.arange(start, len(rotated))
    partial = np.zeros(len(alive))
    for at in range(0, width, COLUMNS):
        step = rotated[alive, at:at + COLUMNS] - query[at:at + COLUMNS]
        partial += (step * step).sum(axis=1)
        seen = min(at + COLUMNS, width)
        bound = to_beat * (1 + EPSILON / np.sqrt(seen)) ** 2 * seen / width if seen < width else to_beat
        keep = partial <= bound + 1e-9
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return alive, partial


def search(vectors, queries, id_col="vec_id", vector_col="embedding", k=K):
    """The k nearest vectors of each query row (both with id and vector columns), the query's own id left out.

    Gives (query_id, rank, vec_id, score): nearest first, ties to the smaller id, score the cosine in double
    precision on the vectors as given; all candidates where there are fewer than k. Vectors that are null, empty,
    zero or hold null or non-finite numbers, and those of another length than most, take no part. Rows are all
    indexed; only rotation, centroids, probe count and first results come from a sample of about SAMPLE rows, those
    with the smallest hash of their id. Lists and the queries that probe them are cut into blocks, so a list that
    holds a third of all rows is spread over many tasks. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).where(F.col("vec_id").isNotNull())
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], schema)
    width, total = widths[0]["w"], widths[0]["count"]
    rows = rows.where(F.size("v") == width)
    sample = (rows.where(hash_share(SAMPLE / total, "vec_id")).limit(2 * SAMPLE).toPandas()
              .sort_values("vec_id", kind="stable").iloc[:SAMPLE])
    index = Index(matrix(sample["v"], width), sample["vec_id"].to_numpy(), total, k)
    shared = spark.sparkContext.broadcast(index)  # at most SAMPLE vectors

    def assign(batches):
        own = shared.value
        for batch in batches:
            lists = own.lists_of(unit(matrix(batch["v"].to_pylist(), width))) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], pa.array(lists, pa.int32())],
                                             ["vec_id", "v", "list"])

    listed = staged(rows.mapInArrow(assign, "vec_id long, v array<double>, list int"), "lists")
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # one number per list
    held = np.array([sizes.get(i, 0) for i in range(len(index.centres))])

    def probe(batches):
        own = shared.value
        for batch in batches:
            out = {"query_id": [], "q": [], "to_beat": [], "lists": [], "seed_ids": [], "seed_scores": []}
            units = unit(matrix(batch["v"].to_pylist(), width)) if len(batch) else np.empty((0, width))
            order = np.argsort(-(units @ own.centres.T), axis=1)
            filled = held[order].cumsum(axis=1)
            for i, (query_id, q) in enumerate(zip(batch["vec_id"].to_pylist(), batch["v"].to_pylist())):
                # further lists where the first ones hold too few rows
                count = max(own.probes, int(np.searchsorted(filled[i], min(own.k + 1, total))) + 1)
                best, beat = own.seeds(query_id, np.array(q))
                out["query_id"].append(query_id)
                out["q"].append(q)
                out["to_beat"].append(float(beat))
                out["lists"].append(order[i, :count].tolist())
                out["seed_ids"].append(own.ids[best].tolist())
                out["seed_scores"].append(cosine(own.original[best], np.array(q)).tolist() if len(best) else [])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("to_beat", pa.float64()),
                ("lists", pa.list_(pa.int32())), ("seed_ids", pa.list_(pa.int64())),
                ("seed_scores", pa.list_(pa.float64()))]))

    asked = usable(queries, id_col, vector_col).where(F.col("vec_id").isNotNull() & (F.size("v") == width))
    probed = staged(asked.mapInArrow(probe, "query_id long, q array<double>, to_beat double, lists array<int>, "
                                     "seed_ids array<long>, seed_scores array<double>"), "probes")
    seeds = probed.select("query_id", F.explode(F.arrays_zip("seed_ids", "seed_scores")).alias("s")).select(
        "query_id", F.col("s.seed_ids").alias("vec_id"), F.col("s.seed_scores").alias("score"))
    probed = probed.select("query_id", "q", "to_beat", F.explode("lists").alias("list"))
    wanted = {r["list"]: r["count"] for r in probed.groupBy("list").count().collect()}
    cuts = F.broadcast(spark.createDataFrame(  # one row per list
        [(i, max(1, -(-sizes.get(i, 0) // BLOCK_ROWS)), max(1, -(-wanted.get(i, 0) // BLOCK_QUERIES)))
         for i in range(len(index.centres))], "list int, row_blocks long, query_blocks long"))
    block_rows = listed.join(cuts, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).alias("rb"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"), "vec_id", "v")
    block_queries = probed.join(cuts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("rb"),
        F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).alias("qb"), "query_id", "q", "to_beat")

    def nearest(found, asked):
        none = {"query_id": np.array([], "int64"), "vec_id": np.array([], "int64"), "score": np.array([])}
        if not len(found) or not len(asked):
            return pd.DataFrame(none)
        own = shared.value
        original, ids = matrix(found["v"], width), found["vec_id"].to_numpy()
        rotated, out = unit(original) @ own.rotation, []
        q_original = matrix(asked["q"], width)
        q_rotated = unit(q_original) @ own.rotation
        for i, (query_id, to_beat) in enumerate(zip(asked["query_id"], asked["to_beat"])):
            # a first stretch of rows tightens the bound for the rest
            head, parts = min(len(ids), 8 * BLOCK_ROWS // 64), []
            for start, stop in ((0, head), (head, len(ids))):
                alive, partial = scan_block(rotated[:stop], start, q_rotated[i], to_beat, k)
                alive, partial = alive[(own_ids := ids[alive]) != query_id], partial[own_ids != query_id]
                parts.append(alive)
                if len(partial) >= k:
                    to_beat = min(to_beat, np.partition(partial, k - 1)[k - 1])
            places = np.concatenate(parts)
            if len(places):
                score = cosine(original[places], q_original[i])
                best = np.lexsort((ids[places], -score))[:k]
                out.append((np.full(len(best), query_id), ids[places][best], score[best]))
        return pd.DataFrame(dict(zip(none, map(np.concatenate, zip(*out)))) if out else none)

    pairs = block_rows.groupBy("list", "rb", "qb").cogroup(block_queries.groupBy("list", "rb", "qb")).applyInPandas(
        nearest, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.unionByName(seeds).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
