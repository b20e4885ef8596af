"""Centroid clustering over space-filling-curve zone maps.

1. Vectors become integers; their Hilbert-curve key orders them, and runs of ``BLOCK`` neighbours become blocks: a
   written table of blocks, each with the smallest and largest value of every component (its box), its vectors' sum
   and their number.  Range partitioning by (key, vec_id) spreads equal vectors too.
2. A round assigns block by block: the squared distances from a centroid to the nearest and to the farthest point of
   the box bound those to the block's vectors, so a centroid whose nearest point is farther than another's farthest
   cannot win.  A block with one candidate left goes to it whole, by its stored sum; else its vectors meet the
   candidates exactly, in 64-bit integers.
3. Every task adds up its sums per centroid; what reaches the driver is one row a centroid.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, settings

BLOCK = 256
BITS = 6  # a component on the curve
LIMIT = 1 << 27  # larger components are left out: 64 squared differences of them pass 64 bits
BLOCKS_A_BATCH = 32


def hilbert_keys(x: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Position of each row on the Hilbert curve through the cube of side ``2 ** bits`` (Skilling 2004), as bytes that sort so."""
    x = x.astype(np.uint32).copy()
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            up = (x[:, i] & bit) != 0
            swap = np.where(up, np.uint32(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    turn = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn[:, None]
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)]


def _keyed(low: int, high: int):
    scale = (1 << BITS) / (high - low + 1)

    def run(batches):
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(len(batch), -1) if len(batch) else np.zeros((0, 1), np.int64)
            keys = hilbert_keys(((v - low) * scale).astype(np.int64)) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(keys, pa.binary())], ["vec_id", "v", "curve"])
    return run


def _blocks(batches):
    """Rows in curve order -> one row a block of at most ``BLOCK`` neighbours."""
    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        v = rows["v"].chunk(0).flatten().to_numpy().reshape(rows.num_rows, -1).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows["vec_id"].chunk(0))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([v.tobytes()], pa.binary()), pa.array([v.min(axis=0)], pa.list_(pa.int32())), pa.array([v.max(axis=0)], pa.list_(pa.int32())),
             pa.array([v.sum(axis=0, dtype=np.int64)], pa.list_(pa.int64()))], ["ids", "v", "low", "high", "total"])

    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count >= BLOCK:
            table = pa.Table.from_batches(held)
            for i in range(0, count - count % BLOCK, BLOCK):
                yield block(table.slice(i, BLOCK))
            held, count = table.slice(count - count % BLOCK).to_batches(), count % BLOCK
    if count:
        yield block(pa.Table.from_batches(held))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(box, centroid): may the centroid be the nearest, smallest in number on ties, of a vector in the box?"""
    under, over = low[:, None, :] - centroids, centroids - high[:, None, :]
    nearest = (np.maximum(np.maximum(under, over), 0) ** 2).sum(axis=2)
    farthest = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(axis=2)
    return nearest <= farthest.min(axis=1, keepdims=True)


def _boxes(batch: pa.RecordBatch, dims: int):
    low, high, total = (batch.column(c).flatten().to_numpy().reshape(-1, dims).astype(np.int64) for c in ("low", "high", "total"))
    return low, high, total


def _nearest(batch: pa.RecordBatch, i: int, centroids: np.ndarray, may: np.ndarray):
    """Vectors of block i, their centroid's number and squared distance; candidates only, in number order, so ties take the smaller."""
    v = np.frombuffer(batch.column("v")[i].as_py(), np.int32).reshape(-1, centroids.shape[1]).astype(np.int64)
    among = np.flatnonzero(may)
    far = np.stack([((v - centroids[c]) ** 2).sum(axis=1) for c in among], axis=1)
    at = far.argmin(axis=1)
    return v, among[at], far[np.arange(len(v)), at]


def _summed(shared):
    def run(batches):
        centroids = shared.value
        k, dims = centroids.shape
        count, total, compared = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            low, high, sums = _boxes(batch, dims)
            sizes = np.diff(batch.column("ids").offsets.to_numpy())
            may = candidates(low, high, centroids)
            alone = may.sum(axis=1) == 1
            won = may.argmax(axis=1)
            np.add.at(total, won[alone], sums[alone])
            np.add.at(count, won[alone], sizes[alone])
            for i in np.flatnonzero(~alone):
                v, at, _ = _nearest(batch, i, centroids, may[i])
                np.add.at(total, at, v)
                count += np.bincount(at, minlength=k)
                compared[may[i]] += sizes[i]
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(count), pa.array(list(total), pa.list_(pa.int64())), pa.array(compared)],
                                         ["cluster", "n", "total", "compared"])
    return run


def _assigned(shared):
    def run(batches):
        centroids = shared.value
        for batch in batches:
            if not len(batch):
                continue
            low, high, _ = _boxes(batch, centroids.shape[1])
            may = candidates(low, high, centroids)
            parts = [_nearest(batch, i, centroids, may[i])[1:] for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids").flatten(), pa.array(np.concatenate([p[0] for p in parts]), pa.int32()), pa.array(np.concatenate([p[1] for p in parts]))],
                ["vec_id", "cluster", "distance"])
    return run


def zone_map(vectors: DataFrame) -> DataFrame:
    """Blocks (ids, v, low, high, total) of ``vectors`` (vec_id, v array<int> of one length), in curve order; a written table."""
    span = vectors.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    keyed = vectors.mapInArrow(_keyed(span["low"] or 0, span["high"] or 0), "vec_id long, v array<int>, curve binary")
    ordered = keyed.repartitionByRange("curve", "vec_id").sortWithinPartitions("curve", "vec_id").drop("curve")
    return materialize(ordered.mapInArrow(_blocks, "ids array<long>, v binary, low array<int>, high array<int>, total array<long>"), "zone_map")


def update_round(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after one round over ``blocks``, and how many distances it took."""
    spark, (k, dims) = blocks.sparkSession, centroids.shape
    shared = spark.sparkContext.broadcast(centroids)  # k x dims integers
    parts = blocks.mapInArrow(_summed(shared), "cluster int, n long, total array<long>, compared long")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), *[
        F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(dims)]).collect()  # k rows
    now = centroids.copy()
    for row in sums:
        if row["n"]:
            now[row["cluster"]] = [int(row[f"t{i}"]) // row["n"] for i in range(dims)]
    return now, sum(row["compared"] for row in sums)


def zone_clusters(vectors: DataFrame, k: int = 16, dims: int = 64, scale: int = 64, rounds: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of the kept rows of ``vectors`` (vec_id, embedding).

    Kept are embeddings of exactly ``dims`` components, none null or non-finite; a component x becomes floor(scale * x).
    Centroids start as the ``k`` kept vectors (all, if fewer) with the smallest sha256 of ``1:<vec_id>``; rows that repeat a
    vec_id are ordered by vector.  Each round assigns every vector to the nearest centroid (squared distance, ties to the
    smaller number) and moves every non-empty one to floor(sum / count); after ``rounds`` all are assigned once more.

    A vector with a component of which floor(scale * x) is beyond +-2**27 is left out too, as its distance does not fit a
    long.  Inertias that do not fit a long are null.  A null vec_id starts no centroid, but its vector is clustered (unless
    no row has a vec_id: then there are no centroids and no rows).  Repeated rows count and return as often as they stand.
    Other columns are ignored.  No kept vector: no rows.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    good = F.expr(f"size(e) = {dims} AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x * {scale}) <= {LIMIT})")
    kept = materialize(rows.where(good).select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("int")).alias("v")), "kept")
    first = kept.where("vec_id IS NOT NULL").orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256), "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    centroids = np.array([r["v"] for r in first], np.int64)
    blocks = zone_map(kept)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BLOCKS_A_BATCH)}):  # a row is a block
        for _ in range(rounds):
            centroids, _ = update_round(blocks, centroids)
        found = materialize(blocks.mapInArrow(_assigned(spark.sparkContext.broadcast(centroids)), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def fits(n: int):
        return F.lit(n if n < 1 << 63 else None).cast("long")

    return found.select("vec_id", "cluster", "distance", F.array(*[fits(sums.get(c, 0)) for c in range(len(centroids))])[F.col("cluster")].alias("cluster_inertia"),
                        fits(sum(sums.values())).alias("inertia"), F.array(*map(F.lit, hashes))[F.col("cluster")].alias("centroid_sha256"))
