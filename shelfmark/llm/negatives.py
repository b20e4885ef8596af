"""Hard-negative mining by exact top-k inner products with coordinate pruning (after LEMP, Teflioudi et al. 2015).

1. Vectors become integers and are ordered by length; runs of ``BUCKET`` of one dimension become length buckets: a
   written table, one row a bucket, with the longest length, the vectors, ids and labels, and for every coordinate the
   list of the bucket's rows sorted by that coordinate of the unit vectors.
2. The anchors, a stated share of the rows, are searched in chunks of about ``CHUNK``, each sent to the tasks that
   read the buckets.  A slot of an anchor wants the best ``k`` rows whose score lies in [low, cap] and whose label
   equals, or differs from, the anchor's.  The least score still wanted is ``low`` or the slot's k-th best so far.
3. An anchor skips a bucket whose longest vector cannot reach that score.  Else the score divided by both lengths is the
   least cosine t, and a unit vector with cosine t or more to the anchor's has each coordinate within the angle arccos(t)
   of the anchor's.  For the anchor's ``FOCUS`` largest coordinates these ranges are looked up in the sorted lists; rows
   in all of them are candidates and are verified by their exact integer product.  Where even the shortest range holds
   more than ``DENSE`` of the bucket, all its rows are verified in one matrix product.
4. Every task keeps the best k a slot over its buckets, and a window merges the tasks' rows.  With many buckets a hashed
   square root of them is searched first, and the k-th best found there, a true lower bound, narrows the rest.

Every chunk's rows are written as it ends, so a lost executor repeats at most one chunk.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, new_folder, prepare, settings

BUCKET = 2048
TASK_ROWS = 8192  # a task's vectors at least, and 32 times that at most
FOCUS = 4
DENSE = 0.5
CHUNK = 8192  # anchors a chunk, about
PART = 256  # anchors in a matrix product
LIMIT = 1 << 24  # larger components are left out: their products pass 64 bits
MANY = 64  # buckets, from which on a first share of them is searched before the rest
NONE = np.iinfo(np.int64).min

BUCKETS = "dim int, longest double, ids binary, rows binary, labels binary, v binary, lists binary"


def _buckets(batches):
    """Rows (dim, vec_id, row, label, v), ordered by (dim, length) -> one row a bucket."""
    def bucket(dim: int, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, v: np.ndarray) -> dict:
        order = np.lexsort((rows, ids))
        ids, rows, labels, v = ids[order], rows[order], labels[order], v[order]
        length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        lists = np.argsort(v / np.maximum(length, 1e-300)[:, None], axis=0, kind="stable").T.astype(np.uint16)
        return {"dim": dim, "longest": float(length.max()), "ids": ids.tobytes(), "rows": rows.tobytes(), "labels": labels.tobytes(),
                "v": v.astype(np.int32).tobytes(), "lists": np.ascontiguousarray(lists).tobytes()}

    held: list[tuple] = []
    for batch in batches:
        if not len(batch):
            continue
        ids, rows, labels = (batch.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        dims, vectors = batch.column("dim").to_numpy(), batch.column("v")
        for dim in np.unique(dims):  # ascending, as the rows are
            at = np.flatnonzero(dims == dim)
            v = vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
            if held and held[0][0] != dim:
                yield from _bucket_rows(held, bucket, 0)
                held = []
            held.append((int(dim), ids[at], rows[at], labels[at], v))
            if sum(len(h[1]) for h in held) >= BUCKET:
                rest = yield from _bucket_rows(held, bucket, BUCKET)
                held = rest
    if held:
        yield from _bucket_rows(held, bucket, 0)


def _bucket_rows(held: list[tuple], bucket, whole: int):
    """The buckets of the held rows; with ``whole`` only full ones, and the rest is returned."""
    dim, columns = held[0][0], [np.concatenate([h[i] for h in held]) for i in range(1, 5)]
    n = len(columns[0])
    stop = n - n % whole if whole else n
    schema = pa.schema([("dim", pa.int32()), ("longest", pa.float64()), *((c, pa.binary()) for c in ("ids", "rows", "labels", "v", "lists"))])
    for i in range(0, stop, BUCKET):
        yield pa.RecordBatch.from_pylist([bucket(dim, *[c[i:min(i + BUCKET, stop)] for c in columns])], schema)
    return [(dim, *[c[stop:] for c in columns])] if stop < n else []


@dataclass
class Anchors:
    """Anchors of one dimension: their rows, labels and vectors, and per slot the scores wanted (``low`` > ``cap``: none)."""

    rows: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    low: np.ndarray
    cap: np.ndarray


class _Best:
    """The best k (score, id, row) per anchor and slot; score descending, then id and row ascending."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.score = np.full((anchors, slots, k), NONE)
        self.id = np.zeros((anchors, slots, k), np.int64)
        self.row = np.zeros((anchors, slots, k), np.int64)

    def merge(self, at: np.ndarray, slot: int, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        k = self.score.shape[2]
        score, id_, row = (np.concatenate([mine[at, slot], new], axis=1) for mine, new in ((self.score, score), (self.id, id_), (self.row, row)))
        order = np.lexsort((row, id_, -np.maximum(score, NONE + 1)), axis=-1)[:, :k]
        for mine, new in ((self.score, score), (self.id, id_), (self.row, row)):
            mine[at, slot] = np.take_along_axis(new, order, axis=1)


def feasible(q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest coordinate that a unit vector with cosine >= t to one with coordinate q can have there."""
    angle, reach = np.arccos(np.clip(q, -1, 1)), np.arccos(np.clip(t, -1, 1)) + 1e-9
    return np.cos(np.minimum(angle + reach, np.pi)) - 1e-9, np.cos(np.maximum(angle - reach, 0)) + 1e-9


def _search(bucket: dict, anchors: Anchors, best: _Best, same_label: bool) -> int:
    """Search one bucket for all anchors; returns the number of products taken."""
    k = best.score.shape[2]
    ids, rows, labels = (np.frombuffer(bucket[c], np.int64) for c in ("ids", "rows", "labels"))
    n, dim = len(ids), anchors.v.shape[1]
    v = np.frombuffer(bucket["v"], np.int32).reshape(n, dim)
    lists = np.frombuffer(bucket["lists"], np.uint16).reshape(dim, n)
    lengths = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    units = v / np.maximum(lengths, 1e-300)[:, None]
    # floats where every product and partial sum is an exact integer
    largest = int(np.abs(v).max(initial=0)) * int(np.abs(anchors.v).max(initial=0)) * dim
    y, qs = (v.astype(np.float64), anchors.v.astype(np.float64)) if largest < 1 << 50 else (v.astype(np.int64), anchors.v)

    kth = np.maximum(anchors.low, np.where(best.score[:, :, -1] == NONE, anchors.low, best.score[:, :, -1]))
    open_ = anchors.low <= anchors.cap
    wanted = np.where(open_, kth, np.iinfo(np.int64).max).min(axis=1).astype(np.float64)
    q_length = np.sqrt((anchors.v.astype(np.float64) ** 2).sum(axis=1))
    reach = q_length * bucket["longest"] * (1 + 1e-9)
    live = np.flatnonzero(open_.any(axis=1) & (wanted <= reach))
    t = np.where(reach > 0, wanted / np.maximum(reach, 1e-300), 0)
    prune = live[t[live] > 0]
    focus = np.argsort(-np.abs(anchors.v[prune]), axis=1, kind="stable")[:, :FOCUS]
    unit_q = anchors.v[prune] / np.maximum(q_length[prune], 1e-300)[:, None]
    lo, hi = feasible(np.take_along_axis(unit_q, focus, axis=1), t[prune][:, None])
    first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        values = units[lists[f], f]
        a, b = np.nonzero(focus == f)
        first[a, b], last[a, b] = np.searchsorted(values, lo[a, b], "left"), np.searchsorted(values, hi[a, b], "right")
    sizes = last - first
    narrow = sizes.min(axis=1, initial=n) <= DENSE * n
    products = 0
    for i in np.flatnonzero(narrow):
        shortest = int(sizes[i].argmin())
        among = lists[focus[i, shortest], first[i, shortest]:last[i, shortest]].astype(np.int64)
        for j, f in enumerate(focus[i]):
            among = among[(units[among, f] >= lo[i, j]) & (units[among, f] <= hi[i, j])]
        if len(among):
            among.sort()  # rows of a bucket are in id order
            at = prune[i:i + 1]
            products += len(among)
            _take(at, (qs[at] @ y[among].T).astype(np.int64), ids[among], rows[among], labels[among], anchors, best, kth, k, same_label)
    dense = np.setdiff1d(live, prune[narrow])
    for i in range(0, len(dense), PART):
        at = dense[i:i + PART]
        products += len(at) * n
        _take(at, (qs[at] @ y.T).astype(np.int64), ids, rows, labels, anchors, best, kth, k, same_label)
    return products


def _take(at, scores, ids, rows, labels, anchors: Anchors, best: _Best, kth, k: int, same_label: bool) -> None:
    """Merge the verified ``scores`` (anchor, candidate; candidates in id order) into the best."""
    own = rows[None, :] == anchors.rows[at][:, None]
    fits = ((labels[None, :] == anchors.labels[at][:, None]) == same_label) & ~own
    for slot in range(anchors.low.shape[1]):
        good = fits & (scores >= kth[at, slot][:, None]) & (scores <= anchors.cap[at, slot][:, None])
        some = np.flatnonzero(good.any(axis=1))
        if not len(some):
            continue
        found = np.where(good[some], scores[some], NONE)
        most = min(k, found.shape[1])
        if most < found.shape[1]:
            edge = -np.partition(-np.maximum(found, NONE + 1), most - 1, axis=1)[:, most - 1:most]
            # all above the edge, then those on it in id order
            rank = np.cumsum(found == edge, axis=1) + (found > edge).sum(axis=1, keepdims=True)
            found = np.where((found > edge) | ((found == edge) & (rank <= most)), found, NONE)
        order = np.argsort(-np.maximum(found, NONE + 1), axis=1, kind="stable")[:, :most]
        best.merge(at[some], slot, np.take_along_axis(found, order, axis=1), ids[order], rows[order])


def _searcher(shared, k: int, same_label: bool):
    def run(batches):
        chunk = {d: Anchors(*arrays) for d, arrays in shared.value.items()}
        best = {d: _Best(*a.low.shape, k) for d, a in chunk.items()}
        for batch in batches:
            for bucket in batch.to_pylist():
                if bucket["dim"] in chunk:
                    _search(bucket, chunk[bucket["dim"]], best[bucket["dim"]], same_label)
        for d, found in best.items():
            a, s, i = np.nonzero(found.score != NONE)
            for j in range(0, len(a), 1 << 16):
                p = (a[j:j + (1 << 16)], s[j:j + (1 << 16)], i[j:j + (1 << 16)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (chunk[d].rows[p[0]], p[1].astype(np.int32), found.score[p], found.id[p], found.row[p])],
                    ["anchor_row", "slot", "score", "vec_id", "row"])
    return run


FOUND = "anchor_row long, slot int, score long, vec_id long, row long"


def length_buckets(rows: DataFrame) -> DataFrame:
    """The written table of length buckets of ``rows`` (vec_id, row, label, dim, v array<int>)."""
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // TASK_ROWS), max(2 * cores, -(-n // (32 * TASK_ROWS)))))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = (rows.withColumn("length", length).repartitionByRange(parts, "dim", F.col("length").desc(), "row")
               .sortWithinPartitions("dim", F.col("length").desc(), "row").select("dim", "vec_id", "row", "label", "v"))
    return materialize(ordered.mapInArrow(_buckets, BUCKETS), "length_buckets")


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(buckets: DataFrame, chunk: dict[int, Anchors], k: int, same_label: bool) -> DataFrame:
    """(anchor_row, slot, score, vec_id, row, rank): the exact best ``k`` rows of every slot, written."""
    spark = buckets.sparkSession

    def run(part: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast({d: (a.rows, a.labels, a.v, a.low, a.cap) for d, a in chunk.items()})
        return part.mapInArrow(_searcher(shared, k, same_label), FOUND)

    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):  # a row is a bucket
        total = buckets.count()
        if total < MANY:
            return materialize(_best_rows(run(buckets), k), "found")
        first = F.pmod(F.xxhash64("ids", "rows"), F.lit(math.isqrt(total))) == 0
        early = materialize(_best_rows(run(buckets.where(first)), k), "found_early")
        place = _places(chunk)
        for r in early.where(F.col("rank") == k).select("anchor_row", "slot", "score").collect():  # at most one a slot of the chunk
            anchors, i = place[r["anchor_row"]]
            anchors.low[i, r["slot"]] = max(anchors.low[i, r["slot"]], r["score"])
        return materialize(_best_rows(run(buckets.where(~first)).unionByName(early.drop("rank")), k), "found")


def _places(chunk: dict[int, Anchors]) -> dict[int, tuple[Anchors, int]]:
    """Where each anchor row of the chunk is."""
    return {row: (anchors, i) for anchors in chunk.values() for i, row in enumerate(anchors.rows.tolist())}


def _anchors(rows: DataFrame) -> dict[int, Anchors]:
    """The anchors of one chunk by dimension, with one slot open to all scores."""
    by_dim: dict[int, list] = {}
    for r in rows.select("row", "label", "v").collect():
        by_dim.setdefault(len(r["v"]), []).append(r)
    return {dim: Anchors(np.array([r["row"] for r in part], np.int64), np.array([r["label"] for r in part], np.int64),
                         np.array([r["v"] for r in part], np.int64).reshape(len(part), dim),
                         np.full((len(part), 1), NONE), np.full((len(part), 1), np.iinfo(np.int64).max)) for dim, part in by_dim.items()}


def _below(chunk: dict[int, Anchors], found: list, slots: int, low: int, high: int) -> dict[int, Anchors]:
    """The same anchors with a slot a positive: scores from low % to high % of the positive's; other slots stay closed."""
    out = {d: Anchors(a.rows, a.labels, a.v, np.full((len(a.rows), slots), 1), np.full((len(a.rows), slots), 0)) for d, a in chunk.items()}
    place = _places(out)
    for r in found:
        anchors, i = place[r["anchor_row"]]
        anchors.low[i, r["slot"]] = -(-low * r["positive_score"] // 100)
        anchors.cap[i, r["slot"]] = high * r["positive_score"] // 100
    return out


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ``vectors`` (vec_id, embedding, label).

    Rows with a null vec_id, label or embedding, or any null or non-finite component take no part; nor do those with a
    component beyond +-2**24 after scaling, whose products do not fit a long.  A component x becomes floor(scale * x);
    scores are integer inner products, and only vectors of equal length meet.  Higher scores come first, ties by smaller vec_id.

    Anchors are the rows whose vec_id is divisible by ``every``; an anchor's positives are its first ``positives`` other
    rows of its label.  For each, the first ``negatives`` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned, ranked from 1.  Anchors without
    positives, and positives without such rows, give no rows; so does an empty table.

    Rows that repeat a vec_id, or are equal altogether, are rows of their own: a repeated anchor's copy is one of its
    other rows, and both give their rows; ties between such rows are broken in a fixed order.  Other columns are ignored.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    good = F.expr(f"vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x * {scale}) <= {LIMIT})")
    rows = rows.where(good).select("vec_id", "label", F.size("e").alias("dim"), F.transform("e", lambda x: F.floor(x * scale).cast("int")).alias("v"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    buckets = length_buckets(rows)
    asked = rows.where(F.col("vec_id") % every == 0)
    chunks = -(-asked.count() // CHUNK)
    folder = new_folder(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(f"{folder}/none")
    for chunk in range(chunks):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(chunks)) == chunk)
        anchors = _anchors(mine)
        found = search(buckets, anchors, positives, same_label=True).select(
            "anchor_row", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        anchors = _below(anchors, found.collect(), positives, low, high)  # `positives` rows an anchor of the chunk
        worst = search(buckets, anchors, negatives, same_label=False)
        out = (worst.select("anchor_row", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
               .join(found, ["anchor_row", "slot"]).join(mine.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row"))
        out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(f"{folder}/{chunk}")
    return spark.read.schema(RESULT).parquet(f"{folder}/*")
