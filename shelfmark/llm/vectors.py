"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping cluster shards.

1. Equal vectors become one class with a count.  Centroids are fitted on a bounded sample; every
   class goes to the shards of its ``probes`` nearest centroids, so shards overlap.  A cluster of more than
   ``BLOCK`` classes is dealt into blocks, and every pair of its blocks is a shard of its own, so no
   task holds more than 2 * BLOCK classes.
2. Every shard builds a flat graph: each class's pool of near classes is robust-pruned.  The adjacency lists of a
   class are united over all its shards.
3. Every class of a shard searches the united graph there, from the shard's medoids and from itself, by greedy search that
   goes on expanding all it finds in range.  Cosines are taken in double precision, and a link found from one end counts
   for both.  A shard audits its recall against brute force for some of its classes; one that misses the bound is
   compared exactly.
4. A pair is counted in one shard only (the first cluster that both share); only counts and local components leave
   a shard, never pairs.
5. Recall over all shards is audited against brute force for ``AUDIT`` hash-chosen classes of each size of group, as the
   mean per class, over all and per group size, so large groups do not outweigh small ones.  Below ``RECALL`` the
   whole is done again with more probes; where those would be all cells, in one cell, whose blocks are compared exactly.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .components import connected_components
from .flat_graph import edges_both_ways, medoid, range_search, robust_pruned

CELL = 700  # classes nearest to a centroid, about
BLOCK = 2500
SHARD_AUDIT = 32  # classes of a shard that are compared with all of it
FIT = 20_000  # bounded sample that the centroids are fitted on
MOST_CELLS = 2000
AUDIT, SEEN, RECALL = 200, 20, 0.97


def matrix(column) -> np.ndarray:
    """Rows of a list column of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def by_length(batches):
    """The batches cut so that all vectors ``v`` of one have the same length."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("v"))
        for d in pc.unique(sizes).to_pylist():
            yield batch.filter(pc.equal(sizes, d))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means on a bounded sample, deterministic."""
    rng = np.random.default_rng(5)
    centers = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(8):
        near = np.concatenate([(sample[i:i + 2048] @ centers.T).argmax(axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centers)
    return centers


def _assigner(shared, probes: int):
    def run(batches):
        centers = shared.value
        for batch in by_length(batches):
            x = unit(matrix(batch.column("v")))
            same = centers.get(x.shape[1])
            scores = x @ same.T
            order = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
            cells = [sorted(int(c) for c in row) for row in order]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("mult"), pa.array(list(x), pa.list_(pa.float64())), pa.array([x.shape[1]] * len(x), pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))], ["rep", "mult", "v", "dim", "cells"])
    return run


def _grapher(least: float):
    def run(table: pa.Table) -> pa.Table:
        ids = table["rep"].to_numpy()
        near = edges_both_ways(robust_pruned(matrix(table["v"]), least))
        return pa.table({"rep": table["rep"], "near": pa.array([ids[p] for p in near], pa.list_(pa.int64()))})
    return run


def _local_graph(ids: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    """United adjacency lists as rows of this shard, padded by -1; neighbours that are not here are left out."""
    sizes = np.array([len(p) for p in lists])
    flat = np.array([i for p in lists for i in p], np.int64)
    order = np.argsort(ids)
    at = order[np.minimum(np.searchsorted(ids, flat, sorter=order), len(ids) - 1)]
    here = ids[at] == flat
    owner, place = np.repeat(np.arange(len(ids)), sizes), np.concatenate([np.arange(k) for k in sizes] or [np.zeros(0, int)])
    graph = np.full((len(ids), max(1, int(sizes.max(initial=1)))), -1)
    graph[owner[here], place[here]] = at[here]
    return graph


def linked_rows(x: np.ndarray, graph: np.ndarray, starts: list[int], least: float, exact: bool = False) -> np.ndarray:
    """(row, row): the links that the search finds from either end; all of them where it misses the bound, or if ``exact``."""
    n = len(x)
    near = np.zeros((n, n), bool)
    if not exact:
        for i, scores in range_search(x, graph, starts, least):
            near[i:i + len(scores)] = scores >= least
        near |= near.T
        some = np.random.default_rng(n).choice(n, min(n, SHARD_AUDIT), replace=False)
        true = x[some] @ x.T >= least
        true[np.arange(len(some)), some] = False
        want, have = true.sum(axis=1), (true & near[some]).sum(axis=1)
        share = have[want > 0] / want[want > 0]
        size = np.floor(np.log2(want[want > 0]))  # small groups have a mean of their own
        exact = any(share[size == k].mean() < RECALL for k in np.unique(size))
    if exact:
        for i in range(0, n, 256):
            near[i:i + 256] = x[i:i + 256] @ x.T >= least
    near[np.arange(n), np.arange(n)] = False
    return near


def _searcher(least: float, exact: bool):
    def run(table: pa.Table) -> pa.Table:
        ids, mult, block = (table[c].to_numpy() for c in ("rep", "mult", "block"))
        cell, a, b = (table[c][0].as_py() for c in ("cell", "a", "b"))
        x = matrix(table["v"])
        graph = _local_graph(ids, table["near"].to_pylist())
        near = linked_rows(x, graph, [medoid(x, np.flatnonzero(block == k)) for k in np.unique(block)], least, exact)
        # class x earlier cell: a pair that shares one is counted there
        row, earlier = zip(*[(i, c) for i, cs in enumerate(table["cells"].to_pylist()) for c in cs if c < cell] or [(0, -1)])
        names, column = np.unique(earlier, return_inverse=True)
        before = np.zeros((len(ids), len(names)), np.float32)
        before[row, column] = names[column] >= 0
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in range(0, len(ids), 256):
            part = near[i:i + 256]
            for me, hits in enumerate(part, i):
                for j in np.unique(root[np.flatnonzero(hits)]).tolist():
                    u, v = find(me), find(j)
                    if u != v:
                        low, high = (u, v) if ids[u] < ids[v] else (v, u)
                        root[high] = low
            part = part & (before[i:i + len(part)] @ before.T == 0)
            if a != b:
                part &= block[i:i + len(part), None] != block
            links[i:i + len(part)] = part @ mult
        comp = np.array([ids[find(i)] for i in range(len(ids))], np.int64)
        return pa.table({"rep": table["rep"], "links": pa.array(links), "comp": pa.array(comp)})
    return run


def _audited(shared, least: float):
    def run(batches):
        samples, n = shared.value  # by dimension: places in the sample, vectors
        for batch in by_length(batches):
            y, total = matrix(batch.column("v")), np.zeros(n, np.int64)
            at, x = samples.get(y.shape[1], ([], None))
            if len(at):
                total[at] = batch.column("mult").to_numpy() @ (y @ x.T >= least)
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array(total, pa.int64())], ["q", "n"])
    return run


def embedding_near_duplicates(vectors: DataFrame, least: float = 0.9, probes: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding).

    Rows link if the cosine of their embeddings is ``least`` or more.  An embedding that is null,
    empty, all zero or holds a null or non-finite component links with nothing, nor do embeddings of
    different length.  Equal embeddings link with each other (their cosine is 1).  A row with a null vec_id
    links with nothing: null component, kept.  Rows that repeat a vec_id count as separate
    vectors for n_links.  Other columns are ignored.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = F.expr("vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
                  "AND exists(v, x -> x <> 0)")
    rows = materialize(rows.withColumn("good", F.coalesce(good, F.lit(False))), "vectors")
    classes = materialize(rows.where("good").withColumn("v", F.transform("v", lambda x: x + 0.0))
                          .groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "vector_classes")
    found = _classes_linked(classes, least, probes)
    out = rows.where("good").select("vec_id", F.transform("v", lambda x: x + 0.0).alias("v")).join(classes, "v").select("vec_id", "rep", "mult").join(found, "rep", "left")
    out = out.select("vec_id", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    rest = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _sample(classes: DataFrame, most: int) -> list:
    """At most about ``most`` classes, by a hash of the vector; fewer when two dimensions share them."""
    total = classes.count()
    part = classes if total <= most else classes.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int((1 << 20) * most / total))
    return part.select("v", "rep", "mult").collect()


def _classes_linked(classes: DataFrame, least: float, probes: int) -> DataFrame:
    spark = classes.sparkSession
    total = classes.count()
    by_dim: dict[int, list] = {}
    for r in _sample(classes, FIT):
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    centers = {d: fit_centroids(unit(np.array(v)), max(1, min(MOST_CELLS, -(-total // CELL), len(v)))) for d, v in by_dim.items()}
    for d, k in classes.groupBy(F.size("v").alias("d")).count().collect():  # a length that the sample missed
        centers.setdefault(d, np.eye(1, d))
    cells = max(map(len, centers.values()), default=0)
    exact = False
    while True:
        placed = materialize(classes.mapInArrow(_assigner(spark.sparkContext.broadcast(centers), probes),
                                                "rep long, mult long, v array<double>, dim int, cells array<int>"), "placed")
        found = materialize(_search_shards(placed, least, exact), "found")
        if exact or _recall(placed, found, least) >= RECALL:
            return found
        probes *= 2
        if probes >= cells:
            centers, exact = {d: c[:1] for d, c in centers.items()}, True


def _search_shards(placed: DataFrame, least: float, exact: bool) -> DataFrame:
    """(rep, links, component) from the shards of ``placed``."""
    spread = placed.select("dim", F.explode("cells").alias("cell"), "rep", "mult", "v", "cells")
    sizes = placed.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    spread = spread.join(sizes, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                        lambda o: F.struct(F.least(o, F.col("block")).alias("a"), F.greatest(o, F.col("block")).alias("b")))
    shards = spread.select("dim", "cell", "rep", "mult", "v", "cells", "block", F.explode(pairs).alias("s"))
    shards = materialize(shards.select("dim", "cell", "rep", "mult", "v", "cells", "block", "s.a", "s.b"), "shards")
    shard = ["dim", "cell", "a", "b"]
    if exact:
        ready = shards.withColumn("near", F.array().cast("array<long>"))
    else:
        lists = materialize(shards.groupBy(*shard).applyInArrow(_grapher(least), "rep long, near array<long>"), "lists")
        graph = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        ready = shards.join(materialize(graph, "graph"), "rep")
    hits = ready.groupBy(*shard).applyInArrow(_searcher(least, exact), "rep long, links long, comp long")
    hits = materialize(hits, "hits")
    comp = connected_components(hits, "rep", "comp").withColumnRenamed("node", "rep")
    return hits.groupBy("rep").agg(F.sum("links").alias("links")).join(comp, "rep", "left")


def _recall(placed: DataFrame, found: DataFrame, least: float) -> float:
    """The least mean recall per class, over all audited classes and over those of each group size.

    Classes are drawn by hash, ``AUDIT`` of each size class (power of 2) of found links, and weigh as
    many classes as they stand for.  Brute force over all classes gives their true links; group sizes are
    those of the true links, and one that fewer than ``SEEN`` audited classes have has no mean of its own.
    """
    have = placed.join(found, "rep").select("rep", "v", "mult", "links", F.floor(F.log2(F.col("links") + 1)).alias("size"))
    have = materialize(have, "audit")
    counts = {r["size"]: r["count"] for r in have.groupBy("size").count().collect()}  # at most 63
    if not counts:
        return 1.0
    share = F.create_map(*[F.lit(v) for s, c in counts.items() for v in (s, min(1.0, AUDIT / c))])
    sample = have.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < (1 << 20) * share[F.col("size")]).collect()
    by_dim: dict[int, list[int]] = {}
    for i, r in enumerate(sample):
        by_dim.setdefault(len(r["v"]), []).append(i)
    shared = placed.sparkSession.sparkContext.broadcast(({d: (at, np.array([sample[i]["v"] for i in at])) for d, at in by_dim.items()}, len(sample)))
    true = placed.select("v", "mult").mapInArrow(_audited(shared, least), "q int, n long").groupBy("q").agg(F.sum("n").alias("n"))
    true = {r["q"]: r["n"] for r in true.collect()}
    drawn = Counter(r["size"] for r in sample)
    parts: dict[int, list] = {}
    for i, r in enumerate(sample):
        want = true[i] - r["mult"]
        if want > 0:
            parts.setdefault(want.bit_length(), []).append((counts[r["size"]] / drawn[r["size"]], min(1.0, r["links"] / want)))
    every = [x for rows in parts.values() for x in rows]
    means = [float(np.average([x[1] for x in rows], weights=[x[0] for x in rows]))
             for rows in [every, *parts.values()] if rows and (rows is every or len(rows) >= SEEN)]
    return min(means, default=1.0)
