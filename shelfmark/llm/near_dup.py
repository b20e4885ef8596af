"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets.

Two collections of ``SUBS`` sub-keys are computed, each sub-key from ``ROWS`` minhashes.  A
table key is a pair (sub-key i of the first collection, sub-key j of the second), so
2 * SUBS * ROWS minhashes give SUBS**2 tables of 2 * ROWS rows each.  A pair of Jaccard
similarity s meets in some table with probability (1 - (1 - s**ROWS)**SUBS)**2: 0.9999 at 0.85.

Every bucket is a star: its members are compared with its smallest document, the centre, on
full sets, and what each member lost and gained against the centre is kept.  Members of a
centre that are still in different components are then compared with each other exactly through
those differences, in a join condition: pairs inside a component are not looked at, and pairs
without a link are never listed.  Documents whose shingles are too often unique to have any
link are set aside first by an exact bound.  So no link between components stays unseen,
however large a bucket is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare, settings, with_defaults
from .components import connected_components
from .kernels import U, codes, gram_sets, mix, slices, word_hashes, words

SUBS = 8
ROWS = 2

# Of all texts only the candidates' are needed again.  Where their ids are too many to broadcast,
# Spark's runtime Bloom filter (64 Mbit at most, whatever the corpus) keeps most other texts out of
# the shuffle; it is built over a filtered scan only, so the candidates are read under a filter.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 26),
}

SIGNATURE = "doc_id long, n_shingles long, s1 long, s2 long, subs array<long>"


def document_sets(column: pa.Array, k: int):
    """(first row, row count, sorted shingles of the rows, set offsets) per slice of a text column."""
    for first, count, data, offs in slices(column):
        starts, ends, at = words(data, offs)
        yield first, count, *gram_sets(word_hashes(data, starts, ends, lower=True), at, k)


def _signer(k: int):
    def run(batches):
        n_funcs = 2 * SUBS * ROWS
        flips, factors = codes(n_funcs, 11), codes(n_funcs, 13) | U(1)
        for batch in batches:
            sizes, sums, xors, subs = [], [], [], []
            for _, count, grams, at in document_sets(batch.column("text"), k):
                size = np.diff(at)
                full = np.flatnonzero(size)
                sub = np.zeros((count, 2 * SUBS), U)
                s1, s2 = np.zeros(count, U), np.zeros(count, U)
                if len(full):
                    where = at[:-1][full]
                    s1[full] = np.add.reduceat(mix(grams + U(1)), where)
                    s2[full] = np.bitwise_xor.reduceat(mix(grams + U(2)), where)
                    for f in range(n_funcs):
                        low = np.minimum.reduceat((grams ^ flips[f]) * factors[f], where)
                        sub[full, f // ROWS] = mix(sub[full, f // ROWS] + low)
                sizes.append(size)
                sums.append(s1)
                xors.append(s2)
                subs.append(sub)
            if not sizes:
                continue
            flat = np.concatenate(subs).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2 * SUBS), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(sizes).astype(np.int64)),
                 pa.array(np.concatenate(sums).view(np.int64)), pa.array(np.concatenate(xors).view(np.int64)), lists],
                ["doc_id", "n_shingles", "s1", "s2", "subs"])
    return run


def _set_writer(k: int):
    def run(batches):
        for batch in batches:
            for first, count, grams, at in document_sets(batch.column("text"), k):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, count), lists], ["id", "grams"])
    return run


def _sets_in(column: pa.ListArray):
    at, flat = column.offsets.to_numpy(), column.values.to_numpy().view(U)
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


DIFFS = "u long, v long, linked boolean, n_u long, n_v long, lost array<long>, new array<long>"


def _comparer(percent: int):
    """Exact comparison of member v with its centre u: what v lost of u's set and what it has new."""
    def run(batches):
        for batch in batches:
            linked, sizes, lost, new = [], [], [], []
            for c, m in zip(_sets_in(batch.column("grams_u")), _sets_in(batch.column("grams_v"))):
                at = np.minimum(np.searchsorted(c, m), len(c) - 1)
                hit = c[at] == m
                gone = np.ones(len(c), bool)
                gone[at[hit]] = False
                both = int(hit.sum())
                linked.append(100 * both >= percent * (len(c) + len(m) - both))
                sizes.append((len(c), len(m)))
                lost.append(c[gone].view(np.int64))
                new.append(m[~hit].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(linked, pa.bool_()), pa.array([s[0] for s in sizes], pa.int64()),
                 pa.array([s[1] for s in sizes], pa.int64()), pa.array(lost, pa.list_(pa.int64())), pa.array(new, pa.list_(pa.int64()))],
                ["u", "v", "linked", "n_u", "n_v", "lost", "new"])
    return run


def minhash_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their distinct
    k-word shingles (A-Z in lower case).  Fewer than k words: the whole sequence is the one
    shingle.  Null or empty texts have the empty set and link with nothing.  Rows that repeat a
    doc_id count as one document: a link of any of them links the id.  A null doc_id links
    with nothing: its component_id is null and it is kept.  Equal sets are one class, so exact
    copies are linked by one aggregation, and only classes are compared.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    docs = with_defaults(docs, {"doc_id": "long", "text": "string"})
    signed = materialize(docs.mapInArrow(_signer(k), SIGNATURE), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(usable.groupBy("n_shingles", "s1", "s2")
                          .agg(F.min("doc_id").alias("rep"), F.first("subs").alias("subs")), "classes")

    links = _class_links(classes, docs, k, percent)
    comp = connected_components(links, "u", "v")
    member = (usable.select("doc_id", "n_shingles", "s1", "s2")
              .join(classes.drop("subs"), ["n_shingles", "s1", "s2"])
              .select("doc_id", "n_shingles", "rep"))
    member = member.join(comp, member.rep == comp.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    rest = signed.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return member.unionAll(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _class_links(classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (u, v) that connect the classes' components."""
    # A class can only share a table key if it shares a sub-key of each collection.
    subs = classes.select("rep", "n_shingles", F.posexplode("subs").alias("i", "sub"))
    shared = subs.groupBy("i", "sub").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    live = (subs.join(materialize(shared, "shared"), ["i", "sub"]).groupBy("rep", "n_shingles")
            .agg(F.collect_list(F.when(F.col("i") < SUBS, F.struct("i", "sub"))).alias("a"),
                 F.collect_list(F.when(F.col("i") >= SUBS, F.struct("i", "sub"))).alias("b"))
            .where((F.size("a") > 0) & (F.size("b") > 0)))
    live = materialize(live, "live")
    bands = (live.withColumn("x", F.explode("a")).withColumn("y", F.explode("b"))
             .select(F.xxhash64("x.i", "y.i", "x.sub", "y.sub").alias("key"), "rep", F.col("n_shingles").alias("n")))
    stars = bands.groupBy("key").agg(F.min("rep").alias("u"), F.count("*").alias("members")).where("members > 1")
    stars = bands.join(materialize(stars, "buckets"), "key").where("rep <> u").select("u", F.col("rep").alias("v"), F.col("n").alias("n_v"))
    stars = materialize(stars.distinct(), "stars")
    ids = stars.select(F.explode(F.array("u", "v")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("stars"))
    ids = materialize(ids, "candidates").where("stars > 0")
    with settings(docs.sparkSession, RUNTIME_FILTER):
        sets = materialize(docs.join(ids, "doc_id", "left_semi").mapInArrow(_set_writer(k), "id long, grams array<long>"), "sets")

    # A shingle that only one candidate has is in no intersection; m = |set| - such shingles.
    # |intersection| <= m and |union| >= |set|, so a document with too small an m has no link.
    # An id may have several texts, so the set counts for itself (``t``): the id stays if one of them may link.
    keyed = sets.withColumn("t", F.xxhash64("id", "grams"))
    alone = (keyed.select("t", F.explode("grams").alias("g")).groupBy("g")
             .agg(F.count("*").alias("c"), F.min("t").alias("t")).where("c = 1").groupBy("t").agg(F.count("*").alias("alone")))
    able = (keyed.select("id", "t", F.size("grams").cast("long").alias("n")).distinct().join(alone, "t", "left")
            .select(F.col("id").alias("v"), F.col("n").alias("n_v"), (F.col("n") - F.coalesce("alone", F.lit(0))).alias("m"))
            .where(f"100 * m >= {percent} * n_v").select("v", "n_v").distinct())
    diffs = (stars.join(able, ["v", "n_v"])
             .join(sets.select(F.col("id").alias("u"), F.col("grams").alias("grams_u")), "u")
             .join(sets.select(F.col("id").alias("v"), F.col("grams").alias("grams_v")), "v")
             .select("u", "v", "grams_u", "grams_v").mapInArrow(_comparer(percent), DIFFS))
    diffs = materialize(diffs, "diffs")
    links = materialize(diffs.where("linked").select("u", "v").distinct(), "links")
    comp = materialize(connected_components(links, "u", "v"), "components")

    # Members of one centre in different components, compared through the centre:
    # |a & b| = |centre| - |lost_a | lost_b| + |new_a & new_b|.  The join tests this in its
    # condition, so it puts out links only, never the pairs.
    label = comp.select(F.col("node").alias("v"), F.col("component").alias("comp"))
    members = diffs.join(label, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    mixed = members.groupBy("u").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("u")
    members = materialize(members.join(mixed, "u", "left_semi").drop("linked"), "members")
    one, two = (members.select("u", "n_u", *[F.col(c).alias(f"{c}_{x}") for c in ("v", "comp", "n_v", "lost", "new")])
                .drop(*(["n_u"] if x == "b" else [])) for x in "ab")
    low = F.least("n_v_a", "n_v_b")
    both = F.col("n_u") - F.size(F.array_union("lost_a", "lost_b")) + F.size(F.array_intersect("new_a", "new_b"))
    most = F.col("n_u") - F.greatest(F.size("lost_a"), F.size("lost_b")) + F.least(F.size("new_a"), F.size("new_b"))

    def enough(shared):
        return 100 * shared >= percent * (F.col("n_v_a") + F.col("n_v_b") - shared)

    more = one.join(two, "u").where((F.col("v_a") < F.col("v_b")) & (F.col("comp_a") != F.col("comp_b"))
                                    & enough(low) & enough(most) & enough(both))
    return links.unionAll(more.select(F.col("v_a").alias("u"), F.col("v_b").alias("v")))
