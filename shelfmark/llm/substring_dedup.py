"""Removal of long repeated word spans: sparse de Bruijn graph, compacted, verified at the source.

1. Anchors.  In every document the K-word shingles that are minimal among WINDOW - K + 1
   neighbours are kept (minimisers).  A window of WINDOW words has one smallest shingle, its own
   anchor, and equal windows have equal ones, so only windows whose own anchor occurs in two
   documents can repeat.
2. Graph.  Repeated anchors are the nodes; the word sequence from one anchor to the next is an
   edge (a token k-mer of varying length).  Node and edge counts come from aggregations.  An edge
   counted as often as both its ends is nonbranching: every occurrence of either end runs
   through it.  Joining those counts back compacts such edges into paths, whose
   every inner window has the occurrences of the path's nodes, hence one first document.
3. Verification.  A path occurrence is removed only if the sequence at its source coordinates
   (first document, same head, same length) has the same 128-bit sequence hash.
4. Windows that lie across path ends are compared one by one by a 128-bit hash of their words.

No step pairs occurrences with each other: all are aggregations per hash and joins with one
row per hash, so a passage in every third document costs its own length per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare, with_defaults
from .kernels import U, codes, grams, mix, slices, word_hashes, words

K = 15


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every run of ``width`` entries."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def anchors_of(hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One document's anchors (positions, hashes) and the hash of every window's own anchor.

    None if it has no full window.
    """
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U)
    g = grams(hashes, k)
    width = window - k + 1
    low = _slide(g, width, np.minimum)
    pad = np.zeros(width - 1, U)
    high = _slide(np.concatenate([pad, low, pad]), width, np.maximum)
    at = np.flatnonzero(g == high)
    return at, g[at], low


def _sums(hashes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers: the hash of words a..b-1 is (sum[b] - sum[a]) * inverse[a]."""
    base = int(codes(1, seed)[0]) | 1
    n = len(hashes)
    power = np.cumprod(np.concatenate([[U(1)], np.full(n, base, U)]), dtype=U)
    inverse = np.cumprod(np.concatenate([[U(1)], np.full(n, pow(base, -1, 1 << 64), U)]), dtype=U)
    return np.concatenate([[U(0)], np.cumsum(hashes * power[:n], dtype=U)]), inverse


def _span_hash(sums, a, b):
    total, inverse = sums
    return mix((total[b] - total[a]) * inverse[a] + (b - a).astype(U))


def _docs_of(batch, column="text"):
    """(row, word hashes, the text's bytes) of every row of a batch."""
    for first, count, data, offs in slices(batch.column(column)):
        starts, ends, at = words(data, offs)
        hashes = word_hashes(data, starts, ends, lower=False)
        for d in range(count):
            yield first + d, hashes[at[d]:at[d + 1]], data[offs[d]:offs[d + 1]].tobytes()


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int64), kind))


def _scanner(k: int, window: int):
    def run(batches):
        for batch in batches:
            sizes, shas, at, gram, edge = [], [], [], [], []
            for _, hashes, text in _docs_of(batch):
                pos, g, _ = anchors_of(hashes, k, window)
                e = np.zeros(len(pos), U)
                if len(pos) > 1:
                    e[:-1] = _span_hash(_sums(hashes, 3), pos[:-1], pos[1:] + k)
                sizes.append(len(hashes))
                shas.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                at.append(pos)
                gram.append(g.view(np.int64))
                edge.append(e.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 _lists(at, pa.int32()), _lists(gram, pa.int64()), _lists(edge, pa.int64())],
                ["doc_id", "tkey", "n_words", "sha", "pos", "gram", "edge"])
    return run


SCAN = "doc_id long, tkey long, n_words long, sha string, pos array<int>, gram array<long>, edge array<long>"
SPANS = ("doc_id long, tkey long, text string, win array<long>, win2 array<long>, win_at array<int>, head array<long>, "
         "h1 array<long>, h2 array<long>, run_at array<int>, run_len array<int>, first_doc array<long>")


def _spanner(k: int, window: int):
    """Path occurrences and boundary windows of the documents that hold repeated anchors."""
    def one(hashes, known):
        n = len(hashes)
        pos, g, own = anchors_of(hashes, k, window)
        at = np.fromiter((x["pos"] for x in known), np.int64, len(known))
        where = np.searchsorted(pos, at)
        count, first = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        solid = np.zeros(len(pos), bool)
        count[where] = [x["cnt"] for x in known]
        first[where] = [x["first_doc"] for x in known]
        solid[where] = [x["solid"] for x in known]
        chain = solid[:-1] & (count[:-1] == count[1:])  # nonbranching edge to the next anchor
        heads = np.flatnonzero((count > 0) & ~np.concatenate([[False], chain]))
        tails = np.flatnonzero((count > 0) & ~np.concatenate([chain, [False]]))
        run_at, run_end = pos[heads], pos[tails] + k
        # windows: only those whose own anchor is repeated, and that no path holds whole
        s = np.arange(n - window + 1)
        shared = np.unique(g[count > 0])
        open_ = shared[np.minimum(np.searchsorted(shared, own), len(shared) - 1)] == own
        inside = np.zeros(n + 2, np.int64)
        long_ = run_end - run_at >= window
        np.add.at(inside, run_at[long_], 1)
        np.add.at(inside, run_end[long_] - window + 1, -1)
        s = s[open_ & (np.cumsum(inside)[:len(s)] == 0)]
        big = np.flatnonzero(long_)
        one_, two = _sums(hashes, 3), _sums(hashes, 5)
        a, b = run_at[big], run_end[big]
        return (_span_hash(one_, s, s + window), _span_hash(two, s, s + window), s, g[heads][big], _span_hash(one_, a, b), _span_hash(two, a, b),
                a, b - a, first[heads][big])

    def run(batches):
        for batch in batches:
            known = batch.column("anchors").to_pylist()
            rows = [one(hashes, known[i]) for i, hashes, _ in _docs_of(batch)]
            if not rows:
                continue
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            cols = [_lists([np.asarray(r[c]).view(np.int64) for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), batch.column("text"), *cols],
                ["doc_id", "tkey", "text", "win", "win2", "win_at", "head", "h1", "h2", "run_at", "run_len", "first_doc"])
    return run


def _remover():
    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            removed, shas, merged = [], [], []
            for text, cuts in zip(batch.column("text"), spans):
                all_words = text.as_buffer().to_pybytes().split()
                kept, at, out = [], 0, []
                for start, length in sorted((c["start"], c["length"]) for c in cuts):
                    if out and start <= out[-1][0] + out[-1][1]:
                        out[-1][1] = max(out[-1][1], start + length - out[-1][0])
                    else:
                        out.append([start, length])
                for start, length in out:
                    kept += all_words[at:start]
                    at = start + length
                kept += all_words[at:]
                removed.append(len(all_words) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                merged.append([{"start": a, "length": b} for a, b in out])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(removed, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(merged, kind)], ["doc_id", "tkey", "removed", "cut_sha", "spans"])
    return run


def substring_dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """Words that repeat, in runs of ``window`` or more, from a document of smaller id.

    Returns one row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed,
    kept_sha256 (of the kept words joined by one space) and spans, the removed word ranges
    (start, length).  Texts are judged as they came in, not on what is left.  A null text has
    no words.  A row with a null doc_id is neither a source nor cut.  Rows that repeat a
    doc_id are not sources for each other.  Other columns are ignored.
    """
    if window < 2 * K:
        raise ValueError(f"window must be at least {2 * K} words")
    prepare(docs.sparkSession)
    docs = with_defaults(docs, {"doc_id": "long", "text": "string"}).withColumn("tkey", F.xxhash64("text"))
    scan = materialize(docs.mapInArrow(_scanner(K, window), SCAN), "anchors")

    nodes = scan.where("doc_id IS NOT NULL").select("doc_id", "tkey", F.inline(F.arrays_zip("pos", "gram", "edge")))
    shared = (nodes.groupBy("gram").agg(F.count("*").alias("cnt"), F.min("doc_id").alias("first_doc"),
                                        F.max("doc_id").alias("last_doc"))
              .where("first_doc < last_doc").drop("last_doc"))
    # An aggregate joined back to its own input shares its exchange, which AQE cannot split; written first, it can.
    nodes = materialize(nodes.join(materialize(shared, "shared"), "gram"), "nodes")
    edges = nodes.where("edge <> 0 AND cnt > 1").groupBy("edge").agg(F.count("*").alias("edge_cnt")).where("edge_cnt > 1")
    paths = (nodes.join(materialize(edges, "edges"), "edge", "left")
             .groupBy("doc_id", "tkey")
             .agg(F.sort_array(F.collect_set(F.struct(
                 "pos", "cnt", "first_doc", F.coalesce(F.expr("edge_cnt = cnt"), F.lit(False)).alias("solid")))).alias("anchors")))

    found = docs.join(paths, ["doc_id", "tkey"]).select("doc_id", "tkey", "text", "anchors")
    found = materialize(found.mapInArrow(_spanner(K, window), SPANS), "spans")

    runs = found.select("doc_id", "tkey", F.inline(F.arrays_zip("head", "h1", "h2", "run_at", "run_len", "first_doc")))
    source = (runs.where("doc_id = first_doc").select("head", "h1", "h2", "run_len", "first_doc").distinct())
    runs = (runs.where("doc_id > first_doc").join(source, ["head", "h1", "h2", "run_len", "first_doc"], "left_semi")
            .select("doc_id", "tkey", F.col("run_at").alias("start"), F.col("run_len").alias("length")))
    wins = found.select("doc_id", "tkey", F.inline(F.arrays_zip("win", "win2", "win_at")))
    low = (wins.groupBy("win", "win2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("win", "win2", "lo"))
    wins = (wins.join(materialize(low, "window_sources"), ["win", "win2"]).where("doc_id > lo")
            .select("doc_id", "tkey", F.col("win_at").alias("start"), F.lit(window).alias("length")))
    cuts = (runs.unionAll(wins).groupBy("doc_id", "tkey")
            .agg(F.collect_set(F.struct("start", "length")).alias("spans")))
    cut = (found.select("doc_id", "tkey", "text").join(cuts, ["doc_id", "tkey"])
           .select("doc_id", "tkey", "text", "spans")
           .mapInArrow(_remover(), "doc_id long, tkey long, removed long, cut_sha string, "
                                   "spans array<struct<start: int, length: int>>")
           .dropDuplicates(["doc_id", "tkey"]))
    out = scan.select("doc_id", "tkey", "n_words", "sha").join(cut, ["doc_id", "tkey"], "left")
    return out.select("doc_id", "n_words", F.coalesce("removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("cut_sha", "sha").alias("kept_sha256"),
                      F.coalesce("spans", F.expr("array()")).alias("spans"))
