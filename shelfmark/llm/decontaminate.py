"""Benchmark decontamination: size-partitioned MinHash containment search, exactly verified.

Items are partitioned by the size of their shingle set into classes (2**(c-1), 2**c].  For a
class, a document is covered by overlapping windows of three blocks of 2**(c-1) shingles, so an
item copied into a document of any length lies whole in some window of about its own size and
the containment turns into a Jaccard similarity of 0.25 or more.  With one row a band,
``FUNCTIONS`` minhashes miss such a window with probability 0.75**48 = 1e-6.  Block minima of
the small classes are combined into those of the larger ones, so each shingle is hashed once per
function.  Candidates are verified by the exact containment of the item's shingles in the whole
document.

An item of fewer words than a shingle has its whole word sequence as its one shingle and is looked
up among the documents' shingles of that length.

The benchmark is the query set: it goes through in blocks of about ``BLOCK_BYTES`` of text (or one longer
item), the only broadcast data.  The documents are scanned once per block and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare, with_defaults
from .kernels import U, codes, grams, slices, word_hashes, words

FUNCTIONS = 48
BLOCK_BYTES = 8 << 20
SCHEMA = "doc_id long, item_id long, n_shingles int, n_found int"


def _words(texts: pa.Array):
    """(first row, row count, word hashes, each row's first word) per slice."""
    for first, count, data, offs in slices(texts):
        starts, ends, at = words(data, offs)
        yield first, count, word_hashes(data, starts, ends, lower=True), at


def _shingles(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingles in text order and each row's first one; a row of fewer words has none."""
    every = grams(hashes, k)
    parts = [every[a:max(a, b - k + 1)] for a, b in zip(at[:-1], at[1:])]
    return np.concatenate(parts) if parts else every[:0], np.concatenate([[0], np.cumsum([len(p) for p in parts])])


class ItemBlock:
    """Shingle sets and minhashes of a block of items, by size class."""

    def __init__(self, ids: list[int], texts: list[str], k: int, percent: int):
        self.k, self.percent = k, percent
        self.ids, self.sets = [], []
        self.short: dict[int, dict[int, list[int]]] = {}  # number of words -> their hash -> ids
        for first, count, hashes, at in _words(pa.array(texts, pa.string())):
            for d in range(count):
                own = hashes[at[d]:at[d + 1]]
                if len(own) >= k:
                    self.ids.append(ids[first + d])
                    self.sets.append(np.unique(grams(own, k)))
                elif len(own):
                    self.short.setdefault(len(own), {}).setdefault(int(grams(own, len(own))[0]), []).append(ids[first + d])
        self.short_keys = {n: np.sort(np.array(list(table), U)) for n, table in self.short.items()}
        self.flips, self.factors = codes(FUNCTIONS, 21), codes(FUNCTIONS, 23) | U(1)
        self.classes = {}
        for c in sorted({int(len(s) - 1).bit_length() for s in self.sets}):
            which = np.array([i for i, s in enumerate(self.sets) if int(len(s) - 1).bit_length() == c])
            flat = np.concatenate([self.sets[i] for i in which])
            begin = np.concatenate([[0], np.cumsum([len(self.sets[i]) for i in which])[:-1]])
            keys = []
            for f in range(FUNCTIONS):
                low = np.minimum.reduceat((flat ^ self.flips[f]) * self.factors[f], begin)
                order = np.argsort(low, kind="stable")
                keys.append((low[order], which[order]))
            self.classes[c] = keys

    def candidates(self, flat: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs of one slice that share a minhash in some window."""
        found: set[tuple[int, int]] = set()
        size = np.diff(at)
        docs = np.flatnonzero(size)
        if not self.classes or not len(docs):
            return found
        # pad every document to whole blocks of the largest class; a window may run on into the
        # next document, which can only add a candidate
        top = 1 << max(max(self.classes) - 1, 0)
        blocks = -(-size[docs] // top)
        start = np.concatenate([[0], np.cumsum(blocks * top)])
        place = np.repeat(start[:-1] - at[:-1][docs], size[docs]) + np.concatenate([np.arange(at[d], at[d + 1]) for d in docs])
        owner = np.repeat(docs, blocks)
        source = np.concatenate([np.arange(at[d], at[d + 1]) for d in docs])
        padded = np.empty(start[-1], U)
        for f in range(FUNCTIONS):
            padded[:] = U(0xFFFFFFFFFFFFFFFF)
            padded[place] = (flat[source] ^ self.flips[f]) * self.factors[f]
            low, width = padded, 1
            for c, keys in self.classes.items():
                want = 1 << max(c - 1, 0)
                if want > width:
                    low = low.reshape(-1, want // width).min(axis=1)
                    width = want
                window = low.copy()
                if len(low) > 1:
                    window[:-1] = np.minimum(window[:-1], low[1:])
                if len(low) > 2:
                    window[:-2] = np.minimum(window[:-2], low[2:])
                key, item = keys[f]
                left = np.searchsorted(key, window, "left")
                for w in np.flatnonzero(key[np.minimum(left, len(key) - 1)] == window):
                    j = left[w]
                    while j < len(key) and key[j] == window[w]:
                        found.add((int(owner[w * width // top]), int(item[j])))
                        j += 1
        return found

    def matches(self, texts: pa.Array):
        """(row, item id, shingles of the item, those in the row's text) of the rows that hold an item."""
        for first, _, hashes, words_at in _words(texts):
            for n, keys in self.short_keys.items():
                every, starts = _shingles(hashes, words_at, n)
                where = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, every), len(keys) - 1)] == every)
                rows = np.searchsorted(starts, where, "right") - 1
                for d, key in sorted(set(zip(rows.tolist(), every[where].tolist()))):
                    for item in self.short[n][key]:
                        yield first + d, item, 1, 1
            flat, at = _shingles(hashes, words_at, self.k)
            by_doc: dict[int, list[int]] = {}
            for d, i in sorted(self.candidates(flat, at)):
                by_doc.setdefault(d, []).append(i)
            for d, items in by_doc.items():
                own = np.unique(flat[at[d]:at[d + 1]])
                for i in items:
                    item = self.sets[i]
                    hit = int(np.count_nonzero(own[np.minimum(np.searchsorted(own, item), len(own) - 1)] == item))
                    if 100 * hit >= self.percent * len(item):
                        yield first + d, self.ids[i], len(item), hit


def _searcher(shared, k: int, percent: int):
    def run(batches):
        block = ItemBlock(*shared.value, k, percent)
        for batch in batches:
            rows = list(block.matches(batch.column("text")))
            ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                 pa.array([r[3] for r in rows], pa.int32())], ["doc_id", "item_id", "n_shingles", "n_found"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_found) where the document holds the item.

    A document (doc_id, text) holds an item (item_id, text) if at least ``percent`` % of the
    item's distinct k-word shingles (A-Z in lower case) occur in its text; an item of fewer words
    has its whole word sequence as its one shingle.  Null texts, items without words and rows with a
    null doc_id or item_id take no part.  Repeated rows give one pair.  Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    docs = with_defaults(docs, {"doc_id": "long", "text": "string"}).where("doc_id IS NOT NULL")
    items = with_defaults(benchmark, {"item_id": "long", "text": "string"}).where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // BLOCK_BYTES))
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        rows = own.distinct().collect()  # one block of query items
        shared = spark.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))
        hits = docs.mapInArrow(_searcher(shared, k, percent), SCHEMA)
        if parts > 1:
            hits = materialize(hits, f"hits{part}")
        found = hits if found is None else found.unionAll(hits)
    return found.groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))
