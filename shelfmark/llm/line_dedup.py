"""Removal of multi-line chunks that repeat anywhere in the corpus.

1. A rolling hash (128 bits, of the hashes of ``SEED`` neighbouring lines; blank lines are passed over) is taken at every
   line.  It depends on its own lines only, so an insertion shifts no hash behind it.
2. Rolling hashes that occur more than once, and each one's first occurrence (smallest doc_id, then text and position),
   come from one aggregation.
3. A chunk is a longest run of lines whose rolling hashes all repeat and follow a run of first occurrences; its boundaries
   are where that ends.  So every repeated run of ``SEED`` lines or more is a chunk or part of one, wherever it lies.
4. The bytes of the chunks' first occurrences are cut from their documents and sent to the chunks; a chunk whose own bytes
   are the same is removed, with the blank lines inside it.  The first occurrence stays.

Only first occurrences' documents and the final rewriting read texts again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, unused
from .kernels import U, codes, mix

SEED = 2
BASES = codes(2, 31) | U(1)
MOST_ROWS, MOST_BYTES = 1 << 16, 8 << 20  # of a batch that a task puts out
BLANK = b" \t\n\v\f\r"


def solid_lines(lines: list[bytes]) -> list[int]:
    """Places of the lines that are not blank."""
    return [i for i, line in enumerate(lines) if line.strip(BLANK)]


def rolling(lines: list[bytes]) -> np.ndarray:
    """The rolling hash of every ``SEED`` neighbouring lines, as two 64-bit numbers each."""
    digests = np.frombuffer(b"".join([hashlib.md5(line).digest() for line in lines]), U).reshape(-1, 2)
    count = max(0, len(lines) - SEED + 1)
    out = np.zeros((count, 2), U)
    for i in range(SEED):
        out = out * BASES + digests[i:i + count]
    return mix(out)


def _scan(batches):
    names, kinds = ["doc_id", "tkey", "at", "h1", "h2"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def table(parts):
        whole = [np.concatenate([p[i] for p in parts]) for i in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(whole, kinds)], names)

    for batch in batches:
        parts, size = [], 0
        for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("tkey").to_pylist(), batch.column("text")):
            if not text.is_valid:
                continue
            lines = text.as_buffer().to_pybytes().split(b"\n")
            values = rolling([lines[i] for i in solid_lines(lines)]).view(np.int64)
            n = len(values)
            parts.append((np.full(n, doc, np.int64), np.full(n, key, np.int64), np.arange(n, dtype=np.int32), values[:, 0], values[:, 1]))
            size += n
            if size >= MOST_ROWS:
                yield table(parts)
                parts, size = [], 0
        if parts:
            yield table(parts)


def _bodies(batches):
    """The bytes of the listed runs of lines that are not blank."""
    names = ["head_doc", "head_key", "head_at", "n", "body"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        rows, size = [], 0
        for doc, key, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("tkey").to_pylist(), batch.column("text"), batch.column("wanted")):
            lines = text.as_buffer().to_pybytes().split(b"\n")
            solid = [lines[i] for i in solid_lines(lines)]
            for w in wanted.as_py():
                rows.append((doc, key, w["at"], w["n"], b"\n".join(solid[w["at"]:w["at"] + w["n"]])))
                size += len(rows[-1][4])
                if size >= MOST_BYTES:
                    yield table(rows)
                    rows, size = [], 0
        if rows:
            yield table(rows)


def without_chunks(text: str, chunks: list[dict]) -> tuple[str, int]:
    """``text`` without the chunks (at, n, shared, body) whose lines are the body, and the number of lines removed.

    ``shared``: the chunk overlaps its own first occurrence by all but its last lines; the first line and blank ones stay.
    """
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    solid = solid_lines(lines)
    gone: set[int] = set()
    for c in chunks:
        mine = solid[c["at"]:c["at"] + c["n"]]
        if b"\n".join([lines[i] for i in mine]) == c["body"]:
            gone.update(mine[1:] if c["shared"] else range(mine[0], mine[-1] + 1))
    return b"\n".join([x for i, x in enumerate(lines) if i not in gone]).decode("utf-8", "surrogatepass"), len(gone)


def _rebuild(column: str, cuts_column: str, removed_column: str):
    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for text, cuts in zip(batch.column(column), batch.column(cuts_column)):
                text, count = without_chunks(text.as_py(), cuts.as_py()) if cuts.is_valid else (text.as_py(), 0)
                texts.append(text)
                removed.append(count)
            out = batch.drop_columns([cuts_column])
            out = out.set_column(out.schema.get_field_index(column), column, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(removed, pa.int32())], [*out.schema.names, removed_column])
    return run


def line_dedup(docs: DataFrame, removed: str = "lines_removed") -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...), text without repeated chunks, plus the lines removed, called ``removed``.

    Every row gives one row.  A null text stays null; an empty one stays empty.  A row with a
    null doc_id stays as it is and counts for nothing.  Rows that repeat both doc_id and text
    are one document.  Lines end at line feeds; blank lines are compared with nothing.  A column called
    ``removed`` is replaced; other columns pass through, whatever their names.
    """
    prepare(docs.sparkSession)
    docs = docs.drop(removed)
    doc, key, cuts = (unused(docs.columns, c) for c in ("cut_doc", "cut_key", "cuts"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), F.col("text").cast("string").alias("text"))
    slim = slim.where("doc_id IS NOT NULL")
    seeds = materialize(slim.mapInArrow(_scan, "doc_id long, tkey long, at int, h1 long, h2 long"), "seeds").distinct()
    heads = (seeds.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "tkey", "at")).alias("head"))
             .where("times > 1").select("h1", "h2", F.col("head.doc_id").alias("head_doc"), F.col("head.tkey").alias("head_key"), F.col("head.at").alias("head_at")))
    again = (seeds.join(materialize(heads, "heads"), ["h1", "h2"])
             .where("NOT (doc_id = head_doc AND tkey = head_key AND at = head_at)").drop("h1", "h2"))
    # chunks: neighbouring seeds whose first occurrences are neighbours too
    line = ["doc_id", "tkey", "head_doc", "head_key", "shift"]
    again = again.withColumn("shift", F.col("at") - F.col("head_at"))
    again = again.withColumn("island", F.col("at") - F.row_number().over(Window.partitionBy(*line).orderBy("at")))
    chunks = (again.groupBy(*line, "island").agg(F.min("at").alias("at"), F.min("head_at").alias("head_at"), (F.count("*") + SEED - 1).cast("int").alias("n"))
              .drop("island"))
    chunks = materialize(chunks, "chunks")

    wanted = (chunks.select("head_doc", "head_key", F.struct(F.col("head_at").alias("at"), "n").alias("run")).distinct()
              .groupBy(F.col("head_doc").alias("doc_id"), F.col("head_key").alias("tkey")).agg(F.collect_list("run").alias("wanted")))
    # the head texts only; merged, so that the plan and its disk use do not change where the list outgrows a broadcast
    sources = slim.join(materialize(wanted, "wanted").hint("merge"), ["doc_id", "tkey"]).select("doc_id", "tkey", "text", "wanted")
    bodies = sources.mapInArrow(_bodies, "head_doc long, head_key long, head_at int, n int, body binary")
    bodies = materialize(bodies.dropDuplicates(["head_doc", "head_key", "head_at", "n"]), "bodies")
    own = (F.col("doc_id") == F.col("head_doc")) & (F.col("tkey") == F.col("head_key"))
    found = (chunks.join(bodies, ["head_doc", "head_key", "head_at", "n"])
             .groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("at", "n", (own & (F.col("shift") < SEED)).alias("shared"), "body")).alias(cuts))
             .select(F.col("doc_id").alias(doc), F.col("tkey").alias(key), cuts))
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64("text") == F.col(key))
    rows = docs.join(materialize(found, "found").hint("merge"), same, "left").drop(doc, key)
    fields = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in docs.schema.fields]
    return rows.mapInArrow(_rebuild("text", cuts, removed), T.StructType(fields + [T.StructField(removed, T.IntegerType())]))
