"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes all that its predecessor kept.  All but the last return the columns of documents, also those
called like a stage's own; the last one's columns replace those of the same name.  Empty tables and null texts
pass: language ID drops documents with a null text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import materialize, prepare, unused
from shelfmark.llm.decontaminate import contaminated
from shelfmark.llm.langid import fit, held_out, predict
from shelfmark.llm.line_dedup import line_dedup
from shelfmark.llm.near_dup import minhash_near_duplicates
from shelfmark.llm.pieces import encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LEAST_SCORE = 0.5

ORACLE_SQL = None  # language ID and SentencePiece have no SQL form; tests compare with brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language: null texts, texts without letters, posterior under 0.5."""
    fitted = fit(docs.where(~held_out()).select("text", "lang"), MODEL)
    lang, score = (unused(docs.columns, c) for c in ("lang_pred", "score"))
    found = predict(docs, fitted, keep=docs.columns, names=(lang, score))
    return found.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated line chunks; drops documents of which nothing is left, and sets n_chars anew."""
    removed = unused(docs.columns, "lines_removed")
    cut = line_dedup(docs, removed)
    cut = cut.where((F.col(removed) == 0) | F.col("text").rlike(r"[^\s]"))
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of every near-duplicate group, with all its texts.

    Of rows equal in id and text, the one whose other columns sort first stays.
    """
    groups = minhash_near_duplicates(docs, k=5, percent=80)
    kept = groups.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.join(kept, "doc_id", "left_semi")
    one = one.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("rest")).select("doc_id", "text", "rest.*") if others else one.distinct()
    return one.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    hits = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = materialize(hits.select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds piece_ids, n_tokens and round_trip (do they decode to the very text?); own columns of these names are replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("piece_ids", "n_tokens", "round_trip")]
    decoded = unused(kept, "decoded")
    out = encode_decode(docs, MODEL, keep=kept, names=("piece_ids", decoded))
    same = F.col(decoded) == F.coalesce("text", F.lit(""))
    return out.select(*kept, "piece_ids", F.size("piece_ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
