"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contaminated
from .langid import identify
from .license_scan import TEMPLATES, license_scan
from .line_dedup import line_dedup
from .near_dup import minhash_near_duplicates
from .negatives import hard_negatives
from .oracle import ORACLE  # noqa: F401
from .pieces import encode_decode
from .pii import replace_pii
from .substring_dedup import substring_dedup
from .url_filter import url_filter
from .vectors import embedding_near_duplicates
from .warc import read_archives, resolve_revisits, write_archives
from .zone_clusters import zone_clusters

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PII_KEY = "registered query"  # a production run passes its own secret
# The rules of op13 (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def notices(spark: SparkSession) -> DataFrame:
    """The license notices and texts as a table (license_id, text)."""
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in TEMPLATES.items()])
    return spark.range(1).select(F.inline(rows))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(_table(spark, sf_dir, "documents"), MODEL)
    ids = F.concat_ws(",", F.col("piece_ids").cast("array<string>"))
    return out.select("doc_id", F.size("piece_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(_table(spark, sf_dir, "pages"), min_payload=0)
    return resolve_revisits(read_archives(manifest, payloads=False))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(_table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities", "entity_kinds")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"), notices(spark), k=5, percent=80)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"), MODEL)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=5, percent=80)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters(_table(spark, sf_dir, "embeddings"), k=16, dims=64, scale=64, rounds=3)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES])
    return url_filter(_table(spark, sf_dir, "pages"), spark.range(1).select(F.inline(rules)), default="allow")


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_line_dedup, op3_warc, op4_pii_surrogates, op5_minhash_near_dedup, op6_embedding_near_dedup,
    op7_license_scan, op8_language_id, op9_substring_dedup, op10_decontamination,
    op11_centroid_clustering, op12_hard_negatives, op13_url_filter)}
