"""Shared folder, materialised tables and session settings for the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch.  Texts are long, so batches are small: a batch of 512 texts of a
# few kB is about 2 MB in the worker.
ARROW_ROWS = 512

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators (idempotent)."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside the block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a fresh scratch folder only on a local master."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shelfmark-llm-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_defaults(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select just ``columns`` (name -> type), so extra or clashing columns cannot interfere."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (Spark compares without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
