"""Spark session defaults for the reports.

The reports are defined in UTC (``date(loan_date)``, ``timestamptz`` casts), so the
session time zone is pinned.  ANSI mode stays on: a bad cast raises instead of
silently producing NULL; values of the source documents are cast with ``try_cast`` and
those that do not parse are listed by the load.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every report relies on.
REPORT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables bucketed by instance also serve joins by (instance, item)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def apply_report_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the report semantics depend on (idempotent)."""
    for key, value in REPORT_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "shelfmark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REPORT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    A cluster names it in ``spark.checkpoint.dir``; it is only set here when it is
    unset (local tests), to a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shelfmark-ckpt-", dir=os.environ.get("SHELFMARK_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
        try:
            spark.sparkContext.setCheckpointDir(current)
        except Exception:  # no SparkContext access (Spark Connect): the conf is enough
            pass
    return current


def spread(df, *keys: str):
    """Spread an input over the session's shuffle partitions, round-robin or by ``keys`` (those of a join that follows).

    A scan has one task per file split; a source written as one large row group gives a
    single task however big the text is, and the documents built from it are far wider.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
