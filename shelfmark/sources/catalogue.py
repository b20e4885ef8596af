"""Catalogue: the raw document tables, parsed documents (S1) and flattened tables (F1).

A raw table is ``(id, <promoted key columns>, jsonb STRING)``.  ``doc(name)`` is the
document parsed with the explicit schema of :mod:`shelfmark.sources.schemas`;
``flat(name)`` is the ``__t`` form (members promoted to snake_case columns);
``derived(name)`` is one of the derived tables D1-D11.

Storage levels.  A catalogue built straight from raw tables computes every level on
the fly (JSON is parsed in each plan).  :meth:`materialize` writes the three levels as
Parquet -- parsed documents as nested structs, flattened tables, derived tables -- the
way the source system keeps them, so that reports:

* never re-parse JSON (the parse happens once, at load);
* read only the nested members they use (Parquet nested-column pruning);
* push call-number, date and barcode predicates into the Parquet scan.

:meth:`cached` keys a materialised copy by input location, input file sizes and the
library's source, under the shared folder named by ``spark.checkpoint.dir``; a second
call (any process) reuses it.  Writing to that folder also cuts the lineage of the
derivation, so a lost executor recomputes from Parquet, not from the test tables.

The load also checks its input (:mod:`shelfmark.sources.checks`): ids and references are
brought to one form, values that do not parse become NULL and are listed in a rejects table
beside the levels, and a repeated id in a table that is joined by it stops the load.

Instances, holdings, items and loans are stored bucketed by the instance they belong to, so
the joins among them need no shuffle (see ``BUCKETED``).

A single query need not pay for the whole load: :meth:`on_demand` reads the materialised copy
when there is one, and otherwise computes from the raw tables only what the query asks for.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources import checks
from shelfmark.sources.schemas import ID_MEMBERS, RAW_TABLES, TYPED_MEMBERS

# Tables whose flattened ``__t`` form is kept.
FLAT_TABLES = ("holdings_record", "item", "location", "loccampus", "loclibrary", "service_point",
               "material_type", "loan_type", "statistical_code", "item_note_type", "loan")

LEVELS = ("doc", "flat", "derived", "index")

# Stored layout: tables the reports filter by a range are range-partitioned and sorted
# on that column, so Parquet file and row-group statistics skip what is out of range
# (call-number ranges in R1, loan-date ranges in R3/R6, barcode lookup in R8).  The id
# behind it splits a frequent or NULL value over several ranges.
LAYOUT = {
    "flat/item": ("barcode", "id"),
    "derived/items_holdings_instances": ("call_number", "item_id"),
    "derived/loans_items": ("loan_date", "loan_id"),
}

# Tables bucketed by instance: (bucket column, columns that a bucket's file is sorted by, for its page statistics).
# The bucket count is the session's shuffle partitions at load, and a bucket is one file.  Items and loans carry their
# instance's id for this.  A bucket is read by one task, so a table in which one bucket holds more than
# ``MOST_IN_BUCKET`` times the mean (one instance with very many items or loans) is stored without buckets;
# its joins then shuffle, and AQE splits the hot key.
BUCKETED = {
    "doc/instance": ("id", ("id",)),
    "doc/holdings_record": ("instanceid", ("instanceid", "id")),
    "doc/item": ("instance_id", ("instance_id", "id")),
    "doc/loan": ("instance_id", ("instance_id", "id")),
    "flat/holdings_record": ("instance_id", ("call_number", "id")),
    "flat/loan": ("instance_id", ("loan_date", "id")),
}
MOST_IN_BUCKET = 4
LEAST_TO_MEASURE = 10_000  # rows; smaller tables have uneven buckets by chance and fit in one task anyway


def snake(name: str) -> str:
    """camelCase -> snake_case (``permanentLocationId`` -> ``permanent_location_id``)."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _jvm_available(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jvm is not None
    except Exception:  # Spark Connect: no driver JVM in this process
        return False


def _read_text(spark: SparkSession, path: str) -> str | None:
    if not _jvm_available(spark):
        local = path.removeprefix("file:")
        return open(local).readline().strip() if os.path.exists(local) else None
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def _write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    if not _jvm_available(spark):
        local = path.removeprefix("file:")
        tmp = f"{local}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "w") as fh:
            fh.write(text)
        os.replace(tmp, local)
        return
    fs, p = _hadoop_fs(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    # One step that replaces the file, so that a reader never finds it missing.
    jvm = spark.sparkContext._jvm
    modes = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    modes[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), modes)


def _source_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    if _jvm_available(spark):
        fs, p = _hadoop_fs(spark, sf_dir)
        files, found = fs.listFiles(p, True), []  # a table may be a folder of files
        while files.hasNext():
            status = files.next()
            found.append(f"{status.getPath().toString()}:{status.getLen()}:{status.getModificationTime()}")
        for line in sorted(found):
            h.update(line.encode())
    else:
        for root, _, names in sorted(os.walk(sf_dir)):
            for name in sorted(names):
                st = os.stat(os.path.join(root, name))
                h.update(f"{root}/{name}:{st.st_size}:{int(st.st_mtime * 1000)}".encode())
    # The stored levels depend on the source, derived-table and text-function definitions.
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for root, _, files in sorted(w for d in ("sources", "plans", "functions") for w in os.walk(os.path.join(pkg, d))):
        for name in sorted(files):
            if name.endswith(".py"):
                with open(os.path.join(root, name), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:16]


class Catalogue:
    """Named raw tables plus their parsed, flattened and derived views (all lazy)."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame] | None,
                 stored: str | None = None, levels: tuple[str, ...] = LEVELS):
        if raw is not None:
            missing = set(RAW_TABLES) - set(raw)
            if missing:
                raise ValueError(f"raw tables missing: {sorted(missing)}")
        self.spark = spark
        self._raw = dict(raw or {})
        self.stored = stored
        self.levels = levels if stored else ()
        self._readers: dict[str, DataFrame] = {}
        self._kept: dict[str, DataFrame] = {}  # parsed documents stored for one query's several reads
        self._kept_index: Callable | None = None
        self.buckets: dict[str, int] = json.loads((stored and _read_text(spark, f"{stored}/BUCKETS")) or "{}")

    def _read(self, rel: str) -> DataFrame:
        # One reader per stored table: the file listing and footer read happen once.
        if rel not in self._readers:
            df = self.spark.read.parquet(f"{self.stored}/{rel}")
            if rel in self.buckets:
                # Bucketing is known to tables only: name the folder as an external table of this session.
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table(rel)} ({columns}) USING parquet CLUSTERED BY (`{BUCKETED[rel][0]}`) "
                               f"INTO {self.buckets[rel]} BUCKETS LOCATION '{self.stored}/{rel}'")
                df = self.spark.table(self._table(rel))
            self._readers[rel] = df
        return self._readers[rel]

    def _table(self, rel: str) -> str:
        return f"shelfmark_{hashlib.sha1(self.stored.encode()).hexdigest()[:12]}_{rel.replace('/', '_')}"

    @property
    def colocated(self) -> bool:
        """Instances, holdings and items are bucketed alike: join items by (instance_id, holdings_id) to use it."""
        return {"doc/instance", "doc/holdings_record", "flat/holdings_record", "doc/item"} <= set(self.buckets) and {"doc", "flat"} <= set(self.levels)

    @property
    def loans_colocated(self) -> bool:
        """So are loans: join them by (instance_id, item_id)."""
        return self.colocated and {"doc/loan", "flat/loan"} <= set(self.buckets)

    # -- construction -------------------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, every_loan: bool = False) -> "Catalogue":
        """Catalogue derived from the driver's TPC-H-like tables (see ``fixture``)."""
        from shelfmark.sources.fixture import build_raw_tables

        return cls(spark, build_raw_tables(spark, sf_dir, every_loan))

    @classmethod
    def from_stored(cls, spark: SparkSession, path: str, levels: tuple[str, ...] = LEVELS) -> "Catalogue":
        """Catalogue whose levels were written by :meth:`materialize` under ``path``."""
        return cls(spark, None, stored=path, levels=levels)

    @classmethod
    def cached(cls, spark: SparkSession, sf_dir: str) -> "Catalogue":
        """Materialised catalogue for a test-data directory, built on first use."""
        from shelfmark.session import checkpoint_dir

        base = f"{checkpoint_dir(spark).rstrip('/')}/shelfmark-catalogue/{_source_fingerprint(spark, sf_dir)}"
        current = _read_text(spark, f"{base}/CURRENT")
        if current:
            return cls.from_stored(spark, f"{base}/{current}")
        attempt = uuid.uuid4().hex[:12]
        stored = cls.from_testdata(spark, sf_dir).materialize(f"{base}/{attempt}")
        _write_text_atomic(spark, f"{base}/CURRENT", attempt)
        return stored

    @classmethod
    def on_demand(cls, spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> "Catalogue":
        """Catalogue for one query: the materialised copy if there is one, else only what the query reads.

        Without a copy every level is computed from the raw tables within the query's own plan.  The documents of the
        tables in ``keep``, which the query reads several times, are parsed once and stored; so is the subject index
        (``keep`` holds ``index``).  Stored parts are shared by later queries.  Ids are checked as in a load.
        """
        from shelfmark.session import checkpoint_dir

        base = f"{checkpoint_dir(spark).rstrip('/')}/shelfmark-catalogue/{_source_fingerprint(spark, sf_dir)}"
        current = _read_text(spark, f"{base}/CURRENT")
        if current:
            return cls.from_stored(spark, f"{base}/{current}")
        out = cls.from_testdata(spark, sf_dir)

        def part(name: str, build: Callable[[str], object]) -> str:
            """The folder of a part that is complete; ``build`` fills a new one if there is none."""
            attempt = _read_text(spark, f"{base}/parts/{name}/CURRENT")
            if not attempt:
                attempt = uuid.uuid4().hex[:12]
                build(f"{base}/parts/{name}/{attempt}")
                _write_text_atomic(spark, f"{base}/parts/{name}/CURRENT", attempt)
            return f"{base}/parts/{name}/{attempt}"

        part("ids", lambda path: checks.require_unique_ids(out, path))
        for name in (k for k in keep if k != "index"):
            out._kept[name] = spark.read.parquet(part(f"doc/{name}", out.doc(name).write.mode("overwrite").parquet))
        if "index" in keep:
            def write_index(df: DataFrame, name: str, order: list[str] | None) -> DataFrame:
                df = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order) if order else df
                return spark.read.parquet(part(f"index/subject_{name}", df.write.mode("overwrite").parquet))

            out._kept_index = write_index
        return out

    def materialize(self, path: str) -> "Catalogue":
        """Write parsed documents, flattened tables, derived tables and the subject index under ``path``.

        Each level is computed from the level written before it, so every job reads
        Parquet rather than re-deriving from its inputs.  Raises ``DuplicateIds`` if a table that is
        joined by its id repeats one; values that do not parse are listed in ``rejects``.
        """
        from shelfmark.plans.derived import DERIVED

        # Range-partitioned tables get an explicit partition count (the session's shuffle
        # partitions, sized for the cluster): otherwise AQE may coalesce a small table into
        # one file, and every later plan that streams it runs in a single task.
        ranges = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = Catalogue(self.spark, None, stored=path)  # levels appear in it as they are written
        buckets: dict[str, int] = {}

        def write(df: DataFrame, rel: str) -> None:
            if rel in BUCKETED:
                column, order = BUCKETED[rel]
                if self._even(df, column, ranges):
                    # one file a bucket: hash partitioning and bucketing agree
                    df = df.repartition(ranges, column).sortWithinPartitions(*order)
                    (df.write.mode("overwrite").format("parquet").bucketBy(ranges, column)
                     .option("path", f"{path}/{rel}").saveAsTable(out._table(rel)))
                    buckets[rel] = ranges
                    return
                df = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
            columns = LAYOUT.get(rel)
            if columns:
                df = df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
            df.write.mode("overwrite").parquet(f"{path}/{rel}")

        def write_all(jobs: dict[str, Callable[[], DataFrame]]) -> None:
            # The tables of one level are independent Spark jobs: submit them together so
            # the scheduler interleaves their tasks instead of running them one by one.
            with ThreadPoolExecutor(max_workers=min(8, len(jobs))) as pool:
                for future in [pool.submit(lambda r=rel, b=build: write(b(), r)) for rel, build in jobs.items()]:
                    future.result()

        # Items and loans get the id of their instance from the table written before them.
        write_all({f"doc/{name}": (lambda n=name: self.doc(n)) for name in RAW_TABLES if name not in ("item", "loan")})
        docs = Catalogue.from_stored(self.spark, path, levels=("doc",))
        holdings = docs.doc("holdings_record").select(F.col("id").alias("holdingsrecordid"), F.col("instanceid").alias("instance_id"))
        write_all({"doc/item": lambda: self.doc("item").join(holdings, "holdingsrecordid", "left")})
        docs = Catalogue.from_stored(self.spark, path, levels=("doc",))
        items = docs.doc("item").select(F.col("id").alias("item_id"), "instance_id")
        write_all({"doc/loan": lambda: self.doc("loan").withColumn("item_id", F.col("j.itemId")).join(items, "item_id", "left").drop("item_id"),
                   "rejects": lambda: checks.rejects(self)})
        checks.require_unique_ids(docs, f"{path}/duplicate_ids")

        def reopen(*levels: str) -> Catalogue:
            _write_text_atomic(self.spark, f"{path}/BUCKETS", json.dumps(buckets))
            return Catalogue.from_stored(self.spark, path, levels=levels)

        docs = reopen("doc")
        write_all({f"flat/{name}": (lambda n=name: docs.flat(n)) for name in FLAT_TABLES})
        flats = reopen("doc", "flat")
        write_all({f"derived/{name}": (lambda j=job: j(flats)) for name, job in DERIVED.items()})

        def write_index(df: DataFrame, name: str, order: list[str] | None) -> DataFrame:
            df = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order) if order else df
            write(df, f"index/subject_{name}")
            return self.spark.read.parquet(f"{path}/index/subject_{name}")

        flats.subject_index(write_index)
        return reopen(*LEVELS)

    @staticmethod
    def _even(df: DataFrame, column: str, buckets: int) -> bool:
        """Would no bucket hold much more than its share?  One row a bucket reaches the driver."""
        counts = [r["n"] for r in df.groupBy(F.pmod(F.hash(column), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n")).collect()]
        return sum(counts) < LEAST_TO_MEASURE or max(counts) <= MOST_IN_BUCKET * sum(counts) / buckets

    def computed(self) -> "Catalogue":
        """Same documents, but flattened and derived tables computed instead of read."""
        if self.stored:
            return Catalogue.from_stored(self.spark, self.stored, levels=("doc",))
        return self

    # -- access ---------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        if name in self._raw:
            return self._raw[name]
        keys, _ = RAW_TABLES[name]
        return self.doc(name).select("id", *keys, F.to_json("j").alias("jsonb"))

    def doc(self, name: str) -> DataFrame:
        """``id``, promoted keys and ``j`` = the parsed document (S1), ids and references in canonical form.

        Stored items and loans also have ``instance_id``.
        """
        if "doc" in self.levels:
            return self._read(f"doc/{name}")
        if name in self._kept:
            return self._kept[name]
        keys, schema = RAW_TABLES[name]
        parsed = self._raw[name].select(*[checks.canonical_id(F.col(c)).alias(c) for c in ("id", *keys)], F.from_json("jsonb", schema).alias("j"))
        return parsed.withColumn("j", checks.canonical_members(F.col("j"), ID_MEMBERS.get(name, ())))

    def rejects(self) -> DataFrame:
        """(table, id, member, text) of the values that did not parse (read when stored, else computed)."""
        return self.spark.read.parquet(f"{self.stored}/rejects") if self.stored else checks.rejects(self)

    def flat(self, name: str) -> DataFrame:
        """The ``__t`` table: document members as snake_case columns (F1).

        Scalars keep their name, members of a nested object are prefixed with the
        object's name (``status.name`` -> ``status_name``), arrays stay arrays.
        """
        if "flat" in self.levels and name in FLAT_TABLES:
            return self._read(f"flat/{name}")
        _, schema = RAW_TABLES[name]
        stamps = [m for m, t in TYPED_MEMBERS.get(name, {}).items() if t == "timestamp"]
        cols = [F.col("id")]
        for field in schema.fields:
            member = F.col("j").getField(field.name)
            if isinstance(field.dataType, T.StructType):
                for sub in field.dataType.fields:
                    cols.append(member.getField(sub.name).alias(f"{snake(field.name)}_{snake(sub.name)}"))
            elif field.name in stamps:
                cols.append(member.try_cast("timestamp").alias(snake(field.name)))
            else:
                cols.append(member.alias(snake(field.name)))
        doc = self.doc(name)
        if name == "loan" and "instance_id" in doc.columns:
            cols.append(F.col("instance_id"))
        return doc.select(*cols)

    def derived(self, name: str) -> DataFrame:
        """Derived table D1-D11 by name (read when stored, else computed)."""
        if "derived" in self.levels:
            return self._read(f"derived/{name}")
        from shelfmark.plans.derived import DERIVED

        return DERIVED[name](self)

    def subject_index(self, write=None):
        """FT1's index over the subject text of every instance, 'english' (read when stored, else computed).

        The text is the one the reports search: subject values, brackets and quotes removed; '' without subjects.
        An instance whose whole document is NULL is no document of the index.
        """
        from shelfmark.functions.json_text import array_member_text
        from shelfmark.plans.text_index import TextIndex

        if "index" in self.levels:
            return TextIndex("instance_id", "english", self._read("index/subject_documents"), self._read("index/subject_postings"))
        docs = self.doc("instance").select(F.col("id").alias("instance_id"), F.when(
            F.col("j").isNotNull(), array_member_text(F.col("j.subjects"), "value")).alias("subjects_text"))
        write = write or self._kept_index
        return TextIndex.build(docs, "instance_id", F.col("subjects_text"), "english", *([write] if write else []))
