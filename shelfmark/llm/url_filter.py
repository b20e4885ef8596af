"""URL filters by a sort-merge range join of canonical keys, in DataFrame functions only.

A host's canonical key is its labels in reverse, each followed by a dot (``blog.example.org`` ->
``org.example.blog.``), so a rule's host and all its subdomains are the keys that start with the rule's key: an
interval of the sort order.  Two sweeps over sorted keys find the rules of an url:

1. over hosts: which rule hosts' intervals hold the url's host (at most one a label);
2. over ``<rule host>/<path>``: which of such a host's rules have a path that the url's path starts with.

Intervals of prefixes are nested or apart.  So if ``q`` is a prefix of ``p`` and ``r`` is the last rule at or before
``p`` in sort order, ``q`` is a prefix of ``r`` too: the stack of rules active at ``p`` is that of ``r`` without those
that ended in between.  Every rule carries its stack (itself and the rules around it); the sweep takes the last one
seen and pops what is not a prefix of the point.

The sweep is distributed: rules and points are range-partitioned together by (key, hash), so a key with a third of
all rows spans many blocks; each block is swept alone, starting from the stack of the last rule of the blocks before
it (one row a block).  Blocks and row numbers are written before use, so a lost executor cannot change them.
Nothing is broadcast by hint and no rule is copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, prepare

AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _host_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): every rule host with the rule hosts around it, by equality on its label prefixes."""
    hosts = rules.select(host_key(F.col("host")).alias("key")).distinct()
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.")
    around = hosts.select(F.col("key").alias("inner"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("key"))
    return around.join(hosts, "key").groupBy(F.col("inner").alias("key")).agg(F.collect_list(F.struct("key")).alias("stack"))


def _path_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): every rule with the rules of the same host whose path its path starts with.

    Prefixes are taken at the path lengths that the host's rules have, so their number is bounded by the longest path.
    """
    lines = rules.select(host_key(F.col("host")).alias("line"), "host", "path", "verdict")
    lengths = lines.groupBy("line").agg(F.collect_set(F.length("path")).alias("lengths"))
    inner = lines.join(lengths, "line").select(
        F.concat("line", F.lit("/"), "path").alias("inner"), "line",
        F.explode(F.expr("transform(filter(lengths, n -> n <= length(path)), n -> left(path, n))")).alias("path"))
    entry = F.struct(F.concat("line", F.lit("/"), "path").alias("key"),
                     (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                     F.concat("host", "path").alias("rule"), "verdict")
    return inner.join(lines, ["line", "path"]).groupBy(F.col("inner").alias("key")).agg(F.collect_list(entry).alias("stack"))


def _sweep(points: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """``points`` (key and other columns) with ``row`` (a number) and ``active``: the stack at their key."""
    extra = [c for c in points.columns if c != "key"]
    stack = rules.schema["stack"].dataType
    rows = points.select("key", F.lit(1).alias("is_point"), F.lit(None).cast(stack).alias("stack"), F.struct(*extra).alias("point"))
    rows = rows.unionByName(rules.select("key", F.lit(0).alias("is_point"), "stack", F.lit(None).cast(rows.schema["point"].dataType).alias("point")))
    order = ["key", "is_point", "spread"]
    rows = rows.withColumn("spread", F.xxhash64("point")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.withColumn("block", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), name)
    # one row a block: the stack that the blocks before it leave
    ends = rows.groupBy("block").agg(F.expr("max_by(stack, key) FILTER (WHERE is_point = 0)").alias("end"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = materialize(ends.select("block", F.last("end", ignorenulls=True).over(before).alias("carried")), name + "_carried")
    seen = Window.partitionBy("block").orderBy("key", "is_point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.join(ends, "block").withColumn("now", F.coalesce(F.last("stack", ignorenulls=True).over(seen), F.col("carried")))
    active = F.coalesce(F.filter("now", lambda q: F.startswith(F.col("key"), q["key"])), F.array().cast(stack))
    return swept.where("is_point = 1").select("row", "key", "point.*", active.alias("active"))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url), by ``rules`` (host, path, verdict).

    A rule fits its host and all subdomains if the url's path starts with the rule's.  The longest rule (host and path
    together, on a tie the one with the longer host) gives ``rule`` (host and path) and ``verdict``; without one,
    ``rule`` is null and ``verdict`` is ``default``.  A rule's host has A-Z lowered too.  Rules with a null host or
    verdict take no part, a null path is empty; of rules equal in host and path, ``block`` holds.

    A null url and one without ``://`` have an empty host and path.  Every row of ``pages`` gives one row, also repeated
    ones and those with a null page_id; other columns of ``pages`` and ``rules`` are ignored, whatever their names.
    Empty ``rules`` leave the default, empty ``pages`` give no rows.
    """
    prepare(pages.sparkSession)
    rules = (rules.where("host IS NOT NULL AND verdict IS NOT NULL")
             .groupBy(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
             .agg(F.max_by("verdict", F.struct(F.col("verdict") == "block", "verdict")).alias("verdict")))
    rules = materialize(rules, "url_rules")
    points = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    points = points.select(host_key(F.col("host")).alias("key"), "page_id", "host", "path")
    by_host = materialize(_sweep(points, _host_stacks(rules), "url_hosts").select("row", "page_id", "host", "path", "active.key"), "url_rule_hosts")
    lines = by_host.select("row", "path", F.explode("key").alias("line"))
    lines = lines.select(F.concat("line", F.lit("/"), "path").alias("key"), F.col("row").alias("page_row"))
    fits = _sweep(lines, _path_stacks(rules), "url_paths").where("size(active) > 0").groupBy("page_row").agg(
        F.max(F.array_max(F.transform("active", lambda q: F.struct(q["length"], q["host_length"], q["rule"].alias("rule"), q["verdict"].alias("verdict"))))).alias("best"))
    return by_host.join(fits, F.col("row") == F.col("page_row"), "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
