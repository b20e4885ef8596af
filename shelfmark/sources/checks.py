"""Checks of the load: one form of ids, values that do not parse, repeated ids."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial, reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.schemas import RAW_TABLES, TYPED_MEMBERS, UNIQUE_IDS

if TYPE_CHECKING:
    from shelfmark.sources.catalogue import Catalogue


class DuplicateIds(ValueError):
    """A table that is joined by its id holds an id twice, or none."""


def canonical_id(value: Column) -> Column:
    """The one form of a record id: lower case, without blanks around it."""
    return F.lower(F.trim(value))


def canonical_members(doc: Column, members: Iterable[str]) -> Column:
    """``doc`` with the named members (scalar, array of scalars, or ``array.member``) in canonical form."""
    whole = doc
    for name in members:
        array, _, inner = name.partition(".")
        value = doc.getField(array)
        if inner:
            value = F.transform(value, partial(_canonical_field, inner))
        elif name.endswith("Ids"):
            value = F.transform(value, canonical_id)
        else:
            value = canonical_id(value)
        whole = whole.withField(array, value)
    return whole


def _canonical_field(name: str, element: Column) -> Column:
    return element.withField(name, canonical_id(element.getField(name)))


def rejects(cat: Catalogue) -> DataFrame:
    """(table, id, member, text): values of typed members that do not parse, and documents that are no JSON (member ``$``).

    The text is the one in the document, also where the reader's schema has already turned it into NULL.
    """
    found = []
    for table in RAW_TABLES:
        raw = cat.raw(table).select(canonical_id(F.col("id")).alias("id"), "jsonb")
        broken = F.col("jsonb").isNotNull() & F.try_parse_json("jsonb").isNull()
        bad = [F.when(broken, F.struct(F.lit("$").alias("member"), F.col("jsonb").alias("text")))]
        for member, dtype in TYPED_MEMBERS.get(table, {}).items():
            text = F.get_json_object("jsonb", f"$.{member}")
            bad.append(F.when(text.isNotNull() & text.try_cast(dtype).isNull(), F.struct(F.lit(member).alias("member"), text.alias("text"))))
        found.append(raw.select(F.lit(table).alias("table"), "id", F.explode(F.array_compact(F.array(*bad))).alias("bad"))
                     .select("table", "id", "bad.member", "bad.text"))
    return reduce(DataFrame.unionByName, found)


def repeated_ids(cat: Catalogue) -> DataFrame:
    """(table, id, rows): ids that a table of ``UNIQUE_IDS`` holds more than once, and NULL ids."""
    counts = [cat.doc(t).groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1 OR id IS NULL").select(F.lit(t).alias("table"), "id", "rows")
              for t in UNIQUE_IDS]
    return reduce(DataFrame.unionByName, counts)


def require_unique_ids(cat: Catalogue, path: str) -> None:
    """Write the repeated ids to ``path`` and raise ``DuplicateIds`` if there are any."""
    repeated_ids(cat).write.mode("overwrite").parquet(path)
    per_table = {r["table"]: r["n"] for r in cat.spark.read.parquet(path).groupBy("table").agg(F.count("*").alias("n")).collect()}
    if per_table:
        raise DuplicateIds(f"repeated or missing ids, listed in {path}: " + ", ".join(f"{t} {n}" for t, n in sorted(per_table.items())))
