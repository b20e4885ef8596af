"""Per-title and per-item templates T1-T11.

Most templates aggregate the elements of one document array per record.  Because a
record's array is already in one row, they are array passes (``transform`` /
``array_join``) with no shuffle -- equal to the element-expansion + GROUP BY form as
long as record ids are unique, which the load checks.  Aggregation order is
array order.  Records whose array is missing or empty produce no row, as an
element-expansion join does.

T4/T5 expand code ids and look the names up (broadcast-size lookup).  T6 counts loans
per item (partial aggregation before the shuffle, then a semi-join with items).  T7
joins note types, so it expands notes, looks the type up and aggregates per item in array order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.joins import expand
from shelfmark.sources.catalogue import Catalogue

STAFF_NOTE_NAME = "Staff Note"


def _nonempty(arr: Column) -> Column:
    return F.coalesce(F.size(arr) > 0, F.lit(False))


def string_agg(values: Column) -> Column:
    """``string_agg(v, ', ')`` over an array: NULLs skipped, NULL when nothing is left."""
    return F.when(F.exists(values, lambda v: v.isNotNull()), F.array_join(values, ", "))


def _first_member(cat: Catalogue, array: str, member: str, alias: str) -> DataFrame:
    arr = F.col(f"j.{array}")
    return (cat.doc("instance").filter(_nonempty(arr))
            .select(F.col("id").alias("instance_id"), F.get(arr, 0).getField(member).alias(alias)))


def _all_members(cat: Catalogue, array: str, member: str, alias: str) -> DataFrame:
    arr = F.col(f"j.{array}")
    return (cat.doc("instance").filter(_nonempty(arr))
            .select(F.col("id").alias("instance_id"),
                    string_agg(F.transform(arr, lambda x: x.getField(member))).alias(alias)))


def primary_author(cat: Catalogue) -> DataFrame:
    """Name of the first contributor (NULL if that element has no name)."""
    return _first_member(cat, "contributors", "name", "author")


def authors(cat: Catalogue) -> DataFrame:
    """All contributor names joined by ', '."""
    return _all_members(cat, "contributors", "name", "authors")


def identifiers(cat: Catalogue) -> DataFrame:
    """All identifier values joined by ', '."""
    return _all_members(cat, "identifiers", "value", "identifiers")


def _code_names(cat: Catalogue, table: str, key: str, alias: str) -> DataFrame:
    codes = cat.doc(table).select(F.col("id").alias(key), F.col("j.statisticalCodeIds").alias("codes"))
    codes = expand(codes, "codes", "pos", "code_id")
    names = cat.flat("statistical_code").select(F.col("id").alias("code_id"), F.col("name").alias(alias))
    return codes.join(names, "code_id").select(key, alias)


def instance_stat_codes(cat: Catalogue) -> DataFrame:
    """T4: one row per statistical code of each instance."""
    return _code_names(cat, "instance", "instance_id", "instance_stat_codes")


def item_stat_codes(cat: Catalogue) -> DataFrame:
    """T5: one row per statistical code of each item."""
    return _code_names(cat, "item", "item_id", "item_stat_code")


def item_checkouts(cat: Catalogue) -> DataFrame:
    """Number of loans of every item that has at least one."""
    per_item = (cat.flat("loan").groupBy("item_id").agg(F.count("id").alias("checkouts")))
    items = cat.doc("item").select(F.col("id").alias("item_id"))
    return per_item.join(items, "item_id", "left_semi").select("item_id", "checkouts")


def item_notes(cat: Catalogue) -> DataFrame:
    """All notes of known type joined by ', ', and the staff notes among them."""
    notes = expand(cat.doc("item").select(F.col("id").alias("item_id"), F.col("j.notes").alias("notes")), "notes", "pos", "n")
    notes = notes.select("item_id", "pos", F.col("n.itemNoteTypeId").alias("type_id"), F.col("n.note").alias("note"))
    types = cat.flat("item_note_type").select(F.col("id").alias("type_id"), F.col("name").alias("type_name"))
    in_order = "listagg(note, ', ') WITHIN GROUP (ORDER BY pos)"
    return notes.join(types, "type_id").groupBy("item_id").agg(
        F.expr(in_order).alias("notes"),
        F.expr(f"{in_order} FILTER (WHERE type_name = '{STAFF_NOTE_NAME}')").alias("staff_notes"))


def primary_publisher(cat: Catalogue) -> DataFrame:
    """Publisher of the first publication statement."""
    return _first_member(cat, "publication", "publisher", "publisher")


def publishers(cat: Catalogue) -> DataFrame:
    """All publishers joined by ', '."""
    return _all_members(cat, "publication", "publisher", "publishers")


def publication_date(cat: Catalogue, source: str = "dates") -> DataFrame:
    """Greatest of the two publication dates, for every instance."""
    from shelfmark.functions.json_text import pub_date

    return cat.doc("instance").select(F.col("id").alias("instance_id"), pub_date(F.col("j"), source).alias("pub_date"))


def subjects(cat: Catalogue) -> DataFrame:
    """All subject values joined by ', '."""
    return _all_members(cat, "subjects", "value", "subjects")


TEMPLATES = {
    "primary_author": primary_author,
    "authors": authors,
    "identifiers": identifiers,
    "instance_stat_codes": instance_stat_codes,
    "item_stat_codes": item_stat_codes,
    "item_checkouts": item_checkouts,
    "item_notes": item_notes,
    "primary_publisher": primary_publisher,
    "publishers": publishers,
    "publication_date": publication_date,
    "subjects": subjects,
}
