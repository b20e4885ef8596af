"""Derived tables D1-D11: pre-joined or exploded views over the catalogue.

The source system refreshes these wide tables from the raw ones; the reports read them
instead of re-parsing documents.  Here each one is a lazy DataFrame (a Spark job when
written with :func:`materialize`).  Their definitions are not part of the reports, so
they are inferred from the columns the reports use.

Join strategy: fact-to-fact joins (loan x item, loan x user, item x holdings x instance)
are equi-joins on ids that Spark shuffles on the key (AQE splits skewed keys); joins to
lookup tables (locations, material types, code and group names) are left to the
size-checked broadcast of the planner -- those tables are a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.joins import expand
from shelfmark.sources.catalogue import Catalogue


def _names(cat: Catalogue, table: str, id_as: str, name_as: str) -> DataFrame:
    return cat.flat(table).select(F.col("id").alias(id_as), F.col("name").alias(name_as))


def loans_items(cat: Catalogue) -> DataFrame:
    """One row per loan with its item, material type, current location and patron group."""
    together = ["instance_id"] if cat.loans_colocated else []  # bucketed alike: no shuffle of loans or items
    loan = cat.flat("loan").select(
        F.col("id").alias("loan_id"), "item_id", *together, "user_id", "item_status", "loan_date",
        F.col("due_date").alias("loan_due_date"), F.col("return_date").alias("loan_return_date"),
        "renewal_count")
    item = cat.doc("item").select(
        F.col("id").alias("item_id"), *together, F.col("j.barcode").alias("barcode"), "materialtypeid",
        F.col("effectivelocationid").alias("current_item_effective_location_id"))
    users = cat.doc("users").select(F.col("id").alias("user_id"), F.col("j.patronGroup").alias("patron_group_id"))
    groups = cat.doc("groups").select(F.col("id").alias("patron_group_id"), F.col("j.group").alias("patron_group_name"))
    return (
        loan.join(item, [*together, "item_id"], "left")
        .join(_names(cat, "material_type", "materialtypeid", "material_type_name"), "materialtypeid", "left")
        .join(_names(cat, "location", "current_item_effective_location_id", "current_item_effective_location_name"),
              "current_item_effective_location_id", "left")
        .join(users, "user_id", "left")
        .join(groups, "patron_group_id", "left")
        .select("loan_id", "item_id", "user_id", "barcode", "item_status", "loan_date", "loan_due_date",
                "loan_return_date", "renewal_count", "material_type_name", "patron_group_name",
                "current_item_effective_location_id", "current_item_effective_location_name")
    )


def items_holdings_instances(cat: Catalogue) -> DataFrame:
    """One row per item with its holdings record (call number) and instance (title)."""
    together = ["instance_id"] if cat.colocated else []
    item = cat.doc("item").select(
        F.col("id").alias("item_id"), F.col("holdingsrecordid").alias("holdings_id"), *together,
        F.col("j.barcode").alias("barcode"), "materialtypeid")
    holdings = cat.flat("holdings_record").select(F.col("id").alias("holdings_id"), "instance_id", "call_number")
    instance = cat.doc("instance").select(
        F.col("id").alias("instance_id"), F.col("j.title").alias("title"),
        F.col("j.catalogedDate").alias("cataloged_date"))
    return (
        item.join(holdings, [*together, "holdings_id"]).join(instance, "instance_id")
        .join(_names(cat, "material_type", "materialtypeid", "material_type_name"), "materialtypeid", "left")
        .select("item_id", "instance_id", "holdings_id", "call_number", "barcode", "material_type_name",
                "title", "cataloged_date")
    )


def item_ext(cat: Catalogue) -> DataFrame:
    """D3: one row per item with creation time and effective location name."""
    item = cat.doc("item").select(
        F.col("id").alias("item_id"), F.col("j.barcode").alias("barcode"),
        F.col("j.status.name").alias("status_name"),
        F.col("j.metadata.createdDate").try_cast("timestamp").alias("created_date"),
        F.col("effectivelocationid").alias("effective_location_id"))
    return item.join(_names(cat, "location", "effective_location_id", "effective_location_name"),
                     "effective_location_id", "left").select(
        "item_id", "barcode", "status_name", "created_date", "effective_location_id", "effective_location_name")


def _arrays(cat: Catalogue, table: str, member: str) -> DataFrame:
    """(<table>_id, array): one array member of every document."""
    return cat.doc(table).select(F.col("id").alias(f"{table}_id"), F.col(f"j.{member}").alias("array"))


def _codes(cat: Catalogue, table: str, key: str) -> DataFrame:
    codes = cat.doc(table).select(F.col("id").alias(key), F.col("j.statisticalCodeIds").alias("codes"))
    exploded = expand(codes, "codes", "code_ordinality", "statistical_code_id")
    return exploded.join(_names(cat, "statistical_code", "statistical_code_id", "statistical_code_name"),
                         "statistical_code_id").select(key, "code_ordinality", "statistical_code_id",
                                                       "statistical_code_name")


def item_statistical_codes(cat: Catalogue) -> DataFrame:
    """One row per (item, statistical code)."""
    return _codes(cat, "item", "item_id")


def instance_statistical_codes(cat: Catalogue) -> DataFrame:
    """One row per (instance, statistical code)."""
    return _codes(cat, "instance", "instance_id")


def instance_subjects(cat: Catalogue) -> DataFrame:
    """One row per subject; ``subjects`` is the subject element as JSON text."""
    return expand(_arrays(cat, "instance", "subjects"), "array", "subjects_ordinality", "s").select(
        "instance_id", "subjects_ordinality", F.to_json("s").alias("subjects"))


def instance_publication(cat: Catalogue) -> DataFrame:
    """One row per publication statement."""
    return expand(_arrays(cat, "instance", "publication"), "array", "publication_ordinality", "p").select("instance_id", "publication_ordinality", F.col("p.publisher").alias("publisher"),
             F.col("p.dateOfPublication").alias("date_of_publication"))


def instance_identifiers(cat: Catalogue) -> DataFrame:
    """One row per identifier."""
    return expand(_arrays(cat, "instance", "identifiers"), "array", "identifier_ordinality", "i").select("instance_id", "identifier_ordinality", F.col("i.value").alias("identifier"))


def item_notes(cat: Catalogue) -> DataFrame:
    """One row per item note with the note type's name."""
    notes = expand(_arrays(cat, "item", "notes"), "array", "note_ordinality", "n").select("item_id", "note_ordinality", F.col("n.itemNoteTypeId").alias("note_type_id"),
             F.col("n.note").alias("note"))
    return notes.join(_names(cat, "item_note_type", "note_type_id", "note_type_name"), "note_type_id", "left").select(
        "item_id", "note_ordinality", "note_type_id", "note_type_name", "note")


def loans_renewal_count(cat: Catalogue) -> DataFrame:
    """One row per loan with its renewal count."""
    return cat.flat("loan").select(F.col("id").alias("loan_id"), "item_id", "renewal_count")


def locations_libraries(cat: Catalogue) -> DataFrame:
    """One row per location with its library, campus and primary service point.

    This is the location dimension the reports join once per role (home / current
    location) instead of joining location, campus, library and service point
    separately.  ``*_found`` tells whether the referenced row exists, so a report can
    keep the inner-join semantics of the original lookups.
    """
    loc = cat.flat("location").select(F.col("id").alias("location_id"), F.col("name").alias("location_name"),
                                      F.col("library_id"), F.col("campus_id"),
                                      F.col("primary_service_point").alias("service_point_id"))

    def named(table: str, key: str, prefix: str) -> DataFrame:
        return cat.flat(table).select(F.col("id").alias(key), F.col("name").alias(f"{prefix}_name"),
                                      F.lit(True).alias(f"{prefix}_found"))

    out = (loc.join(named("loclibrary", "library_id", "library"), "library_id", "left")
           .join(named("loccampus", "campus_id", "campus"), "campus_id", "left")
           .join(named("service_point", "service_point_id", "service_point"), "service_point_id", "left"))
    return out.select("location_id", "location_name", "library_id", "library_name", "campus_id", "campus_name",
                      "service_point_id", "service_point_name",
                      *[F.coalesce(f"{p}_found", F.lit(False)).alias(f"{p}_found")
                        for p in ("library", "campus", "service_point")])


DERIVED = {
    "loans_items": loans_items,
    "items_holdings_instances": items_holdings_instances,
    "item_ext": item_ext,
    "item_statistical_codes": item_statistical_codes,
    "instance_statistical_codes": instance_statistical_codes,
    "instance_subjects": instance_subjects,
    "instance_publication": instance_publication,
    "instance_identifiers": instance_identifiers,
    "item_notes": item_notes,
    "loans_renewal_count": loans_renewal_count,
    "locations_libraries": locations_libraries,
}
