"""Parameterised reports R1-R10 as DataFrame plans.

Conventions shared by all reports
---------------------------------
* Optional filters (``'All'`` / ``None``) are added in Python only when set, so the
  plan carries no dead predicate.  ``None`` for an ``'All'`` parameter means ``'All'``.
* Dates are ``'YYYY-MM-DD'`` strings.  ``timestamp BETWEEN date AND date`` compares
  with midnight of each date (the end day is therefore excluded after 00:00);
  R6 compares calendar dates instead (end day included).
* Text order is binary; NULLs sort last ascending and first descending, as in the
  source database.  ``sort=False`` skips the final global sort (a range shuffle) for
  callers that write the result somewhere unordered.
* A date or number that does not parse is NULL (the load lists it in ``rejects``).
* Output columns are snake_case names of the report headers.  Where the reference
  puts a value under the wrong header (renewals vs checkouts; subtype vs content),
  the column is named after the value.

Scale notes: instances, holdings, items and loans are stored bucketed by instance, so the
fact-to-fact joins among them need no shuffle; a table with one very large instance is stored
without buckets and joined by shuffled keys that AQE splits.  Per-item loan statistics are
aggregated *before* joining so the join input is one row per item; lookups (locations, campuses, types, codes) are tiny and left to the
size-checked broadcast of the planner.  JSON documents are parsed once per scan with a
pruned schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import json_text as jt
from shelfmark.functions.text_search import lexemes, matches
from shelfmark.plans.joins import left_join_skewed_right
from shelfmark.sources.catalogue import Catalogue

ALL = "All"


def _is_set(param) -> bool:
    return param is not None and param != ALL


def _ts_between(ts: Column, start_date: str, end_date: str) -> Column:
    """``timestamptz BETWEEN date AND date`` (midnight of both dates, session zone)."""
    return ts.between(F.lit(start_date).cast("date").cast("timestamp"),
                      F.lit(end_date).cast("date").cast("timestamp"))


def _names(cat: Catalogue, table: str, id_as: str, name_as: str) -> DataFrame:
    return cat.flat(table).select(F.col("id").alias(id_as), F.col("name").alias(name_as))


def _doc_names(cat: Catalogue, table: str, id_as: str, name_as: str) -> DataFrame:
    """Name read from the raw document (the reports use both forms)."""
    return cat.doc(table).select(F.col("id").alias(id_as), F.col("j.name").alias(name_as))


def _locations(cat: Catalogue, key: str, **columns: str) -> DataFrame:
    """The location dimension (D11) keyed for one role, with renamed columns."""
    return cat.derived("locations_libraries").select(
        F.col("location_id").alias(key), *[F.col(src).alias(dst) for dst, src in columns.items()])


def _sorted(df: DataFrame, sort: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if sort else df


def _instances(cat: Catalogue) -> DataFrame:
    return cat.doc("instance").select(F.col("id").alias("instance_id"), F.col("j").alias("ins"))


def _holdings_t(cat: Catalogue) -> DataFrame:
    return cat.flat("holdings_record").select(F.col("id").alias("holdings_id"), "instance_id",
                                              "permanent_location_id", "call_number")


def _items(cat: Catalogue) -> DataFrame:
    return cat.doc("item").select(
        F.col("id").alias("item_id"), F.col("holdingsrecordid").alias("holdings_id"), *(["instance_id"] if cat.colocated else []),
        "effectivelocationid", "materialtypeid", "permanentloantypeid", "temporaryloantypeid",
        F.col("j").alias("it"))


# Join keys: with the tables bucketed by instance the instance's id is part of the key, which the
# buckets satisfy, so nothing is shuffled; without, the plain key, whose exchange AQE can split.
def _item_keys(cat: Catalogue) -> list[str]:
    return ["instance_id", "holdings_id"] if cat.colocated else ["holdings_id"]


def _loan_keys(cat: Catalogue) -> list[str]:
    return ["instance_id", "item_id"] if cat.loans_colocated else ["item_id"]


def _loan_stats(cat: Catalogue) -> DataFrame:
    """Checkouts and renewals per item with at least one loan (the loans CTE of R4/R10)."""
    return cat.flat("loan").groupBy(*_loan_keys(cat)).agg(F.count("id").alias("checkouts"), F.sum("renewal_count").alias("renewals"))


# --------------------------------------------------------------------------- R1
def call_number_list(cat: Catalogue, start_cn: str, end_cn: str | None = None, sort: bool = True) -> DataFrame:
    """Items in a call-number range with distinct notes, identifiers, dates, subjects.

    The reference joins nine derived tables (a product of every per-item and
    per-instance list) and undoes the product with DISTINCT aggregates.  Here each
    multi-valued side is aggregated to one row per key first, so the join never fans
    out beyond (item x statistical code x distinct loan state), which is the grain of
    the result.  ``end_cn=None`` means an open end.
    """
    ihi = cat.derived("items_holdings_instances")
    in_range = F.col("call_number") >= F.lit(start_cn)
    if end_cn is not None:
        in_range = in_range & (F.col("call_number") <= F.lit(end_cn))
    base = ihi.filter(in_range).select("item_id", "instance_id", "call_number", "barcode", "title",
                                       "material_type_name", "cataloged_date")

    def distinct_list(values: Column) -> Column:
        s = F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull())))
        return F.when(F.size(s) > 0, F.array_join(s, ", "))

    # Per-instance lists straight from the instance document: each instance's subjects,
    # publications and identifiers are arrays in one row, so DISTINCT + sort is an array
    # pass -- equal to aggregating the exploded derived tables (D6-D8) per instance, but
    # with no shuffle.  An instance needs at least one element of each (inner joins).
    j = F.col("j")
    nonempty = [F.coalesce(F.size(j.getField(a)) > 0, F.lit(False)) for a in ("subjects", "publication", "identifiers")]
    instance_lists = cat.doc("instance").filter(nonempty[0] & nonempty[1] & nonempty[2]).select(
        F.col("id").alias("instance_id"),
        distinct_list(F.transform(j.getField("subjects"), lambda x: F.lower(x.getField("value")))).alias("subjects"),
        distinct_list(F.transform(j.getField("publication"), lambda x: x.getField("dateOfPublication"))
                      ).alias("instance_publication"),
        distinct_list(F.transform(j.getField("identifiers"), lambda x: x.getField("value"))
                      ).alias("instance_identifiers"))
    ext = cat.derived("item_ext").select("item_id", "created_date", "effective_location_name")
    codes = cat.derived("item_statistical_codes").select("item_id", "statistical_code_name").distinct()
    # The filter is a CASE below the aggregate: Spark 4.1 fails on listagg(DISTINCT ..) WITHIN GROUP with FILTER.
    notes = cat.derived("item_notes").select("item_id", F.when(F.col("note_type_name") == "Staff Note", F.col("note")).alias("staff_note"))
    notes = notes.groupBy("item_id").agg(F.expr("listagg(DISTINCT staff_note, ', ') WITHIN GROUP (ORDER BY staff_note)").alias("item_notes"))
    renewal_items = cat.derived("loans_renewal_count").select("item_id")
    # One aggregation of the loans of the selected items: distinct loan states with their
    # counts; the total per item, a correlated scalar subquery, is the sum over its states (which the
    # planner makes a second, much smaller aggregation and a left join).  The filter on n keeps both
    # uses equal, so Spark shares one exchange.
    loan_states = (cat.derived("loans_items").join(base.select("item_id"), "item_id", "left_semi")
                   .groupBy("item_id", "item_status", "loan_date", "loan_return_date", "renewal_count")
                   .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0))
    total_checkouts = (loan_states.alias("loans").where(F.col("loans.item_id") == F.col("items.item_id").outer())
                       .select(F.sum("loans.n")).scalar())

    # The per-instance side first, then every per-item side, so that when the joins are
    # sort-merge the item frame is shuffled once per key.  The loan states -- the
    # largest input and the grain of the result -- are the streamed side of the last join.
    items = (
        base.join(instance_lists, "instance_id")
        .join(ext, "item_id")
        .join(codes, "item_id")
        .join(notes, "item_id")
        .join(renewal_items, "item_id", "left_semi")
    ).alias("items").select("*", F.coalesce(total_checkouts, F.lit(0)).cast("int").alias("total_checkouts"))
    rows = loan_states.drop("n").join(items, "item_id")
    out = rows.select(
        "created_date", "effective_location_name", "call_number", "barcode", "title", "material_type_name",
        "cataloged_date", "statistical_code_name", "item_status", "loan_date", "loan_return_date",
        "renewal_count", "total_checkouts", "item_notes", "instance_identifiers", "instance_publication", "subjects")
    # Barcode and loan date break ties, so a frequent call number can be split over tasks.
    return _sorted(out, sort, F.col("call_number").asc_nulls_last(), F.col("barcode").asc_nulls_last(),
                   F.col("loan_date").asc_nulls_last())


def instance_subject_list(cat: Catalogue) -> DataFrame:
    """R1's subject list of every instance with subjects, from the JSON text that D6 stores.

    The array pass inside R1 gives the same list without a shuffle; this is the form for a caller that has
    only the derived table.
    """
    value = F.lower(F.from_json("subjects", "value STRING").getField("value"))
    lists = cat.derived("instance_subjects").groupBy("instance_id").agg(F.array_sort(F.collect_set(value)).alias("s"))
    return lists.select("instance_id", F.when(F.size("s") > 0, F.array_join("s", ", ")).alias("subjects"))


# --------------------------------------------------------------------------- R2
def equipment_checkouts(cat: Catalogue, service_point: str = ALL, status: str = ALL,
                        start_date: str = "2000-01-01", end_date: str = "2050-01-01",
                        stat_code: str = "Hotspot") -> DataFrame:
    """R2: loans of items whose instance's *first* statistical code is ``stat_code``."""
    codes = _names(cat, "statistical_code", "code_id", "code_name").filter(F.col("code_name") == stat_code)
    ins = _instances(cat).withColumn("code_id", F.get(F.col("ins.statisticalCodeIds"), 0))
    ins = ins.join(codes, "code_id", "left_semi").select("instance_id", F.col("ins.title").alias("title"))

    loans = cat.flat("loan").select(*_loan_keys(cat), "user_id", "status_name", "item_status", "loan_date", "due_date")
    loans = loans.filter(_ts_between(F.col("loan_date"), start_date, end_date))
    if _is_set(status):
        loans = loans.filter(F.col("status_name") == status)

    users = cat.doc("users").select(F.col("id").alias("user_id"), F.col("j.barcode").alias("patron_barcode"),
                                    F.col("j.personal").alias("personal"))
    # home location with its service point, current location with its campus
    hl = _locations(cat, "permanent_location_id", home_location="location_name", sp_name="service_point_name",
                    sp_found="service_point_found").filter(F.col("sp_found"))
    if _is_set(service_point):
        hl = hl.filter(F.col("sp_name") == service_point)
    il = _locations(cat, "effectivelocationid", current_location="location_name", campus_name="campus_name",
                    campus_found="campus_found").filter(F.col("campus_found"))

    rows = (
        ins.join(_holdings_t(cat), "instance_id")
        .join(_items(cat), _item_keys(cat))
        .join(loans, _loan_keys(cat))
        .join(users, "user_id", "left")
        .join(hl, "permanent_location_id")
        .join(il, "effectivelocationid")
    )
    notes = F.col("it.notes")
    return rows.select(
        "title", "patron_barcode",
        F.col("status_name").alias("loan_status"),
        jt.full_name(F.col("personal.firstName"), F.col("personal.lastName")).alias("patron_name"),
        F.col("it.copyNumber").alias("copy_number"),
        "item_status", "loan_date", "due_date",
        F.col("it.barcode").alias("item_barcode"),
        "home_location", "current_location", "campus_name",
        jt.note_text(notes, jt.PRICE_NOTE).alias("price"),
        jt.note_text(notes, jt.PO_NUMBER_NOTE).alias("po_number"),
        jt.note_text(notes, jt.STAFF_NOTE).alias("staff_notes"))


# --------------------------------------------------------------------------- R3
def loan_list(cat: Catalogue, item_barcode: str | None = None, item_status: str = ALL,
              start_date: str = "2000-01-01", end_date: str = "2050-01-01",
              patron_group: str = "Student", loans_items: DataFrame | None = None) -> DataFrame:
    """Loans by patrons of one group in a date range (optionally one barcode / status)."""
    li = loans_items if loans_items is not None else cat.derived("loans_items")
    cond = (F.col("patron_group_name") == patron_group) & _ts_between(F.col("loan_date"), start_date, end_date)
    if item_barcode is not None:
        cond = cond & (F.col("barcode") == item_barcode)
    if _is_set(item_status):
        cond = cond & (F.col("item_status") == item_status)
    return li.filter(cond).select("user_id", "item_id", "barcode", "item_status", "loan_date", "loan_due_date",
                                  "loan_return_date", "renewal_count", "material_type_name")


# --------------------------------------------------------------------------- R4 / R10
def _catalogue_frame(cat: Catalogue, subject: str | None, config: str, instances: DataFrame | None = None):
    """instance x holdings x item with home/current location, type, campus and loan stats.

    The subject predicate is evaluated on instances before any join.
    """
    ins = instances if instances is not None else _instances(cat)
    ins = ins.withColumn("subjects_text", jt.array_member_text(F.col("ins.subjects"), "value"))
    if subject is not None and config == "english":
        # Term lookups in the subject index, then a semi join: no instance's text is read to decide it.
        ins = ins.join(cat.subject_index().search(subject), "instance_id", "left_semi")
    elif subject is not None:
        ins = ins.filter(matches(lexemes(F.col("subjects_text"), config), subject, config))
    # home location with its campus (and an existing service point), current location
    hl = _locations(cat, "permanent_location_id", home_location="location_name", campus="campus_name",
                    sp_found="service_point_found", campus_found="campus_found").filter(
        F.col("sp_found") & F.col("campus_found"))
    il = _locations(cat, "effectivelocationid", current_location="location_name")
    mt = _names(cat, "material_type", "materialtypeid", "material_type")
    insc = _doc_names(cat, "statistical_code", "ins_code_id", "instance_stat_code")
    itsc = _doc_names(cat, "statistical_code", "it_code_id", "item_stat_code")
    return (
        ins.join(_holdings_t(cat), "instance_id")
        .join(_items(cat), _item_keys(cat))
        .join(_loan_stats(cat), _loan_keys(cat), "left")
        .join(hl, "permanent_location_id")
        .join(il, "effectivelocationid")
        .join(mt, "materialtypeid")
        .withColumn("ins_code_id", F.get(F.col("ins.statisticalCodeIds"), 0))
        .withColumn("it_code_id", F.get(F.col("it.statisticalCodeIds"), 0))
        .join(insc, "ins_code_id", "left")
        .join(itsc, "it_code_id", "left")
    )


def _department_rule(department: str | None) -> Column | None:
    lc_call_number = F.coalesce(F.col("call_number"), F.lit("")).rlike(jt.LC_CALL_NUMBER)
    loc = F.col("current_location")
    rules = {
        "Library": lc_call_number & ~loc.rlike("(?i)(CLE|Open Lab)"),
        "CLE": ~lc_call_number & loc.rlike("(?i)(CLE)"),
        "Open Labs": ~lc_call_number & loc.rlike("(?i)(Open Lab)"),
    }
    return rules.get(department)


def inventory_search(cat: Catalogue, subject: str | None = None, start_cn: str = "A", end_cn: str = "ZZZ 9999.999",
                     material_type: str = ALL, campus: str = ALL, department: str = ALL,
                     pub_date_source: str = "dates", config: str = "english", sort: bool = True) -> DataFrame:
    """Catalogue items by call-number range, subject search, type, campus, department."""
    rows = _catalogue_frame(cat, subject, config)
    cond = F.col("call_number").between(F.lit(start_cn), F.lit(end_cn))
    if _is_set(material_type):
        cond = cond & (F.col("material_type") == material_type)
    if _is_set(campus):
        cond = cond & (F.col("campus") == campus)
    rule = _department_rule(department)
    if rule is not None:
        cond = cond & rule
    ins, it = F.col("ins"), F.col("it")
    out = rows.filter(cond).select(
        ins.getField("title").alias("title"),
        "campus",
        jt.path_first(ins.getField("contributors"), "name").alias("author"),
        "call_number",
        it.getField("barcode").alias("item_barcode"),
        it.getField("status").getField("name").alias("item_status"),
        jt.price_text(it.getField("notes")).alias("item_price"),
        F.col("material_type").alias("item_type"),
        ins.getField("catalogedDate").alias("date_created"),
        jt.pub_date(ins, pub_date_source).alias("publication_date"),
        jt.identifiers_greedy(ins.getField("identifiers")).alias("identifiers"),
        "home_location", "current_location",
        F.col("subjects_text").alias("subjects"),
        F.coalesce("checkouts", F.lit(0)).cast("int").alias("total_checkouts"),
        F.coalesce("renewals", F.lit(0)).cast("int").alias("total_renewals"),
        jt.path_first(ins.getField("publication"), "publisher").alias("publisher"),
        "instance_stat_code", "item_stat_code")
    return _sorted(out, sort, F.col("call_number").asc_nulls_last(), F.col("item_barcode").asc_nulls_last())


def subject_search(cat: Catalogue, subject: str | None, pub_date_source: str = "publicationPeriod",
                   config: str = "english") -> DataFrame:
    """Catalogue items whose subjects match a web-search query (required; None -> no rows)."""
    if subject is None:
        subject = ""
    rows = _catalogue_frame(cat, subject, config)
    ins, it = F.col("ins"), F.col("it")
    return rows.select(
        ins.getField("title").alias("title"),
        "campus",
        jt.path_first(ins.getField("contributors"), "name").alias("author"),
        "call_number",
        it.getField("barcode").alias("item_barcode"),
        jt.note_text(it.getField("notes"), jt.PRICE_NOTE).alias("item_price"),
        F.col("material_type").alias("item_type"),
        ins.getField("catalogedDate").alias("date_created"),
        jt.pub_date(ins, pub_date_source).alias("publication_date"),
        jt.identifiers_lazy(ins.getField("identifiers")).alias("identifiers"),
        "home_location", "current_location",
        F.col("subjects_text").alias("subjects"),
        F.coalesce("checkouts", F.lit(0)).cast("int").alias("total_checkouts"),
        F.coalesce("renewals", F.lit(0)).cast("int").alias("total_renewals"),
        jt.path_first(ins.getField("publication"), "publisher").alias("publisher"),
        "instance_stat_code", "item_stat_code")


# --------------------------------------------------------------------------- R5
def item_details(cat: Catalogue, service_point: str = ALL, holdings_location: str = ALL, item_location: str = ALL,
                 material_type: str = ALL, item_status: str = ALL, permanent_loan_type: str = ALL,
                 temporary_loan_type: str = ALL, subtype: str = ALL,
                 pub_date_source: str = "publicationPeriod") -> DataFrame:
    """Wide item listing with the eight note kinds."""
    hl = _locations(cat, "permanent_location_id", holdings_location="location_name",
                    service_point="service_point_name", sp_found="service_point_found").filter(F.col("sp_found"))
    plt = _names(cat, "loan_type", "permanentloantypeid", "permanent_loan_type")
    tlt = _names(cat, "loan_type", "temporaryloantypeid", "temporary_loan_type")
    il = _locations(cat, "effectivelocationid", item_location="location_name")
    mt = _names(cat, "material_type", "materialtypeid", "material_type")
    insc = _doc_names(cat, "statistical_code", "ins_code_id", "instance_stat_code")
    itsc = _doc_names(cat, "statistical_code", "it_code_id", "item_stat_code")
    rows = (
        _instances(cat).join(_holdings_t(cat), "instance_id")
        .join(_items(cat), _item_keys(cat))
        .join(hl, "permanent_location_id")
        .join(plt, "permanentloantypeid")
        .join(tlt, "temporaryloantypeid", "left")
        .join(il, "effectivelocationid")
        .join(mt, "materialtypeid")
        .withColumn("ins_code_id", F.get(F.col("ins.statisticalCodeIds"), 0))
        .withColumn("it_code_id", F.get(F.col("it.statisticalCodeIds"), 0))
        .join(insc, "ins_code_id", "left")
        .join(itsc, "it_code_id", "left")
        .withColumn("item_status", F.col("it.status.name"))
    )
    for param, column in ((service_point, "service_point"), (holdings_location, "holdings_location"),
                          (item_location, "item_location"), (material_type, "material_type"),
                          (item_status, "item_status"), (permanent_loan_type, "permanent_loan_type"),
                          (temporary_loan_type, "temporary_loan_type"), (subtype, "instance_stat_code")):
        if _is_set(param):
            rows = rows.filter(F.col(column) == param)
    ins, notes = F.col("ins"), F.col("it.notes")
    return rows.select(
        ins.getField("title").alias("title"),
        "call_number",
        jt.identifiers_lazy(ins.getField("identifiers")).alias("identifiers"),
        jt.pub_date(ins, pub_date_source).alias("publication_date"),
        F.col("it.barcode").alias("item_barcode"),
        "holdings_location", "item_location", "material_type", "service_point", "item_status",
        "permanent_loan_type", "temporary_loan_type",
        jt.note_text(notes, jt.CIRCULATION_NOTE).alias("circulation_note"),
        jt.note_text(notes, jt.PUBLIC_NOTE).alias("public_note"),
        jt.note_text(notes, jt.STAFF_NOTE).alias("staff_notes"),
        jt.note_text(notes, jt.OWNERSHIP_NOTE).alias("ownership"),
        jt.note_text(notes, jt.PRICE_NOTE).alias("price"),
        jt.note_text(notes, jt.INVENTORY_DATE_NOTE).alias("inventory_date"),
        jt.note_text(notes, jt.PO_NUMBER_NOTE).alias("po_number"),
        jt.note_text(notes, jt.INVOICE_NOTE).alias("invoice"),
        "instance_stat_code", "item_stat_code")


# --------------------------------------------------------------------------- R6
def location_checkout_counts(cat: Catalogue, start_date: str = "2000-01-01", end_date: str = "2050-01-01",
                             stat_code: str = "Laptop", material_type: str = "DAYUSE-ITEM",
                             sort: bool = True) -> DataFrame:
    """Number of loans per current location for one statistical code and material type."""
    day = F.to_date("loan_date")
    li = cat.derived("loans_items").filter(
        (F.col("material_type_name") == material_type)
        & (day >= F.lit(start_date).cast("date")) & (day <= F.lit(end_date).cast("date")))
    ihi = cat.derived("items_holdings_instances").select("item_id", "instance_id")
    isc = cat.derived("instance_statistical_codes").filter(F.col("statistical_code_name") == stat_code).select(
        "instance_id")
    out = (li.join(ihi, "item_id").join(isc, "instance_id")
           .groupBy(F.col("current_item_effective_location_name").alias("campus_lab"))
           .agg(F.count("loan_id").cast("int").alias("count_of_loans")))
    return _sorted(out, sort, F.col("campus_lab").asc_nulls_last(), F.col("count_of_loans").desc_nulls_first())


# --------------------------------------------------------------------------- R7
def fee_balances(cat: Catalogue, min_fee: float | str = "400.00", max_fee: float | str = "1000000.00",
                 sort: bool = True) -> DataFrame:
    """fee/fine accounts with a remaining balance in [min_fee, max_fee]."""
    lo = F.lit(str(min_fee)).cast("decimal(38,10)")
    hi = F.lit(str(max_fee)).cast("decimal(38,10)")
    acc = cat.doc("accounts").select(
        F.col("j.metadata.updatedDate").alias("updated"), F.col("j.userId").alias("user_id"),
        F.col("j.itemId").alias("item_id"), F.col("j.title").alias("item_title"),
        F.col("j.remaining").alias("remaining")).filter(F.col("remaining").between(lo, hi))
    users = cat.doc("users").select(
        F.col("id").alias("user_id"), F.col("j.barcode").alias("patron_barcode"), F.col("j.username").alias("username"),
        F.col("j.personal.lastName").alias("last_name"), F.col("j.personal.firstName").alias("first_name"),
        F.col("j.patronGroup").alias("group_id"))
    groups = cat.doc("groups").select(F.col("id").alias("group_id"), F.col("j.group").alias("patron_profile"))
    items = cat.doc("item").select(F.col("id").alias("item_id"), F.col("j.barcode").alias("barcode"))
    rows = acc.join(users, "user_id", "left").join(groups, "group_id", "left").join(items, "item_id", "left")
    out = rows.select(
        F.col("updated").try_cast("date").cast("string").alias("fee_date"),
        "patron_barcode", "patron_profile", "username", "last_name", "first_name", "barcode", "item_title",
        F.col("remaining").cast("decimal(38,2)").cast("string").alias("fee_balance"),
        "remaining")
    out = _sorted(out, sort, F.col("fee_date").desc_nulls_first(), F.col("username").asc_nulls_last(),
                  F.col("remaining").desc_nulls_first())
    return out.drop("remaining")


# --------------------------------------------------------------------------- R8
# fixed values: the inventory view's address
LINK_PREFIX = "https://library.example.edu/inventory?filters=staffSuppress.false&qindex=items.barcode&query="
LINK_SUFFIX = "&segment=items&sort=title"


def item_link(cat: Catalogue, item_barcode: str | None, base_url: str = LINK_PREFIX,
              url_suffix: str = LINK_SUFFIX) -> DataFrame:
    """An HTML anchor to the inventory view of the item(s) with this barcode."""
    items = cat.flat("item").select("barcode")
    if item_barcode is None:
        items = items.filter(F.lit(False))
    items = items.filter(F.col("barcode") == item_barcode)
    return items.select(F.concat(F.lit('<a href="'), F.lit(base_url), F.col("barcode"), F.lit(url_suffix),
                                 F.lit('">'), F.col("barcode"), F.lit("</a>")).alias("link"))


# --------------------------------------------------------------------------- R9
def semester_loans(cat: Catalogue, subtype: str = ALL, item_library: str = ALL, sort: bool = True) -> DataFrame:
    """Semester equipment items (by subtype rule) with their open loan and borrower, if any."""
    open_loans = cat.doc("loan").filter(F.col("j.status.name") == "Open").select(
        *(["instance_id"] if cat.loans_colocated else []), F.col("j.itemId").alias("item_id"), F.col("j.userId").alias("user_id"),
        F.col("j.dueDate").alias("due_date"),
        F.col("j.itemEffectiveLocationIdAtCheckOut").alias("checkout_location_id"))
    users = cat.doc("users").select(
        F.col("id").alias("user_id"), F.col("j.barcode").alias("user_barcode"),
        jt.full_name(F.col("j.personal.firstName"), F.col("j.personal.lastName")).alias("full_name"),
        F.col("j.personal.phone").alias("phone"), F.col("j.personal.email").alias("email"))
    checkout_loc = cat.doc("location").select(F.col("id").alias("checkout_location_id"),
                                              F.col("j.campusId").alias("checkout_campus_id"))
    checkout_campus = _doc_names(cat, "loccampus", "checkout_campus_id", "checkout_campus")
    hr = cat.doc("holdings_record").select(F.col("id").alias("holdings_id"), F.col("instanceid").alias("instance_id"),
                                           F.col("permanentlocationid").alias("home_location_id"))
    hl = _locations(cat, "home_location_id", home_location="location_name", item_library="library_name",
                    library_found="library_found").filter(F.col("library_found"))
    insc = _names(cat, "statistical_code", "ins_code_id", "subtype")
    mt = _names(cat, "material_type", "mt_id", "material_type")
    if _is_set(item_library):
        hl = hl.filter(F.col("item_library") == item_library)

    code, mtype = F.col("subtype"), F.col("material_type")
    calculator = (code == "Calculator") & (mtype == "SEM-ITEM")
    hotspot = (code == "Hotspot") & (mtype == "SEMEXTEND-ITEM")
    laptop = (code == "Laptop") & (mtype == "SEMEXTEND-ITEM")
    rule = {
        "Calculator": calculator,
        "Hotspot": hotspot & (F.col("home_location") != "Storage"),
        "Laptop": laptop,
    }.get(subtype, calculator | (code.isin("Laptop", "Hotspot") & (mtype == "SEMEXTEND-ITEM")))

    rows = (
        _instances(cat).join(hr, "instance_id")
        .join(_items(cat), _item_keys(cat))
        .join(hl, "home_location_id")
        .withColumn("ins_code_id", F.get(F.col("ins.statisticalCodeIds"), 0))
        .join(insc, "ins_code_id")
        .withColumn("mt_id", F.col("it.materialTypeId"))
        .join(mt, "mt_id")
        .filter(rule)
    )
    # Only the open loans of the selected items meet the patrons.  The item exists in both
    # roles, so its instance and holdings are not joined again.
    loans = (open_loans.join(rows.select(*_loan_keys(cat)), _loan_keys(cat), "left_semi")
             .join(users, "user_id").join(checkout_loc, "checkout_location_id")
             .join(checkout_campus, "checkout_campus_id")
             .select("item_id", "due_date", "user_barcode", "full_name", "phone", "email", "checkout_campus"))
    # One item may hold many open loans (the right side is skewed on item_id).
    rows = left_join_skewed_right(rows, loans, "item_id")
    out = rows.select(
        "subtype", "item_library",
        F.col("it.barcode").alias("item_barcode"),
        F.col("it.status.name").alias("status"),
        F.col("checkout_campus").alias("checkout_library"),
        F.col("due_date").try_cast("date").cast("string").alias("due_date"),
        "user_barcode",
        F.col("full_name").alias("name"),
        F.col("phone").alias("phone_number"),
        "email",
        jt.note_text(F.col("it.notes"), jt.STAFF_NOTE).alias("staff_notes"))
    return _sorted(out, sort, F.col("item_barcode").asc_nulls_last())

