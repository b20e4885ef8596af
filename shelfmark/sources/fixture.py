"""Raw library tables derived from the driver's TPC-H-like test tables.

The source system stores each catalogue record as a JSON document beside a few promoted
key columns.  No library data ships with the test tables, so this module derives a
catalogue from them with fixed integer rules (FIXTURES.md, part B): parts become
instances with one holdings record and two items each, customers become patrons, line
items become loans and orders become fee accounts.  Every rule uses only integer keys,
modulo, concatenation and literals, so an independent SQL engine can rebuild the same
values.

All tables are lazy DataFrames of shape ``(id, <promoted keys>, jsonb)``; nothing is
collected.  The work grows with the input: line items -> loans is a shuffle join with
orders on the order key; everything else is a map over one table plus joins with
bounded lookup tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import spread

# Uuid prefix per table kind ("uid(kind, k)" in FIXTURES.md).
KIND = {
    "campus": "a1000000",
    "library": "a2000000",
    "service_point": "a3000000",
    "location": "a4000000",
    "material_type": "a5000000",
    "statistical_code": "a6000000",
    "loan_type": "a7000000",
    "group": "a8000000",
    "instance": "b1000000",
    "holdings": "b2000000",
    "item": "b3000000",
    "user": "c1000000",
    "loan": "d1000000",
    "account": "d2000000",
}

# Item note types (id, name) used by the reports.
NOTE_TYPES = [
    ("1fceb11c-7a89-49d6-8ef0-2a42c58556a2", "Price"),
    ("5ec4ca65-aacc-4f16-aa9d-395efd89f850", "PO Number"),
    ("86e6410d-4c8b-4853-8054-bd5e563e9760", "Staff Note"),
    ("5366d4d4-8775-4cf4-a00f-77c82f0ca3bf", "Circulation Note"),
    ("b6b35579-ee2b-4973-8e0d-ebc05bab0dab", "Public Note"),
    ("34207e4e-5cd7-4eab-801b-b0326cd5c66a", "Ownership"),
    ("e1f34ba3-6d37-462e-878c-17f922b13d93", "Inventory Date"),
    ("8f99bd3a-706c-45d2-89d8-8eca7fa1c03f", "Invoice"),
]
(PRICE_NOTE, PO_NOTE, STAFF_NOTE, CIRCULATION_NOTE, PUBLIC_NOTE, OWNERSHIP_NOTE, INVENTORY_DATE_NOTE,
 INVOICE_NOTE) = (note_id for note_id, _ in NOTE_TYPES)

# Statistical codes, indexed 0..5.
STATISTICAL_CODES = ["Calculator", "Hotspot", "Laptop", "Fiction", "Nonfiction", "Kit"]
# Part type -> material type name, indexed 0..5.
MATERIAL_TYPES = [
    ("ECONOMY", "SEM-ITEM"),
    ("STANDARD", "SEMEXTEND-ITEM"),
    ("PROMO", "DAYUSE-ITEM"),
    ("SMALL", "BOOK"),
    ("MEDIUM", "EBOOK"),
    ("LARGE", "AV-ITEM"),
]
# Loan types 0..3; permanent = item key % 3, temporary = 3 for item key % 5 = 0.
LOAN_TYPES = ["Can circulate", "Course reserves", "Reading room", "Short term"]
# Item status by item key % 4.
ITEM_STATUSES = ["Available", "Checked out", "In transit", "Missing"]
# Customer market segment -> patron group, indexed 0..4.
PATRON_GROUPS = [
    ("BUILDING", "Student"),
    ("AUTOMOBILE", "Faculty"),
    ("FURNITURE", "Staff"),
    ("HOUSEHOLD", "Guest"),
    ("MACHINERY", "Alumni"),
]
# Location name suffix by nation key % 3; nation key 24 is 'Storage'.
LOCATION_SUFFIXES = [" General", " CLE", " Open Lab"]
STORAGE_NATION = 24
N_LOCATIONS = 25
# Two locations share this name; one location has no service point.
SHARED_NAME, SHARED_NATIONS, NO_SERVICE_POINT_NATION = "Annex General", (6, 9), 13


def padded(k: Column, width: int) -> Column:
    """``k`` as text, zero-padded to ``width`` digits; a longer number keeps all its digits."""
    text = k.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def uid(kind: str, k: Column) -> Column:
    """``kind-0000-4000-8000-<k padded to 12 digits>``."""
    return F.concat(F.lit(f"{KIND[kind]}-0000-4000-8000-"), padded(k, 12))


def untidy(ident: Column, key: Column) -> Column:
    """``ident`` as some systems write it: in capitals for key % 17 = 0, padded with blanks for key % 19 = 0."""
    text = F.when(key % 17 == 0, F.upper(ident)).otherwise(ident)
    return F.when(key % 19 == 0, F.concat(F.lit(" "), text, F.lit("  "))).otherwise(text)


def iso_text(ts: Column) -> Column:
    """Timestamp as ISO text with an explicit UTC offset, as the source system writes it."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


def _pick(values: list[str], idx: Column) -> Column:
    """``values[idx]`` (0-based) for a literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def _index_of(values: list[str], col: Column) -> Column:
    """0-based position of ``col`` in a literal list, NULL when absent."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col)
    return F.when(pos > 0, pos - 1)


def _doc(*cols: Column) -> Column:
    """JSON document of the given named columns; NULL members are left out."""
    return F.to_json(F.struct(*cols))


def _lookup(spark: SparkSession, kind: str, names: list[str], doc_field: str = "name") -> DataFrame:
    rows = [(i, n) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "k int, name string")
    return df.select(uid(kind, F.col("k")).alias("id"), _doc(F.col("name").alias(doc_field)).alias("jsonb"))


def build_raw_tables(spark: SparkSession, sf_dir: str, every_loan: bool = False) -> dict[str, DataFrame]:
    """All raw library tables for one test-data directory (lazy).

    ``every_loan``: the loans also hold those of the items that are otherwise never lent.
    """

    def read(name: str, spread_out: bool = True) -> DataFrame:
        # The documents are built by wide projections (JSON encoding); an input that
        # may arrive as a few large splits is spread first.
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return spread(df) if spread_out else df

    region = read("region", spread_out=False)   # a handful of rows: nothing to spread
    nation = read("nation", spread_out=False)
    part = read("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    customer = read("customer").select("c_custkey", "c_name", "c_mktsegment")
    # Line items meet their orders before a document is built: they are spread by the key of that join.
    orders = read("orders", spread_out=False)
    lineitem = spread(read("lineitem", spread_out=False), "l_orderkey")

    t: dict[str, DataFrame] = {}

    # --- lookups -------------------------------------------------------------------
    t["loccampus"] = region.select(uid("campus", F.col("r_regionkey")).alias("id"),
                                   _doc(F.col("r_name").alias("name")).alias("jsonb"))
    t["loclibrary"] = region.select(uid("library", F.col("r_regionkey")).alias("id"),
                                    _doc(F.col("r_name").alias("name")).alias("jsonb"))
    t["service_point"] = nation.select(uid("service_point", F.col("n_nationkey")).alias("id"),
                                       _doc(F.col("n_name").alias("name")).alias("jsonb"))
    nk = F.col("n_nationkey")
    loc_name = (F.when(nk == STORAGE_NATION, F.lit("Storage")).when(nk.isin(*SHARED_NATIONS), F.lit(SHARED_NAME))
                .otherwise(F.concat(F.col("n_name"), _pick(LOCATION_SUFFIXES, nk % 3))))
    t["location"] = nation.select(
        uid("location", nk).alias("id"),
        _doc(loc_name.alias("name"),
             uid("campus", F.col("n_regionkey")).alias("campusId"),
             uid("library", F.col("n_regionkey")).alias("libraryId"),
             F.when(nk != NO_SERVICE_POINT_NATION, uid("service_point", nk)).alias("primaryServicePoint")).alias("jsonb"))
    t["material_type"] = _lookup(spark, "material_type", [m for _, m in MATERIAL_TYPES])
    t["loan_type"] = _lookup(spark, "loan_type", LOAN_TYPES)
    t["statistical_code"] = spark.createDataFrame(
        list(enumerate(STATISTICAL_CODES)), "k int, name string").select(
        uid("statistical_code", F.col("k")).alias("id"),
        _doc(F.col("name"), F.lower(F.col("name")).alias("code")).alias("jsonb"))
    t["groups"] = _lookup(spark, "group", [g for _, g in PATRON_GROUPS], doc_field="group")
    t["item_note_type"] = spark.createDataFrame(NOTE_TYPES, "id string, name string").select(
        "id", _doc(F.col("name")).alias("jsonb"))

    # --- instances, holdings, items (one of each per part, two items) -----------------
    key = F.col("p_partkey")
    even = key % 2 == 0
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    later = (F.lit(1951) + F.col("p_size") + key % 5).cast("string")
    contributors = F.filter(
        F.array(F.struct(F.col("p_brand").alias("name")), F.struct(F.col("p_type").alias("name"))),
        lambda x, i: i < key % 3)
    identifiers = F.filter(
        F.array(F.struct(F.concat(F.lit("978"), key.cast("string")).alias("value")),
                F.struct(F.concat(F.lit("979"), key.cast("string"), F.lit(" : pbk $10.00")).alias("value"))),
        lambda x, i: (i == 0) | even)
    subjects = F.when(key % 11 != 0, F.concat(
        F.transform(F.split(F.col("p_name"), " "), lambda w: F.struct(w.alias("value"))),
        F.array(F.struct(F.col("p_type").alias("value")))))
    publication = F.when(key % 4 != 0, F.array(
        F.struct(F.col("p_brand").alias("publisher"), year.alias("dateOfPublication"))))
    codes = F.when(key % 7 != 0, F.filter(
        F.array(untidy(uid("statistical_code", key % 6), key), uid("statistical_code", (key + 3) % 6)),
        lambda x, i: (i == 0) | even))
    cataloged = F.concat(F.lit("2019-"), F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lit("-"),
                         F.lpad((key % 28 + 1).cast("string"), 2, "0"))
    t["instance"] = part.select(
        uid("instance", key).alias("id"),
        _doc(F.col("p_name").alias("title"), cataloged.alias("catalogedDate"),
             contributors.alias("contributors"), identifiers.alias("identifiers"),
             subjects.alias("subjects"), publication.alias("publication"),
             F.struct(year.alias("date1"), F.when(even, later).alias("date2")).alias("dates"),
             F.struct((F.lit(1900) + F.col("p_size")).cast("string").alias("start"),
                      F.when(key % 3 == 0, (F.lit(1902) + F.col("p_size")).cast("string")).alias("end")).alias("publicationPeriod"),
             codes.alias("statisticalCodeIds")).alias("jsonb"))

    size = F.col("p_size").cast("string")
    skey = key.cast("string")
    call_number = (F.when(key % 5 == 0, F.concat(F.lit("QA "), size, F.lit("."), skey))
                   .when(key % 5 == 1, F.concat(F.lit("HF"), size, F.lit(" ."), skey))
                   .when(key % 5 == 2, F.concat(F.lit("LAPTOP "), skey))
                   .when(key % 5 == 3, F.concat(F.lit("E "), size)))
    t["holdings_record"] = part.select(
        uid("holdings", key).alias("id"),
        untidy(uid("instance", key), key).alias("instanceid"),
        uid("location", key % N_LOCATIONS).alias("permanentlocationid"),
        _doc(untidy(uid("instance", key), key + 1).alias("instanceId"),
             uid("location", key % N_LOCATIONS).alias("permanentLocationId"),
             call_number.alias("callNumber")).alias("jsonb"))

    copies = part.select("p_partkey", "p_type", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    ikey = F.col("p_partkey") * 2 + F.col("copy")

    def note(type_id: str, text: Column) -> Column:
        return F.struct(untidy(F.lit(type_id), ikey).alias("itemNoteTypeId"), text.alias("note"))

    price_text = F.concat(F.when(ikey % 4 == 0, F.lit("$")).otherwise(F.lit("")),
                          (ikey % 90 + 10).cast("string"), F.lit(".00"))
    notes = F.when(ikey % 7 != 0, F.filter(F.array(
        F.when(ikey % 2 == 0, note(PRICE_NOTE, price_text)),
        F.when(ikey % 3 == 0, note(STAFF_NOTE, F.concat(F.lit("checked "), (ikey % 4).cast("string")))),
        F.when(ikey % 6 == 0, note(STAFF_NOTE, F.lit("damaged"))),
        F.when(ikey % 5 == 1, note(PO_NOTE, F.concat(F.lit("PO-"), ikey.cast("string")))),
        F.when(ikey % 8 == 3, note(CIRCULATION_NOTE, F.concat(F.lit("two hours, "), (ikey % 3).cast("string")))),
        F.when(ikey % 8 == 5, note(PUBLIC_NOTE, F.lit("ask at the desk"))),
        F.when(ikey % 16 == 9, note(OWNERSHIP_NOTE, F.lit("gift"))),
        F.when(ikey % 10 == 3, note(INVENTORY_DATE_NOTE, F.concat(F.lit("2021-0"), (ikey % 9 + 1).cast("string")))),
        F.when(ikey % 10 == 7, note(INVOICE_NOTE, F.concat(F.lit("INV "), ikey.cast("string"))))),
        lambda x: x.isNotNull()))
    mtype = uid("material_type", _index_of([p for p, _ in MATERIAL_TYPES], F.col("p_type")))
    created = F.concat(F.expr("cast(date_add(date'2015-01-01', cast((p_partkey * 2 + copy) % 1000 as int)) as string)"),
                       F.lit("T10:00:00.000+00:00"))
    t["item"] = copies.select(
        uid("item", ikey).alias("id"),
        untidy(uid("holdings", F.col("p_partkey")), ikey).alias("holdingsrecordid"),
        uid("location", (F.col("p_partkey") + 7 * F.col("copy")) % N_LOCATIONS).alias("effectivelocationid"),
        mtype.alias("materialtypeid"),
        uid("loan_type", ikey % 3).alias("permanentloantypeid"),
        F.when(ikey % 5 == 0, uid("loan_type", F.lit(3))).alias("temporaryloantypeid"),
        _doc(F.concat(F.lit("3"), padded(ikey, 13)).alias("barcode"),
             (F.col("copy") + 1).cast("string").alias("copyNumber"),
             mtype.alias("materialTypeId"),
             F.struct(_pick(ITEM_STATUSES, ikey % 4).alias("name")).alias("status"),
             notes.alias("notes"),
             F.when(ikey % 9 != 0, F.array(uid("statistical_code", ikey % 6))).alias("statisticalCodeIds"),
             F.struct(created.alias("createdDate")).alias("metadata")).alias("jsonb"))

    # --- patrons ------------------------------------------------------------------
    ck = F.col("c_custkey")
    username = F.lower(F.regexp_replace(F.col("c_name"), "#", "."))
    group_idx = _index_of([s for s, _ in PATRON_GROUPS], F.col("c_mktsegment"))
    t["users"] = customer.select(
        uid("user", ck).alias("id"),
        _doc(F.concat(F.lit("2"), padded(ck, 13)).alias("barcode"),
             username.alias("username"),
             uid("group", group_idx).alias("patronGroup"),
             F.struct(F.when(ck % 10 != 0, F.concat(F.lit("First"), ck.cast("string"))).alias("firstName"),
                      F.when(ck % 15 != 0, F.concat(F.lit("Last"), ck.cast("string"))).alias("lastName"),
                      F.concat(F.lit("555-"), F.lpad((ck % 10000).cast("string"), 4, "0")).alias("phone"),
                      F.concat(username, F.lit("@example.edu")).alias("email")).alias("personal")
             ).alias("jsonb"))

    # --- loans: line item x order (shuffle join on the order key) ---------------------
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_linestatus", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # some items are never lent, unless every loan is wanted
    item_key = F.col("l_partkey") * 2 + F.col("l_linenumber") % 2
    loans = li.join(od, "l_orderkey")
    if not every_loan:
        loans = loans.where(item_key % 50 != 47)
    loan_ts = F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)")
    is_open = F.col("l_linestatus") == "O"
    t["loan"] = loans.select(
        uid("loan", F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        _doc(untidy(uid("item", item_key), F.col("l_orderkey")).alias("itemId"),
             untidy(uid("user", F.col("o_custkey")), F.col("l_orderkey") + 1).alias("userId"),
             F.struct(F.when(is_open, F.lit("Open")).otherwise(F.lit("Closed")).alias("name")).alias("status"),
             F.when(is_open, F.lit("Checked out")).otherwise(F.lit("Available")).alias("itemStatus"),
             F.when(F.col("l_orderkey") % 97 == 0, F.lit("00/00/0000")).otherwise(iso_text(loan_ts)).alias("loanDate"),
             iso_text(F.expr("timestampadd(DAY, 14, timestampadd(HOUR, l_linenumber, l_shipdate))")).alias("dueDate"),
             F.when(~is_open, iso_text(F.expr("timestampadd(DAY, 7, timestampadd(HOUR, l_linenumber, l_shipdate))"))
                    ).alias("returnDate"),
             (F.col("l_quantity").cast("int") % 4).alias("renewalCount"),
             F.when(F.col("l_suppkey") % 13 != 0, uid("location", F.col("l_suppkey") % N_LOCATIONS)
                    ).alias("itemEffectiveLocationIdAtCheckOut")).alias("jsonb"))

    # --- fee accounts: one per order, about the item of the order's first line ----------
    first = (lineitem.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey")).alias("line"))
             .select(F.col("l_orderkey").alias("o_orderkey"), F.col("line.l_partkey").alias("title_part"),
                     (F.col("line.l_partkey") * 2 + F.col("line.l_linenumber") % 2).alias("item_key")))
    titles = part.select(F.col("p_partkey").alias("title_part"), F.col("p_name").alias("title"))
    acct = (orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
            .join(first, "o_orderkey", "left").join(titles, "title_part", "left"))
    t["accounts"] = acct.select(
        uid("account", F.col("o_orderkey")).alias("id"),
        _doc(uid("user", F.col("o_custkey")).alias("userId"),
             uid("item", F.col("item_key")).alias("itemId"),
             F.col("title"),
             F.col("o_totalprice").cast("decimal(12,2)").alias("remaining"),
             F.struct(iso_text(F.col("o_orderdate")).alias("updatedDate")).alias("metadata")).alias("jsonb"))
    # some balances are no numbers
    t["accounts"] = t["accounts"].withColumn("jsonb", F.when(
        F.substring("id", -2, 2) == "89", F.regexp_replace("jsonb", r'"remaining":[0-9.]+', '"remaining":"waived"')).otherwise(F.col("jsonb")))
    return t
