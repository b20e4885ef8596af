"""Report edge cases on a tiny hand-written catalogue (FIXTURES.md part C)."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import json_text as jt
from shelfmark.operators import reports as R
from shelfmark.operators import templates as T
from shelfmark.sources import Catalogue
from shelfmark.sources.schemas import RAW_TABLES

HOTSPOT, LAPTOP, KIT = "code-hotspot", "code-laptop", "code-kit"


def _table(spark, name, rows):
    keys, _ = RAW_TABLES[name]
    schema = ", ".join(["id string", *[f"{k} string" for k in keys], "jsonb string"])
    data = [(r["id"], *[r.get(k) for k in keys], json.dumps(r.get("doc", {}))) for r in rows]
    return spark.createDataFrame(data, schema)


def _instance(i, codes, subjects=None, contributors=None):
    doc = {"title": f"title {i}", "identifiers": [{"value": f"978{i}"}], "statisticalCodeIds": codes}
    if subjects is not None:
        doc["subjects"] = [{"value": s} for s in subjects]
    if contributors is not None:
        doc["contributors"] = contributors
    return {"id": f"ins{i}", "doc": doc}


def _item(i, holdings, mt, status="Available", notes=None):
    return {"id": f"it{i}", "holdingsrecordid": holdings, "effectivelocationid": "loc1", "materialtypeid": mt,
            "permanentloantypeid": "lt1",
            "doc": {"barcode": f"bc{i}", "copyNumber": "1", "materialTypeId": mt, "status": {"name": status},
                    "notes": notes or []}}


def _loan(i, item, user, date, status="Open", renewals=0, checkout_loc="loc1"):
    doc = {"itemId": item, "userId": user, "status": {"name": status}, "itemStatus": "Checked out",
           "loanDate": date, "dueDate": "2024-01-01T23:30:00.000-06:00", "renewalCount": renewals}
    if checkout_loc:
        doc["itemEffectiveLocationIdAtCheckOut"] = checkout_loc
    return {"id": f"loan{i}", "doc": doc}


@pytest.fixture(scope="module")
def tiny(spark):
    tables = {
        "instance": [
            _instance(1, [HOTSPOT], ["Texas history", "United States"], [{}, {"name": "B"}]),
            _instance(2, [KIT, HOTSPOT]),            # second code is Hotspot -> not an R2 row
            _instance(3, None, contributors=[]),     # no codes: kept by R4, dropped by R2
            _instance(4, [LAPTOP], ["Ohio"]),
            _instance(5, [LAPTOP]),
        ],
        "holdings_record": [{"id": f"h{i}", "instanceid": f"ins{i}", "permanentlocationid": "loc1",
                             "doc": {"instanceId": f"ins{i}", "permanentLocationId": "loc1",
                                     "callNumber": f"QA {i}"}} for i in range(1, 6)],
        "item": [
            _item(1, "h1", "mt-ext"),
            _item(2, "h2", "mt-ext"),
            _item(3, "h3", "mt-ext"),
            _item(4, "h4", "mt-day", notes=[{"itemNoteTypeId": jt.PRICE_NOTE, "note": "$$12.00"}]),
            _item(5, "h5", "mt-ext"),
        ],
        "location": [{"id": "loc1", "doc": {"name": "Main CLE", "campusId": "c1", "libraryId": "l1",
                                            "primaryServicePoint": "sp1"}}],
        "loccampus": [{"id": "c1", "doc": {"name": "North"}}],
        "loclibrary": [{"id": "l1", "doc": {"name": "North Library"}}],
        "service_point": [{"id": "sp1", "doc": {"name": "Desk"}}],
        "material_type": [{"id": "mt-ext", "doc": {"name": "SEMEXTEND-ITEM"}},
                          {"id": "mt-day", "doc": {"name": "DAYUSE-ITEM"}}],
        "loan_type": [{"id": "lt1", "doc": {"name": "Can circulate"}}],
        "statistical_code": [{"id": HOTSPOT, "doc": {"name": "Hotspot"}}, {"id": LAPTOP, "doc": {"name": "Laptop"}},
                             {"id": KIT, "doc": {"name": "Kit"}}],
        "item_note_type": [{"id": jt.PRICE_NOTE, "doc": {"name": "Price"}}],
        "loan": [
            _loan(1, "it1", "u1", "2024-01-01T08:00:00.000+00:00"),
            _loan(2, "it1", "u2", "2024-01-02T08:00:00.000+00:00"),           # second open loan of it1
            _loan(3, "it2", "u1", "2024-01-03T08:00:00.000+00:00"),
            _loan(4, "it5", "u1", "2024-01-03T08:00:00.000+00:00", checkout_loc=None),
            _loan(5, "it4", "u1", "2024-01-05T10:00:00.000+00:00", status="Closed", renewals=1),
            _loan(6, "it4", "u1", "2024-01-04T10:00:00.000+00:00", status="Closed"),
            _loan(7, "it4", "u1", "2024-01-03T10:00:00.000+00:00", status="Closed"),
        ],
        "users": [{"id": "u1", "doc": {"barcode": "p1", "username": "jane", "patronGroup": "g1",
                                      "personal": {"firstName": "Jane"}}},
                  {"id": "u2", "doc": {"barcode": "p2", "username": "anon", "patronGroup": "g1", "personal": {}}}],
        "groups": [{"id": "g1", "doc": {"group": "Student"}}],
        "accounts": [
            {"id": "a1", "doc": {"userId": "u1", "itemId": "it1", "title": "t", "remaining": 400.50,
                                 "metadata": {"updatedDate": "2024-01-01T23:30:00.000-06:00"}}},
            {"id": "a2", "doc": {"userId": "u1", "itemId": "it1", "title": "t", "remaining": "lots"}},
        ],
    }
    return Catalogue(spark, {name: _table(spark, name, rows) for name, rows in tables.items()})


def test_two_open_loans_give_two_rows_and_missing_checkout_location_gives_no_borrower(tiny):
    rows = R.semester_loans(tiny, sort=False).collect()
    by_item = {}
    for r in rows:
        by_item.setdefault(r.item_barcode, []).append(r)
    assert sorted(r.user_barcode for r in by_item["bc1"]) == ["p1", "p2"]
    assert [r.user_barcode for r in by_item["bc5"]] == [None]
    assert {r.name for r in by_item["bc1"]} == {"Jane ", None}
    assert by_item["bc1"][0].due_date == "2024-01-01"


def test_r2_uses_the_first_statistical_code_only(tiny):
    rows = R.equipment_checkouts(tiny, start_date="2023-01-01", end_date="2025-01-01").collect()
    assert {r.item_barcode for r in rows} == {"bc1"}


def test_r4_keeps_instances_without_codes_and_cleans_price(tiny):
    rows = {r.item_barcode: r for r in R.inventory_search(tiny, sort=False).collect()}
    assert "bc3" in rows and rows["bc3"].instance_stat_code is None
    assert rows["bc4"].item_price == "$12.00" and rows["bc1"].item_price == "$0.00"
    assert rows["bc1"].author == "B"
    assert rows["bc3"].subjects == ""


def test_checkouts_and_renewals(tiny):
    row = [r for r in R.inventory_search(tiny, sort=False).collect() if r.item_barcode == "bc4"][0]
    assert (row.total_checkouts, row.total_renewals) == (3, 1)


def test_end_date_semantics(tiny):
    r3 = R.loan_list(tiny, start_date="2024-01-01", end_date="2024-01-05").collect()
    assert "2024-01-05" not in {r.loan_date.date().isoformat() for r in r3}
    r6 = R.location_checkout_counts(tiny, start_date="2024-01-05", end_date="2024-01-05").collect()
    assert [(r.campus_lab, r.count_of_loans) for r in r6] == [("Main CLE", 1)]


def test_item_status_parameter(tiny):
    assert R.loan_list(tiny, item_status="Missing").count() == 0
    assert R.loan_list(tiny, item_status="Checked out").count() == 7


def test_fee_balance_text_and_bad_balance(tiny):
    rows = R.fee_balances(tiny).collect()
    assert [(r.fee_balance, r.fee_date, r.first_name, r.patron_profile) for r in rows] == \
        [("400.50", "2024-01-01", "Jane", "Student")]


def test_primary_author_is_the_first_element(tiny):
    rows = {r.instance_id: r.author for r in T.primary_author(tiny).collect()}
    assert rows == {"ins1": None}


def test_subject_search_phrase_across_subjects_and_exclusion(tiny):
    assert {r.item_barcode for r in R.subject_search(tiny, '"history united"').collect()} == {"bc1"}
    assert {r.item_barcode for r in R.subject_search(tiny, "-texas").collect()} == {"bc2", "bc3", "bc4", "bc5"}
    assert R.subject_search(tiny, "the of").count() == 0


names = st.lists(st.one_of(st.none(), st.text("ab ,", max_size=3)), max_size=4)


@settings(max_examples=15, deadline=None)
@given(st.lists(names, min_size=1, max_size=5))
def test_array_pass_equals_explode_group_by(spark, rows):
    """T2 as an array pass == element expansion + GROUP BY with string_agg semantics."""
    df = spark.createDataFrame([(i, [{"name": n} for n in r]) for i, r in enumerate(rows)],
                               "id int, contributors array<struct<name:string>>")
    ours = df.filter(F.size("contributors") > 0).select(
        "id", T.string_agg(F.transform("contributors", lambda c: c.getField("name"))).alias("v"))
    exploded = df.select("id", F.posexplode("contributors").alias("pos", "c"))
    ref = exploded.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.col("c.name").isNotNull(), F.struct("pos", "c.name")))).alias("s"))
    ref = ref.select("id", F.when(F.size("s") > 0, F.array_join(F.transform("s", lambda e: e.getField("name")), ", "))
                     .alias("v"))
    assert sorted(ours.collect()) == sorted(ref.collect())
