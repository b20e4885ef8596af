"""Rewritten forms against the plain ones on random data: R1, lateral expansion, ordered aggregates, JSON text."""

import json
import random

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import json_text as jt
from shelfmark.operators import reports as R
from shelfmark.operators import templates as T
from shelfmark.plans.joins import expand
from shelfmark.sources import Catalogue
from shelfmark.sources.schemas import RAW_TABLES

NAIVE_R1 = """
SELECT ie.created_date, ie.effective_location_name, ihi.call_number, ihi.barcode, ihi.title, ihi.material_type_name,
       ihi.cataloged_date, isc.statistical_code_name, li.item_status, li.loan_date, li.loan_return_date, li.renewal_count,
       first((SELECT count(*) FROM loans_items x WHERE x.item_id = ihi.item_id)) AS total_checkouts,
       array_sort(collect_set(n.note) FILTER (WHERE n.note_type_name = 'Staff Note')) AS item_notes,
       array_sort(collect_set(ii.identifier)) AS instance_identifiers,
       array_sort(collect_set(ip.date_of_publication)) AS instance_publication,
       array_sort(collect_set(lower(get_json_object(s.subjects, '$.value')))) AS subjects
FROM item_ext ie JOIN items_holdings_instances ihi ON ihi.item_id = ie.item_id
     JOIN item_statistical_codes isc ON isc.item_id = ie.item_id
     JOIN instance_subjects s ON s.instance_id = ihi.instance_id
     JOIN instance_publication ip ON ip.instance_id = s.instance_id
     JOIN instance_identifiers ii ON ii.instance_id = ip.instance_id
     JOIN item_notes n ON n.item_id = isc.item_id
     JOIN loans_renewal_count r ON r.item_id = ie.item_id
     JOIN loans_items li ON li.item_id = ie.item_id
WHERE ihi.call_number BETWEEN 'B' AND 'T'
GROUP BY ie.created_date, ie.effective_location_name, ihi.call_number, ihi.barcode, ihi.title, ihi.material_type_name, ihi.cataloged_date,
         isc.statistical_code_name, li.item_status, li.loan_date, li.loan_return_date, li.renewal_count, ihi.item_id"""
LISTS = ("item_notes", "instance_identifiers", "instance_publication", "subjects")


def random_catalogue(spark, seed):
    r = random.Random(seed)

    def some(values, most=3):
        return [r.choice(values) for _ in range(r.randrange(most + 1))]

    def members(name, values):
        return [{name: v} if v is not None else {} for v in some(values)]

    codes, types = ["c1", "c2", "c9"], [jt.STAFF_NOTE, jt.PRICE_NOTE, "unknown"]
    rows = {name: [] for name in RAW_TABLES}
    for i in range(10):
        rows["instance"].append({"id": f"ins{i}", "doc": {
            "title": "t", "subjects": members("value", ["Red", "RED", "blue", None]), "identifiers": members("value", ["1", "2", None]),
            "publication": members("dateOfPublication", ["1990", "1991", None]), "statisticalCodeIds": some(codes)}})
        rows["holdings_record"].append({"id": f"h{i}", "instanceid": f"ins{i}", "permanentlocationid": "loc1", "doc": {
            "instanceId": f"ins{i}", "callNumber": r.choice(["A 1", "B", "QA 1", "QA 2", "T", "Z", None])}})
    for i in range(25):
        rows["item"].append({"id": f"it{i}", "holdingsrecordid": f"h{r.randrange(11)}", "effectivelocationid": r.choice(["loc1", "loc9"]),
                             "materialtypeid": "mt", "doc": {
            "barcode": r.choice(["b1", "b2", None]), "statisticalCodeIds": some(codes), "metadata": {"createdDate": "2020-01-01T00:00:00Z"},
            "notes": [{"itemNoteTypeId": r.choice(types), "note": v} for v in some(["x", "y", None])]}})
    for i in range(60):
        rows["loan"].append({"id": f"l{i}", "doc": {
            "itemId": f"it{r.randrange(18)}", "userId": "u", "itemStatus": r.choice(["out", None]), "renewalCount": r.randrange(2),
            "loanDate": r.choice(["2020-01-01T00:00:00Z", "2020-01-02T00:00:00Z", "bad", None])}})
    rows["location"].append({"id": "loc1", "doc": {"name": "Main"}})
    rows["material_type"].append({"id": "mt", "doc": {"name": "BOOK"}})
    rows["statistical_code"] += [{"id": "c1", "doc": {"name": "One"}}, {"id": "c2", "doc": {"name": "One"}}]
    rows["item_note_type"] += [{"id": jt.STAFF_NOTE, "doc": {"name": "Staff Note"}}, {"id": jt.PRICE_NOTE, "doc": {"name": "Price"}}]

    def table(name):
        keys, _ = RAW_TABLES[name]
        schema = ", ".join(["id string", *[f"{k} string" for k in keys], "jsonb string"])
        return spark.createDataFrame([(x["id"], *[x.get(k) for k in keys], json.dumps(x["doc"])) for x in rows[name]], schema)

    return Catalogue(spark, {name: table(name) for name in RAW_TABLES})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_r1_equals_the_naive_fan_out(spark, seed):
    cat = random_catalogue(spark, seed)
    for name in ("item_ext", "items_holdings_instances", "item_statistical_codes", "instance_subjects", "instance_publication",
                 "instance_identifiers", "item_notes", "loans_renewal_count", "loans_items"):
        cat.derived(name).createOrReplaceTempView(name)
    naive = spark.sql(NAIVE_R1)
    for name in LISTS:
        naive = naive.withColumn(name, F.when(F.size(name) > 0, F.array_join(name, ", ")))
    ours = R.call_number_list(cat, "B", "T")
    rows = ours.collect()
    assert rows and sorted(map(repr, rows)) == sorted(map(repr, naive.select(*ours.columns).withColumn(
        "total_checkouts", F.col("total_checkouts").cast("int")).collect()))


def test_r1_count_is_a_decorrelated_subquery_on_the_shared_exchange(cat):
    df = R.call_number_list(cat, "A", sort=False)
    assert "scalar-subquery" in df._jdf.queryExecution().analyzed().toString()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Subquery" not in plan.replace("SubqueryBroadcast", "") and "ReusedExchange" in plan


elements = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.text("ab", max_size=2)), max_size=3))


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(st.lists(elements, min_size=1, max_size=5))
def test_lateral_expansion_equals_posexplode(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "k int, a array<string>")
    for keep, plain in ((False, F.posexplode), (True, F.posexplode_outer)):
        ours, theirs = expand(df, "a", "p", "e", keep).select("k", "p", "e"), df.select("k", plain("a").alias("p", "e"))
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))


def test_lateral_expansion_stays_in_the_scan_stage(cat):
    for name, member in (("instance_subjects", "subjects"), ("instance_publication", "publication"), ("instance_identifiers", "identifiers")):
        plan = cat.computed().derived(name)._jdf.queryExecution().executedPlan().toString()
        assert "Generate posexplode" in plan and "Exchange" not in plan and "Join" not in plan
        schema = plan.split("ReadSchema: ")[1]
        assert member in schema and "title" not in schema and "contributors" not in schema


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(st.lists(st.lists(st.tuples(st.sampled_from([jt.STAFF_NOTE, jt.PRICE_NOTE, "unknown"]), st.one_of(st.none(), st.text("ab ,", max_size=2))), max_size=4),
                min_size=1, max_size=4))
def test_notes_aggregate_in_array_order(spark, items):
    """T7's listagg within group equals joining each item's array, with unknown kinds and missing texts left out."""
    names = {jt.STAFF_NOTE: "Staff Note", jt.PRICE_NOTE: "Price"}
    cat = random_catalogue(spark, 0)
    docs = [(f"it{i}", None, None, None, None, None, json.dumps({"notes": [{"itemNoteTypeId": t, "note": n} for t, n in notes]})) for i, notes in enumerate(items)]
    cat._raw["item"] = spark.createDataFrame(docs, cat._raw["item"].schema)

    def joined(notes):
        return ", ".join(notes) if notes else None

    want = {(f"it{i}", joined([n for t, n in notes if t in names and n is not None]), joined([n for t, n in notes if t == jt.STAFF_NOTE and n is not None]))
            for i, notes in enumerate(items) if any(t in names for t, _ in notes)}
    assert {tuple(r) for r in T.item_notes(cat).collect()} == want


def test_subject_list_from_json_text_equals_the_array_pass(cat):
    """F-J9: the derived table's JSON text gives the lists that R1 computes from the parsed document."""
    mine = {r.instance_id: r.subjects for r in R.instance_subject_list(cat).collect()}
    barcode = {r.barcode: r.instance_id for r in cat.derived("items_holdings_instances").collect()}
    rows = R.call_number_list(cat, "A", sort=False).collect()
    assert rows and all(r.subjects == mine[barcode[r.barcode]] for r in rows)
    plan = R.instance_subject_list(cat)._jdf.queryExecution().executedPlan().toString()
    assert "from_json(StructField(value" in plan
