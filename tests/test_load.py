"""The load: canonical ids, rejected values, unique ids, and tables bucketed by instance."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import reports as R
from shelfmark.operators import templates as T
from shelfmark.session import checkpoint_dir
from shelfmark.sources import Catalogue, catalogue
from shelfmark.sources.checks import DuplicateIds, canonical_id, canonical_members
from shelfmark.sources.fixture import build_raw_tables

SMOKE = "/root/testdata/sf0.001"


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/test-{name}"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def conf(spark):
    before = {}

    def set_(**values):
        for k, v in values.items():
            k = "spark.sql." + k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield set_
    for k, v in before.items():
        spark.conf.set(k, v)


# ------------------------------------------------------------------------------ ids
def test_canonical_members(spark):
    doc = ("struct<userId:string,codeIds:array<string>,notes:array<struct<kindId:string,note:string>>>")
    text = json.dumps({"userId": " AB-C ", "codeIds": ["X ", None, "y"], "notes": [{"kindId": " Q", "note": " Keep "}, {}]})
    df = spark.createDataFrame([(text,), (None,), ("{}",)], "t string").select(F.from_json("t", doc).alias("j"))
    rows = [r[0] for r in df.select(canonical_members(F.col("j"), ("userId", "codeIds", "notes.kindId"))).collect()]
    assert rows[0].asDict(True) == {"userId": "ab-c", "codeIds": ["x", None, "y"],
                                    "notes": [{"kindId": "q", "note": " Keep "}, {"kindId": None, "note": None}]}
    assert rows[1] is None and rows[2].asDict(True) == {"userId": None, "codeIds": None, "notes": None}


def test_the_fixture_writes_untidy_ids_and_the_load_mends_them(spark, cat):
    raw = build_raw_tables(spark, SMOKE)
    for table, member in (("loan", "itemId"), ("loan", "userId"), ("holdings_record", "instanceId")):
        value = F.get_json_object("jsonb", f"$.{member}")
        assert raw[table].where(value != canonical_id(value)).count() > 0
        loaded = F.col(f"j.{member}")
        assert cat.doc(table).where(loaded != canonical_id(loaded)).count() == 0
    assert raw["item"].where(F.col("holdingsrecordid") != canonical_id(F.col("holdingsrecordid"))).count() > 0
    assert cat.doc("item").where("instance_id IS NULL").count() == 0  # every item finds its holdings record
    assert "PushedFilters: [IsNotNull(barcode), EqualTo(barcode" in _plan(R.item_link(cat, "30000000000010"))


# ------------------------------------------------------------------------------ rejects
def test_malformed_values_are_listed_and_the_load_completes(spark):
    raw = build_raw_tables(spark, SMOKE)
    bad = spark.createDataFrame([
        ("L1", json.dumps({"itemId": "x", "loanDate": "yesterday", "dueDate": "2024-13-01", "renewalCount": "many"})),
        ("L2", "{broken"), ("L3", None), ("L4", json.dumps({"itemId": "x", "loanDate": None}))], "id string, jsonb string")
    raw["loan"] = raw["loan"].limit(50).unionByName(bad)
    raw["accounts"] = raw["accounts"].limit(5).unionByName(spark.createDataFrame(
        [("A1", json.dumps({"remaining": "lots", "metadata": {"updatedDate": "2024-02-30"}}))], "id string, jsonb string"))
    cat = Catalogue(spark, raw).materialize(_folder(spark, "rejects"))
    mine = {tuple(r) for r in cat.rejects().where("id IN ('l1', 'l2', 'l3', 'l4', 'a1')").collect()}
    assert mine == {("loan", "l1", "loanDate", "yesterday"), ("loan", "l1", "dueDate", "2024-13-01"), ("loan", "l1", "renewalCount", "many"),
                    ("loan", "l2", "$", "{broken"), ("accounts", "a1", "remaining", "lots"), ("accounts", "a1", "metadata.updatedDate", "2024-02-30")}
    assert cat.flat("loan").where("id = 'l1' AND loan_date IS NULL AND due_date IS NULL AND item_id = 'x'").count() == 1
    assert "a1" not in {r.item_title for r in R.fee_balances(cat, min_fee=0).collect()}


# ------------------------------------------------------------------------------ unique ids
@pytest.mark.parametrize("ids,listed", [(("DUP", " dup "), ("dup", 2)), ((None,), (None, 1))])
def test_a_repeated_id_stops_the_load(spark, ids, listed):
    raw = build_raw_tables(spark, SMOKE)
    raw["instance"] = raw["instance"].limit(20).unionByName(spark.createDataFrame([(i, "{}") for i in ids], "id string, jsonb string"))
    folder = _folder(spark, f"duplicates-{len(ids)}")
    with pytest.raises(DuplicateIds, match="instance 1"):
        Catalogue(spark, raw).materialize(folder)
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/duplicate_ids").collect()] == [("instance", *listed)]


# ------------------------------------------------------------------------------ buckets
def test_joins_among_instances_holdings_items_and_loans_need_no_shuffle(cat, conf):
    conf(autoBroadcastJoinThreshold="10k")  # lookups are broadcast, the catalogue's tables are not
    assert cat.loans_colocated
    for name, df in {"R2": R.equipment_checkouts(cat), "R4": R.inventory_search(cat, sort=False), "R5": R.item_details(cat),
                     "R9": R.semester_loans(cat, sort=False)}.items():
        plan = _plan(df)
        assert "SortMergeJoin [instance_id" in plan, name
        for key in ("instance_id", "holdings_id"):
            assert f"Exchange hashpartitioning({key}" not in plan, (name, key)
        if name != "R9":  # its loans meet the patrons before they meet the items
            assert "Exchange hashpartitioning(item_id" not in plan, name


def test_a_new_session_reads_the_buckets(spark, cat):
    other = Catalogue.from_stored(spark.newSession(), cat.stored)
    assert other.buckets == cat.buckets and other.loans_colocated
    assert R.item_details(other).count() == R.item_details(cat).count()


def test_an_instance_with_most_loans_is_not_bucketed_and_its_join_is_split(spark, conf, monkeypatch):
    monkeypatch.setattr(catalogue, "LEAST_TO_MEASURE", 1000)
    raw = build_raw_tables(spark, SMOKE)
    hot = T.item_checkouts(Catalogue(spark, raw)).orderBy("item_id").first().item_id
    share = F.pmod(F.xxhash64("id"), F.lit(10)) < 6
    raw["loan"] = raw["loan"].withColumn("jsonb", F.when(share, F.regexp_replace("jsonb", r'"itemId":"[^"]*"', f'"itemId":"{hot}"')).otherwise(F.col("jsonb")))
    cat = Catalogue(spark, raw).materialize(_folder(spark, "hot"))
    assert "doc/item" in cat.buckets and not {"doc/loan", "flat/loan"} & set(cat.buckets)
    assert cat.colocated and not cat.loans_colocated
    want = sorted(map(repr, R.equipment_checkouts(cat.computed()).collect()))
    conf(autoBroadcastJoinThreshold="-1", adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
         adaptive__advisoryPartitionSizeInBytes="10k", adaptive__skewJoin__skewedPartitionFactor="2")
    loans = cat.flat("loan").join(cat.doc("item").withColumnRenamed("id", "item_id"), "item_id")
    loans.collect()
    assert "skew=true" in _plan(loans)
    assert sorted(map(repr, R.equipment_checkouts(cat).collect())) == want


def test_bucketed_reports_equal_computed_ones(cat):
    plain = cat.computed()
    for report in (R.equipment_checkouts, R.item_details, R.inventory_search, R.semester_loans):
        assert sorted(map(repr, report(cat).collect())) == sorted(map(repr, report(plain).collect()))
