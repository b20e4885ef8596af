"""One query at a time: only what it reads is computed, with the rows and the checks of a whole load."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfmark.operators import reports as R
from shelfmark.session import checkpoint_dir
from shelfmark.sources import Catalogue
from shelfmark.sources.checks import DuplicateIds

TYPES = ["ECONOMY", "STANDARD", "STANDARD", "SMALL", "MEDIUM", "LARGE"]


def _tables(spark, folder, parts=60):
    day = dt.datetime(2001, 2, 3)
    rows = {
        "region": ([(0, "NORTH"), (1, "SOUTH")], "r_regionkey int, r_name string"),
        "nation": ([(n, f"N{n}", n % 2) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "part": ([(k, f"red part{k}", "B1", TYPES[k % 6], k % 50) for k in range(parts)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "customer": ([(k, f"C#{k}", "BUILDING") for k in range(7)], "c_custkey long, c_name string, c_mktsegment string"),
        "orders": ([(k, k % 7, 500.0 + k, day) for k in range(90)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        # the last line has no order
        "lineitem": ([(k, (k * 3 + n) % parts, k, n, float(k), "O" if k % 2 else "F", day) for k in range(91) for n in range(1, 4)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def tables(spark):
    return _tables(spark, f"{checkpoint_dir(spark)}/test-on-demand")


def _parts(spark, kind):
    root = f"{checkpoint_dir(spark)}/shelfmark-catalogue".removeprefix("file:")
    return {os.path.relpath(at, root).split("/", 1)[1] for at, _, files in os.walk(root) if "CURRENT" in files and kind in at}


def test_item_queries_read_no_loans_and_store_no_copy(spark, tables):
    for name in ("derived_item_ext", "derived_item_notes", "derived_instance_publication", "item_details_places", "item_link", "item_notes"):
        df = E.queries()[name](spark, tables)
        read = {f.rsplit("/", 2)[1] for f in df.inputFiles()}
        assert read and not read & {"lineitem.parquet", "orders.parquet"}, (name, read)


def test_a_report_that_reads_loans_twice_parses_them_once(spark, tables):
    df = E.queries()["semester_loans"](spark, tables)
    assert not [f for f in df.inputFiles() if "lineitem.parquet" in f]
    assert "parts/doc/loan" in _parts(spark, "parts")


def test_rows_equal_those_of_the_whole_load(spark, tables):
    whole = Catalogue.from_testdata(spark, tables).materialize(f"{checkpoint_dir(spark)}/test-on-demand-whole")
    for report, keep in ((R.semester_loans, E.SEMESTER_READS), (R.equipment_checkouts, ()), (R.item_details, ()),
                         (lambda c: R.call_number_list(c, "A"), E.CALL_NUMBER_READS),
                         (lambda c: R.inventory_search(c, subject="red -blue"), E.SUBJECT_READS)):
        rows = sorted(map(repr, report(Catalogue.on_demand(spark, tables, keep)).collect()))
        assert rows and rows == sorted(map(repr, report(whole).collect()))


def test_a_repeated_id_still_stops_every_query(spark):
    folder = _tables(spark, f"{checkpoint_dir(spark)}/test-on-demand-twice", parts=5)
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    customer.union(customer.limit(1)).write.mode("overwrite").parquet(f"{folder}/again")
    spark.read.parquet(f"{folder}/again").write.mode("overwrite").parquet(f"{folder}/customer.parquet")
    with pytest.raises(DuplicateIds, match="users 1"):
        E.queries()["derived_item_ext"](spark, folder)


def test_renewal_counts_cover_every_loan(spark, tables):
    found = E.queries()["derived_loans_renewal_count"](spark, tables)
    assert found.count() == 90 * 3  # every line that has an order
    item = F.substring("item_id", -4, 4).cast("int")
    assert found.where(item % 50 == 47).count() > 0
