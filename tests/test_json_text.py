"""Edge rows for the JSON projection helpers (FIXTURES.md part C)."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import json_text as jt
from shelfmark.sources.schemas import INSTANCE_DOC, ITEM_DOC
from shelfmark.operators.templates import string_agg


def _doc(spark, schema, obj):
    df = spark.createDataFrame([(json.dumps(obj),)], "jsonb string")
    return df.select(F.from_json("jsonb", schema).alias("j"))


def _one(df, col):
    return df.select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("first,last,expected", [("Jane", None, "Jane "), (None, None, None), (None, "Doe", " Doe"),
                                                 ("Jane", "Doe", "Jane Doe")])
def test_full_name_concat_semantics(spark, first, last, expected):
    df = spark.createDataFrame([(first, last)], "f string, l string")
    assert _one(df, jt.full_name(F.col("f"), F.col("l"))) == expected


def test_array_text_keeps_json_escapes_and_strips_brackets(spark):
    doc = _doc(spark, ITEM_DOC, {"notes": [
        {"itemNoteTypeId": jt.STAFF_NOTE, "note": 'a"b'},
        {"itemNoteTypeId": jt.STAFF_NOTE, "note": "[x]"},
        {"itemNoteTypeId": jt.STAFF_NOTE, "note": "c\\d"}]})
    assert _one(doc, jt.pg_array_text(jt.notes_of_type(F.col("j.notes"), jt.STAFF_NOTE))) == \
        '["a\\"b", "[x]", "c\\\\d"]'
    assert _one(doc, jt.note_text(F.col("j.notes"), jt.STAFF_NOTE)) == "a\\b, x, c\\\\d"


def test_note_by_type_none_is_null(spark):
    assert _one(_doc(spark, ITEM_DOC, {"notes": []}), jt.note_text(F.col("j.notes"), jt.PRICE_NOTE)) is None
    assert _one(_doc(spark, ITEM_DOC, {}), jt.note_text(F.col("j.notes"), jt.PRICE_NOTE)) is None
    # a note of the right type without text is skipped like a missing path member
    doc = _doc(spark, ITEM_DOC, {"notes": [{"itemNoteTypeId": jt.PRICE_NOTE}]})
    assert _one(doc, jt.note_text(F.col("j.notes"), jt.PRICE_NOTE)) is None


def test_subjects_none_is_empty_text(spark):
    assert _one(_doc(spark, INSTANCE_DOC, {}), jt.array_member_text(F.col("j.subjects"), "value")) == ""


def test_identifier_qualifiers_lazy_and_greedy(spark):
    doc = _doc(spark, INSTANCE_DOC, {"identifiers": [
        {"value": "978 : pbk"}, {"value": "979 : x $10.00"}, {"value": "980 : y $20.00"}, {"value": "z"}]})
    assert _one(doc, jt.identifiers_lazy(F.col("j.identifiers"))) == "978, 980, z"
    assert _one(doc, jt.identifiers_greedy(F.col("j.identifiers"))) == "978, z"


@pytest.mark.parametrize("notes,expected", [
    ([], "$0.00"),
    ([{"itemNoteTypeId": jt.PRICE_NOTE, "note": "12.00"}], "$12.00"),
    ([{"itemNoteTypeId": jt.PRICE_NOTE, "note": "$$12.00"}], "$12.00"),
])
def test_price_text(spark, notes, expected):
    assert _one(_doc(spark, ITEM_DOC, {"notes": notes}), jt.price_text(F.col("j.notes"))) == expected


def test_first_member_skips_elements_without_it(spark):
    doc = _doc(spark, INSTANCE_DOC, {"contributors": [{}, {"name": "B"}]})
    assert _one(doc, jt.path_first(F.col("j.contributors"), "name")) == "B"
    assert _one(doc, F.get(F.col("j.contributors"), 0).getField("name")) is None


def test_string_agg_all_null_is_null(spark):
    doc = _doc(spark, INSTANCE_DOC, {"publication": [{}]})
    names = F.transform(F.col("j.publication"), lambda p: p.getField("publisher"))
    assert _one(doc, string_agg(names)) is None


def test_due_date_text_keeps_written_date(spark):
    df = spark.createDataFrame([("2024-01-01T23:30:00.000-06:00",)], "s string")
    assert _one(df, F.col("s").cast("date").cast("string")) == "2024-01-01"


def test_balance_text_keeps_two_decimals(spark):
    df = spark.createDataFrame([('{"remaining": 400.50}',)], "jsonb string")
    from shelfmark.sources.schemas import ACCOUNT_DOC

    parsed = df.select(F.from_json("jsonb", ACCOUNT_DOC).alias("j"))
    assert _one(parsed, F.col("j.remaining").cast("decimal(38,2)").cast("string")) == "400.50"


def test_null_ordering_matches_source_database(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert [r.x for r in df.orderBy(F.col("x").asc_nulls_last()).collect()] == ["a", "b", None]
    assert [r.x for r in df.orderBy(F.col("x").desc_nulls_first()).collect()] == [None, "b", "a"]
