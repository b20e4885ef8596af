"""Physical plan checks: pushdown, no Python outside the stemmer, R1 filters before it aggregates."""

from pyspark.sql import functions as F

from shelfmark.operators import reports as R
from shelfmark.plans.text_index import TextIndex, vocabulary


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_loan_list_predicates_reach_the_scan(cat):
    plan = _plan(R.loan_list(cat))
    assert "PushedFilters" in plan and "patron_group_name" in plan.split("PushedFilters")[1]


def test_call_number_range_reaches_the_scan(cat):
    plan = _plan(R.call_number_list(cat, "QA", "QA 3"))
    assert "GreaterThanOrEqual(call_number,QA)" in plan


def test_no_python_udf_without_full_text(cat):
    for df in (R.item_details(cat), R.equipment_checkouts(cat), R.inventory_search(cat),
               R.semester_loans(cat), R.call_number_list(cat, "A")):
        plan = _plan(df)
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_stemmer_is_the_only_python_step(cat):
    # Stored catalogue: the vocabulary was stemmed at load, so the query runs without Python.
    assert "EvalPython" not in _plan(R.inventory_search(cat, subject="widgets"))
    assert "EvalPython" not in _plan(R.inventory_search(cat, subject="widgets", config="simple"))
    # Computed catalogue: the stemmer is an Arrow-batched pandas UDF, never row-at-a-time.
    plan = _plan(R.inventory_search(cat.computed(), subject="widgets"))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_python_sees_each_distinct_token_once(cat):
    """The only Python step of the index sits above the aggregation to distinct tokens, and reads nothing but them."""
    docs = cat.doc("instance").selectExpr("id", "j.title AS text")
    plan = vocabulary(docs, F.col("text"))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("ArrowEvalPython", 1)
    assert "HashAggregate(keys=[token" in below and "EvalPython" not in below
    index = TextIndex.build(docs, "id", F.col("text"))
    assert index.postings._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_term_lookup_reads_few_rows_of_the_stored_postings(cat):
    index = cat.subject_index()
    total = index.postings.count()
    lexeme = index.postings.groupBy("lexeme").count().orderBy("count", "lexeme").first().lexeme
    look = index.postings.where(F.col("lexeme") == lexeme)
    plan = look._jdf.queryExecution().executedPlan()
    assert "EqualTo(lexeme" in plan.toString()
    look.collect()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() <= total / 4


def test_call_number_list_cuts_loans_to_the_range(cat):
    """The loans are semi-joined to the selected items before they are aggregated."""
    plan = R.call_number_list(cat, "QA", "QA 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 2


def test_no_cross_join_or_row_python_in_any_registered_query(spark):
    """No registered query pairs rows without a key or runs row-at-a-time Python."""
    import __spark_entry__ as E

    for key, build in E.queries().items():
        if key in E.training_data_keys():  # these run jobs while they are built; tests/llm covers them
            continue
        plan = _plan(build(spark, "/root/testdata/sf0.001"))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (key, bad)
