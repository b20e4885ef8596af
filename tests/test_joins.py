"""The skew-safe left join returns exactly the rows of a plain left outer join."""

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.plans.joins import left_join_skewed_right

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"]))


@settings(max_examples=10, deadline=None)
@given(st.lists(keys, max_size=6, unique=True), st.lists(st.tuples(keys, st.integers(0, 3)), max_size=12))
def test_equals_left_outer_join(spark, left_keys, right_rows):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(left_keys)], "k string, l int")
    right = spark.createDataFrame(right_rows + [("hot", 9)] * 5, "k string, r int")
    ours = left_join_skewed_right(left, right, "k").select("k", "l", "r")
    plain = left.join(right, "k", "left").select("k", "l", "r")
    assert sorted(ours.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_hot_key_is_split(spark):
    """The planner's own exchanges are used, so AQE splits a hot key of the right side."""
    from pyspark.sql import functions as F

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        right = spark.range(60000).select(F.when(F.col("id") % 10 < 6, F.lit(1)).otherwise(F.col("id") % 5000).cast("string").alias("k"),
                                          F.sha2(F.col("id").cast("string"), 256).alias("r")).repartition(8)
        left = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("l"))
        out = left_join_skewed_right(left, right, "k")
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
