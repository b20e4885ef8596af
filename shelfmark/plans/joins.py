"""Lateral expansion, and joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed shuffle partition only on a side whose rows may be duplicated
without changing the result: either side of an inner join, but only the preserved side
of an outer join.  A left outer join whose *right* side is skewed (many loans of one
item) would therefore run the hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand(df: DataFrame, array: str, position: str, element: str, keep_empty: bool = False) -> DataFrame:
    """``df CROSS JOIN LATERAL`` the elements of its array column, with their 0-based position.

    A row whose array is NULL or empty goes, or with ``keep_empty`` stays once with NULLs.  The planner turns the
    lateral join into a Generate in the scan's stage.  (The outer form is the table function's own: of a left
    lateral join Spark 4.1 drops the rows without elements.)
    """
    tvf = df.sparkSession.tvf
    rows = (tvf.posexplode_outer if keep_empty else tvf.posexplode)(F.col(array).outer())
    return df.lateralJoin(rows.toDF(position, element))


def left_join_skewed_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a right side that may be skewed on ``key``.

    Written as the inner join (splittable on both sides) plus the left rows that have
    no partner, found by an anti join against the *distinct* right keys (one row per
    key, so that side cannot be skewed).  Same rows as the outer join, including NULL
    keys on the left, which never match.
    """
    # No explicit repartition: AQE splits only the exchanges that the planner itself adds.
    matched = left.join(right, key, "inner")
    right_keys = right.select(key).distinct()
    unmatched = left.join(right_keys, key, "left_anti")
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    return matched.unionByName(unmatched.select(*left.columns, *extra))
