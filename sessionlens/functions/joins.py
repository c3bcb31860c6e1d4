"""A left join whose hot keys adaptive execution can split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1024


def split_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
               spread_nulls: Sequence[str] = ()) -> DataFrame:
    """``left`` LEFT JOIN ``right`` (one row per key) on the keys, with
    ``right_key`` dropped from the right side.

    An aggregate on the join key leaves its output dealt by that key, so the
    join reads it without a shuffle of its own and AQE sees no skewed shuffle to
    split. A second key, zero on both sides, makes both sides plain shuffles
    of the join. With ``spread_nulls`` rows with a null key, which match
    nothing, get a second key from those columns instead of meeting in one task.
    """
    zero = F.pmod(F.xxhash64(left_key), F.lit(1))  # not a literal: the planner must keep it
    if spread_nulls:
        zero = F.when(F.col(left_key).isNull(), F.pmod(F.xxhash64(*spread_nulls), F.lit(SPREAD))).otherwise(zero)
    a = left.withColumn("_second", zero)
    b = (right.withColumnRenamed(right_key, "_key")
         .withColumn("_zero", F.pmod(F.xxhash64("_key"), F.lit(1))))
    return (a.join(b, (F.col(left_key) == F.col("_key")) & (F.col("_second") == F.col("_zero")), "left")
            .drop("_second", "_zero", "_key"))
