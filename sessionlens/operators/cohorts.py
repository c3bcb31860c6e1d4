"""Monthly cohorts and retention.

Instead of joining every session back to its user's first session (a join
keyed by user, skewed when one user is hot), sessions are first combined to
one row per (user, month) — partial aggregation absorbs hot users — and the
user's first month is a window minimum over that small table (a user has at
most one row per calendar month). Results equal the join formulation: a null
user is dropped (the reference's inner join), a session without timestamp
lands in its cohort with a null month distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.money import cents, mean_of, percent, rest


def _label(year, month):
    """Cohort label ``year-month`` without zero padding (``2024-1``)."""
    return F.concat(year.cast("string"), F.lit("-"), month.cast("string"))


def user_cohorts(df: DataFrame) -> DataFrame:
    first = df.groupBy("user_id").agg(F.min("timestamp").alias("first_session"))
    return (first.withColumns({"cohort_year": F.year("first_session"),
                               "cohort_month": F.month("first_session")})
            .withColumn("cohort", _label(F.col("cohort_year"), F.col("cohort_month"))))


def _user_months(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    per_month = (df.filter(F.col("user_id").isNotNull())
                 .groupBy("user_id", F.year(ts).alias("y"), F.month(ts).alias("m"))
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum("has_purchased").alias("p"),
                      F.sum(cents("purchase_amount")).alias("s"),
                      F.sum(rest("purchase_amount")).alias("x"),
                      F.count("purchase_amount").alias("k")))
    first = F.min(F.col("y") * 12 + F.col("m") - 1).over(Window.partitionBy("user_id"))
    return (per_month.withColumn("_first", first)
            .withColumns({"cohort": _label(F.floor(F.col("_first") / 12), F.col("_first") % 12 + 1),
                          "months_since_first": (F.col("y") * 12 + F.col("m") - 1 - F.col("_first")).cast("int")}))


def cohort_activity(df: DataFrame) -> DataFrame:
    """Per (cohort, months_since_first): active users, purchases, mean amount."""
    return (_user_months(df)
            .groupBy("cohort", "months_since_first")
            .agg(F.count(F.lit(1)).alias("active_users"),
                 F.sum("p").alias("purchases"),
                 mean_of(F.sum("s"), F.sum("x"), F.sum("k")).alias("avg_purchase")))


def cohort_sizes(df: DataFrame) -> DataFrame:
    """Users active in their first month, per cohort."""
    return (_user_months(df)
            .filter(F.col("months_since_first") == 0)
            .groupBy("cohort")
            .agg(F.count(F.lit(1)).alias("initial_users")))


def cohort_retention(df: DataFrame) -> DataFrame:
    """Activity joined with cohort size; the size table has one row per
    calendar month, so the join broadcasts a calendar-bounded side."""
    activity = cohort_activity(df)
    sizes = (activity.filter(F.col("months_since_first") == 0)
             .select("cohort", F.col("active_users").alias("initial_users")))
    return (activity.join(F.broadcast(sizes), ["cohort"])
            .withColumn("retention_rate", percent(F.col("active_users"), F.col("initial_users")))
            .orderBy("cohort", "months_since_first"))
