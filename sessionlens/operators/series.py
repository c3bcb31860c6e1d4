"""Dashboard series: the aggregates behind each chart, plus all of them from
one scan with GROUPING SETS (one Expand, one shuffle) instead of one scan per
chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.money import percent
from sessionlens.schema import PAGES_MIN_SESSIONS, WEEKDAYS


def _sessions() -> Column:
    return F.count(F.lit(1)).alias("sessions")


def chart_category_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy("product_category").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "product_category"))


def _conversion(df: DataFrame, key: str) -> DataFrame:
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("total_sessions"),
                 F.sum("has_purchased").alias("purchases"),
                 percent(F.sum("has_purchased"), F.count(F.lit(1))).alias("conversion_rate"))
            .orderBy(F.desc("conversion_rate"), key))


def chart_conversion_by_category(df: DataFrame) -> DataFrame:
    return _conversion(df, "product_category")


def chart_conversion_by_device(df: DataFrame) -> DataFrame:
    return _conversion(df, "device_type")


def chart_sessions_by_hour(df: DataFrame) -> DataFrame:
    return (df.groupBy("hour").agg(_sessions(), F.sum("has_purchased").alias("purchases"))
            .orderBy("hour"))


def chart_review_distribution(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("review_score").isNotNull())
            .groupBy("review_score").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("review_score"))


def chart_purchase_by_pages(df: DataFrame, min_sessions: int = PAGES_MIN_SESSIONS) -> DataFrame:
    """Purchase rate per pages_viewed, only for buckets with more than
    ``min_sessions`` sessions (a HAVING on the aggregate)."""
    return (df.groupBy("pages_viewed")
            .agg(_sessions(), F.sum("has_purchased").alias("purchases"),
                 percent(F.sum("has_purchased"), F.count(F.lit(1))).alias("purchase_rate"))
            .filter(F.col("sessions") > min_sessions)
            .orderBy("pages_viewed"))


def weekday_index(day: Column) -> Column:
    """0 = Monday ... 6 = Sunday; -1 for anything else (sorts first)."""
    return F.coalesce(F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day), F.lit(0)).cast("int") - 1


def chart_sessions_by_day(df: DataFrame) -> DataFrame:
    """Weekday series in Monday-first order (order key carried as a column)."""
    return (df.groupBy("day_of_week").agg(_sessions(), F.sum("has_purchased").alias("purchases"))
            .withColumn("day_index", weekday_index(F.col("day_of_week")))
            .orderBy("day_index"))


# (series name, grouping column) of the combined dashboard table.
DASHBOARD_SERIES = [("category", "product_category"), ("hour", "hour"),
                    ("device", "device_type"), ("pages", "pages_viewed"),
                    ("weekday", "day_of_week"), ("rating", "review_score")]


def dashboard_series(df: DataFrame, min_sessions: int = PAGES_MIN_SESSIONS) -> DataFrame:
    """All chart series in one pass: (series, key, sessions, purchases, rate).

    One GROUPING SETS aggregate (Expand -> partial agg -> one shuffle).
    Keys are cast to text so the series share one column. The pages series
    keeps buckets with more than ``min_sessions`` sessions; the rating series
    skips unrated sessions — the same rules as the single charts.
    """
    cols = [c for _, c in DASHBOARD_SERIES]
    n = len(cols)
    grouped = (df.groupingSets([[c] for c in cols], *cols)
               .agg(F.grouping_id(*cols).alias("_gid"),
                    _sessions(), F.sum("has_purchased").alias("purchases"),
                    percent(F.sum("has_purchased"), F.count(F.lit(1))).alias("rate")))
    series, key = F, F
    for i, (name, c) in enumerate(DASHBOARD_SERIES):
        only_c = (1 << n) - 1 - (1 << (n - 1 - i))   # grouping_id when grouped by c alone
        hit = F.col("_gid") == only_c
        series = (series.when(hit, F.lit(name)))
        key = key.when(hit, F.col(c).cast("string"))
    keep = ~((F.col("series") == "pages") & (F.col("sessions") <= min_sessions)) & \
        ~((F.col("series") == "rating") & F.col("key").isNull())
    return (grouped.select(series.alias("series"), key.alias("key"),
                           "sessions", "purchases", "rate")
            .filter(keep))
