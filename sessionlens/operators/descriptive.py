"""Descriptive aggregates: summary statistics, distributions, conversion,
Pearson correlation matrix. Each is one hash aggregate (partial + final)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.money import money_avg, percent
from sessionlens.schema import CORRELATION_COLUMNS, DESCRIBE_COLUMNS


def describe_sessions(df: DataFrame, cols: list[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """Typed summary, one row per column: count, mean, stddev (sample), min,
    max — all columns in a single aggregate, then stacked."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[F.col(f"{c}__{s}").alias(s) for s in ("count", "mean", "stddev", "min", "max")])
            for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def describe_text(df: DataFrame, cols: list[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """The reference's form: Spark's ``describe`` (summary rows count, mean,
    stddev, min, max as strings; one aggregate pass)."""
    return df.describe(*cols)


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Sessions, mean amount and mean rating per ``key``, most sessions first."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("count"),
                 money_avg("purchase_amount").alias("avg_purchase"),
                 F.round(F.avg("review_score"), 2).alias("avg_review"))
            .orderBy(F.desc("count"), F.asc(key)))


def category_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, "product_category")


def country_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, "country")


def _conversion_aggs():
    return [F.count(F.lit(1)).alias("total_sessions"),
            F.sum("has_purchased").alias("sessions_with_purchase"),
            percent(F.sum("has_purchased"), F.count(F.lit(1))).alias("conversion_rate_percent")]


def conversion_rate(df: DataFrame) -> DataFrame:
    """Global conversion; an empty table gives a null rate, not an error."""
    return df.agg(*_conversion_aggs())


def conversion_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(*_conversion_aggs())


def conversion_by_device(df: DataFrame) -> DataFrame:
    return conversion_by(df, "device_type")


def conversion_by_session_category(df: DataFrame) -> DataFrame:
    return conversion_by(df, "session_category")


def correlation_matrix(df: DataFrame, cols: list[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlation of every ordered pair, long form (feature1,
    feature2, correlation), highest first. All pairs come from ONE aggregate;
    the matrix is mirrored, and a constant column gives null instead of a
    division-by-zero error. Rows with a null in either column are skipped."""
    x = {c: F.col(c).cast("double") for c in cols}
    aggs = [F.try_divide(F.var_pop(x[c]), F.var_pop(x[c])).alias(f"{c}|{c}") for c in cols]
    for a, b in combinations(cols, 2):
        both = x[a].isNotNull() & x[b].isNotNull()
        xa, xb = F.when(both, x[a]), F.when(both, x[b])
        aggs.append(F.try_divide(F.covar_pop(xa, xb),
                                 F.stddev_pop(xa) * F.stddev_pop(xb)).alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    rows = []
    for a in cols:
        for b in cols:
            name = f"{a}|{b}" if f"{a}|{b}" in wide.columns else f"{b}|{a}"
            rows.append(F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"),
                                 F.col(f"`{name}`").alias("correlation")))
    return (wide.select(F.inline(F.array(*rows)))
            .orderBy(F.desc_nulls_last("correlation"), "feature1", "feature2"))
