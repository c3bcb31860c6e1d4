"""Cleaning: null audit, validity filter, imputation, IQR capping/removal.

Scalars are computed on the executors: the raw mean rating as a scalar
subquery, the IQR bounds as a one-row aggregate joined with
``crossJoin(broadcast(...))`` — a one-row side is the only thing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sessionlens.functions.quantiles import iqr_bounds
from sessionlens.schema import IQR_FENCE, QUANTILE_REL_ERROR


def _missing(df: DataFrame, name: str) -> Column:
    """Null, or blank for string columns only (a blank test on a numeric
    column would raise a cast error under ANSI mode)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, in column order, from one
    aggregate pass."""
    counts = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def is_valid(duration: str = "session_duration", pages: str = "pages_viewed") -> Column:
    """Duration and pages present and non-negative."""
    return (F.col(duration).isNotNull() & (F.col(duration) >= 0)
            & F.col(pages).isNotNull() & (F.col(pages) >= 0))


def valid_sessions(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def clean_sessions(df: DataFrame) -> DataFrame:
    """Validity filter, missing amount -> 0.0, missing rating -> mean rating
    of the *raw* table (before the filter). Column order is kept.

    The mean is a scalar subquery: Spark runs it as its own small aggregate
    and inlines the value, and drops it entirely from plans that never read
    ``review_score``."""
    mean = df.agg(F.avg("review_score")).scalar()
    return valid_sessions(df).withColumns({
        "purchase_amount": F.coalesce(F.col("purchase_amount"), F.lit(0.0)),
        "review_score": F.coalesce(F.col("review_score"), mean),
    })


def clean_audit(df: DataFrame) -> DataFrame:
    """Rows before and after the validity filter, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(is_valid()).alias("rows_after"))


def cap_outliers(df: DataFrame, column: str, *, exact: bool = False,
                 rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """Winsorize ``column`` to [Q1 - 1.5 IQR, Q3 + 1.5 IQR]. Nulls are kept;
    the column becomes double. No bounds (no values) means no capping."""
    bounds = iqr_bounds(df, column, exact=exact, rel_error=rel_error, fence=IQR_FENCE)
    c = F.col(column)
    capped = (F.when(c > F.col("_upper"), F.col("_upper"))
              .when(c < F.col("_lower"), F.col("_lower"))
              .otherwise(c.cast("double")))
    return (df.crossJoin(F.broadcast(bounds.toDF("_lower", "_upper")))
            .withColumn(column, capped)
            .drop("_lower", "_upper"))


def remove_outliers(df: DataFrame, column: str, *, exact: bool = False,
                    rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """Keep rows with ``column`` inside the IQR fences; nulls are dropped."""
    bounds = iqr_bounds(df, column, exact=exact, rel_error=rel_error, fence=IQR_FENCE)
    c = F.col(column)
    return (df.crossJoin(F.broadcast(bounds.toDF("_lower", "_upper")))
            .filter((c >= F.col("_lower")) & (c <= F.col("_upper")))
            .drop("_lower", "_upper"))
