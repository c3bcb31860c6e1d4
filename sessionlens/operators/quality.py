"""Data-quality profile and table summary.

The reference runs up to six jobs per column. Here the profile is a few passes
over the input whatever its width, each reading only the columns it needs:
counts, nulls and moments in one ``agg``; exact distinct counts from one
grouping of (column number, short value), where a long text goes by its
digest, so no text is shuffled; quartiles in two narrow passes; outliers
against the one-row bounds (broadcast). ``exact=False`` uses
``approx_count_distinct`` and the quantile sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sessionlens.functions.quantiles import quantiles
from sessionlens.schema import IQR_FENCE, QUANTILE_REL_ERROR

NUMERIC_TYPES = ("integer", "double", "long")
NA = "N/A"


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), whole)


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NA))


def _fixed2(value: Column) -> Column:
    # format_string renders a null argument as text ("nu" at %.2f): guard it
    return F.when(value.isNotNull(), F.format_string("%.2f", value)).otherwise(F.lit(NA))


def _short(df: DataFrame, name: str) -> Column:
    """A short stand-in for a value: itself as text, or the digest of a long text."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, StringType):
        return c.cast("string")
    return F.when(F.octet_length(c) > 32, F.concat(F.lit("#"), F.md5(c))).otherwise(F.concat(F.lit("="), c))


def distinct_counts(df: DataFrame) -> DataFrame:
    """One row: exact distinct non-null values of every column (``_dist0``...)."""
    cells = [F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), _short(df, c).alias("v")))
             for i, c in enumerate(df.columns)]
    values = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
              .groupBy("i", "v").agg(F.lit(1).alias("one")))
    return values.agg(*[F.count_if(F.col("i") == i).alias(f"_dist{i}") for i in range(len(df.columns))])


def data_quality(df: DataFrame, *, exact: bool = False,
                 rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """One row per column: column_name, data_type, total_count, null_count,
    null_percent, distinct_count, distinct_percent, min_value, max_value,
    mean, stddev, outlier_count, outlier_percent.

    Nulls (and blanks in string columns) are missing; a null counts as one
    distinct value. Numeric stats only for integer/long/double columns,
    otherwise "N/A". Percentages are null on an empty table.
    """
    cols = df.columns
    kinds = {c: df.schema[c].dataType.typeName() for c in cols}
    numeric = [c for c in cols if kinds[c] in NUMERIC_TYPES]

    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(cols):
        col = F.col(c)
        aggs += [F.count_if(_missing(df, c)).alias(f"_null{i}"),
                 F.coalesce(F.max(col.isNull().cast("long")), F.lit(0)).alias(f"_blank{i}")]
        if not exact:
            aggs.append(F.approx_count_distinct(col).alias(f"_dist{i}"))
        if c in numeric:
            aggs += [F.min(col).alias(f"_min{i}"), F.max(col).alias(f"_max{i}"),
                     F.avg(col).alias(f"_mean{i}"), F.stddev_samp(col).alias(f"_sd{i}")]
    stats = df.agg(*aggs)
    if exact:
        stats = stats.crossJoin(F.broadcast(distinct_counts(df)))

    if numeric:
        q = quantiles(df, numeric, [0.25, 0.75], exact=exact, rel_error=rel_error)
        fences = []
        for c in numeric:
            q1, q3 = F.element_at(c, 1), F.element_at(c, 2)
            fences += [(q1 - F.lit(IQR_FENCE) * (q3 - q1)).alias(f"_lo_{c}"),
                       (q3 + F.lit(IQR_FENCE) * (q3 - q1)).alias(f"_hi_{c}")]
        bounds = q.select(*fences)
        outliers = (df.select(*numeric).crossJoin(F.broadcast(bounds))
                    .agg(*[F.count_if((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}")))
                           .alias(f"_out_{c}") for c in numeric]))
        stats = stats.crossJoin(F.broadcast(outliers))

    total = F.col("_total")
    rows = []
    for i, c in enumerate(cols):
        if c in numeric:
            lo, hi, mean, sd = (_text(F.col(f"_min{i}")), _text(F.col(f"_max{i}")),
                                _fixed2(F.col(f"_mean{i}")), _fixed2(F.col(f"_sd{i}")))
            out = F.col(f"_out_{c}")
        else:
            lo = hi = mean = sd = F.lit(NA)
            out = F.lit(0).cast("long")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"),
            total.alias("total_count"), F.col(f"_null{i}").alias("null_count"),
            _pct(F.col(f"_null{i}"), total).alias("null_percent"),
            (F.col(f"_dist{i}") + F.col(f"_blank{i}")).alias("distinct_count"),
            _pct(F.col(f"_dist{i}") + F.col(f"_blank{i}"), total).alias("distinct_percent"),
            lo.alias("min_value"), hi.alias("max_value"), mean.alias("mean"), sd.alias("stddev"),
            out.alias("outlier_count"), _pct(out, total).alias("outlier_percent")))
    return stats.select(F.inline(F.array(*rows)))


def table_summary(df: DataFrame) -> DataFrame:
    """One row: row_count (a distributed count) and column_count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)))


def table_schema(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, filled): the schema, and how many rows
    have a value in each column, from one aggregate."""
    filled = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return filled.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_{i}").alias("filled"))
        for i, f in enumerate(df.schema.fields)])))


def table_preview(df: DataFrame, n: int = 5, order: str | None = None) -> DataFrame:
    """The first ``n`` rows, by ``order`` where given (top-k per task)."""
    return df.limit(n) if order is None else df.orderBy(order).limit(n)
