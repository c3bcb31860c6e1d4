"""Quantile cut points as a one-row DataFrame, computed on the executors.

Two modes:

* ``exact=False`` — ``percentile_approx`` (Greenwald-Khanna sketch, bounded
  memory per task, rank error <= rel_error * n). Matches the reference's
  ``approxQuantile`` guarantee and is the mode for very large inputs.
* ``exact=True`` — the ``ceil(p * n)``-th smallest value (``percentile_disc``
  semantics) in two passes, with no sort of all values and none through one
  task: a sketch of known rank error gives each cut point a bracket, low and
  high, that holds it; then the values below each bracket are counted and only
  the values inside are grouped and ranked. With ``accuracy`` a, a bracket
  holds about 4/a of the rows.

Either way the result has exactly one row and one ``array<double>`` column
per input column (same name), element ``i`` being quantile ``probs[i]``; an
input with no non-null value yields null. Join it with
``crossJoin(broadcast(q))``; it never goes through the driver.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def quantiles(df: DataFrame, cols: list[str], probs: list[float], *, exact: bool = False,
              rel_error: float = 0.05, accuracy: int = ACCURACY) -> DataFrame:
    if not exact:
        accuracy = max(1, int(round(1.0 / rel_error)))
        return df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c)
                        for c in cols])
    return _exact_quantiles(df, cols, probs, accuracy)


def _exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int) -> DataFrame:
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    # Pass 1: a sketch value is at most n/accuracy ranks off, so the ones two
    # such steps to either side hold the cut point between them.
    around = [min(1.0, max(0.0, p + side * 2.0 / accuracy)) for p in probs for side in (-1, 1)]
    brackets = values.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"_n{i}"), F.percentile_approx(c, around, accuracy).alias(f"_b{i}"))])

    # Pass 2: count what lies below each bracket, group what lies inside.
    low = lambda i, k: F.element_at(f"_b{i}", 2 * k + 1)
    high = lambda i, k: F.element_at(f"_b{i}", 2 * k + 2)
    both = values.crossJoin(F.broadcast(brackets))
    below = both.agg(*[F.count_if(F.col(c) < low(i, k)).alias(f"_u{i}_{k}")
                       for i, c in enumerate(cols) for k in range(len(probs))])
    slots = [F.when(F.col(c).between(low(i, k), high(i, k)),
                    F.struct(F.lit(i).alias("dim"), F.lit(k).alias("k"), F.col(c).alias("v")))
             for i, c in enumerate(cols) for k in range(len(probs))]
    inside = (both.select(F.explode(F.array_compact(F.array(*slots))).alias("s")).select("s.*")
              .groupBy("dim", "k", "v").agg(F.count(F.lit(1)).alias("c")))
    running = Window.partitionBy("dim", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (inside.withColumn("cum", F.sum("c").over(running))
              .crossJoin(F.broadcast(brackets.select(*[f"_n{i}" for i in range(len(cols))])))
              .crossJoin(F.broadcast(below)))

    # One global aggregate picks every cut point: the smallest value whose
    # running count reaches rank = ceil(p * n) (p as an exact fraction).
    out = []
    for i, c in enumerate(cols):
        picks = []
        for k, p in enumerate(probs):
            f = Fraction(p).limit_denominator(1_000_000)
            rank = F.expr(f"(_n{i} * {f.numerator} + {f.denominator - 1}) div {f.denominator}")
            reached = (F.col("dim") == i) & (F.col("k") == k) & (F.col("cum") + F.col(f"_u{i}_{k}") >= rank)
            picks.append(F.min(F.when(reached, F.col("v"))))
        out.append(F.when(F.max((F.col("dim") == i).cast("int")) == 1, F.array(*picks)).alias(c))
    return ranked.agg(*out)


def iqr_bounds(df: DataFrame, column: str, *, exact: bool = False,
               rel_error: float = 0.05, fence: float = 1.5) -> DataFrame:
    """One row ``(lower, upper)``: Q1 - fence*IQR and Q3 + fence*IQR."""
    q = quantiles(df, [column], [0.25, 0.75], exact=exact, rel_error=rel_error)
    q1, q3 = F.element_at(column, 1), F.element_at(column, 2)
    iqr = q3 - q1
    return q.select((q1 - F.lit(fence) * iqr).alias("lower"),
                    (q3 + F.lit(fence) * iqr).alias("upper"))
