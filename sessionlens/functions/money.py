"""Money and ratio expressions that lose nothing.

Amounts that are whole cents are summed as integers, so a total does not
depend on the order in which partitions are merged, and a mean of them is
rounded half-up from the integer quotient. Every other amount (a fraction of a
cent, NaN, an infinity, a huge number) is summed as the double it is and added
to the total: nothing is cut to cents, dropped or raised.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_CENT_AMOUNT = 1e13  # amounts below it have exact cents in a double


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: str | Column) -> Column:
    """The amount in cents, or null when it is not a whole number of cents."""
    x = _c(col).cast("double")
    whole = F.round(x * 100)
    return F.when((F.abs(x) < MAX_CENT_AMOUNT) & (whole / 100 == x), whole.cast("decimal(18,0)"))


def rest(col: str | Column) -> Column:
    """The amount when it is not a whole number of cents."""
    return F.when(cents(col).isNull(), _c(col).cast("double"))


def total_of(cent_sum: Column, rest_sum: Column) -> Column:
    """Total, as double, of a sum of cents and a sum of other amounts."""
    whole = cent_sum.cast("double") / F.lit(100.0)
    return F.when(rest_sum.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest_sum)


def mean_of(cent_sum: Column, rest_sum: Column, n: Column) -> Column:
    """Mean rounded half-up to cents: exact on integers when all are cents."""
    double = (F.abs(cent_sum) * 2 + n).cast("decimal(38,0)")
    by = (n * 2).cast("decimal(20,0)")
    # the remainder goes first, so the quotient is a whole number
    whole = F.try_divide(double - F.try_mod(double, by), by).cast("double") * F.signum(cent_sum.cast("double"))
    return (F.when(rest_sum.isNull(), whole / F.lit(100.0) + F.lit(0.0))
            .otherwise(F.round(F.try_divide(total_of(cent_sum, rest_sum), n), 2)))


def money_sum(col: str | Column) -> Column:
    """Sum of amounts, as double (null when all inputs are null)."""
    return total_of(F.sum(cents(col)), F.sum(rest(col)))


def money_avg(col: str | Column) -> Column:
    """Mean of amounts rounded half-up to cents."""
    return mean_of(F.sum(cents(col)), F.sum(rest(col)), F.count(_c(col)))


def money_avg_raw(col: str | Column) -> Column:
    """Unrounded mean of amounts."""
    return F.try_divide(money_sum(col), F.count(_c(col)))


def percent(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``round(part * 100 / whole, scale)``; null instead of an error when
    ``whole`` is zero (ANSI mode raises on division by zero)."""
    return F.round(F.try_divide(_c(part) * F.lit(100.0), _c(whole)), scale)


def safe_ratio(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``default`` (guarded ratio)."""
    return F.when(_c(den) > 0, _c(num) / _c(den)).otherwise(F.lit(default))
