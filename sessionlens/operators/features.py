"""Derived columns: calendar, length bucket, purchase flag, rating bucket,
per-user session numbering and per-user history features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampType

from sessionlens.functions.joins import split_join
from sessionlens.functions.money import money_avg_raw, safe_ratio
from sessionlens.schema import (REVIEW_NEGATIVE, REVIEW_NEUTRAL, REVIEW_POSITIVE,
                                REVIEW_UNRATED, SESSION_LONG, SESSION_MEDIUM,
                                SESSION_SHORT)


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    t = F.col(ts)
    return df.withColumns({
        "date": F.to_date(t),
        "hour": F.hour(t),
        "day_of_week": F.date_format(t, "EEEE"),
        "month": F.month(t),
        "year": F.year(t),
    })


def session_category(df: DataFrame) -> DataFrame:
    d = F.col("session_duration")
    return df.withColumn("session_category",
                         F.when(d < 5, SESSION_SHORT)
                         .when((d >= 5) & (d < 15), SESSION_MEDIUM)
                         .otherwise(SESSION_LONG))


def purchase_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("has_purchased",
                         F.when(F.col("purchase_amount") > 0, 1).otherwise(0))


def review_category(df: DataFrame) -> DataFrame:
    r = F.col("review_score")
    return df.withColumn("review_category",
                         F.when(r <= 2, REVIEW_NEGATIVE)
                         .when(r == 3, REVIEW_NEUTRAL)
                         .when(r >= 4, REVIEW_POSITIVE)
                         .otherwise(REVIEW_UNRATED))


HOT_ROWS = 100_000  # more rows of a few (user, minute) groups are numbered in parts
BUCKETS = 1 << 16


def _tie(df: DataFrame, tie: str | None) -> tuple[Column, list[Column]]:
    """A whole-number key that breaks ties of the time, and the order after it.

    ``None``: ``session_id`` where there is one, else a digest of the row
    followed by its columns, a total order over rows that differ at all."""
    if tie is None and "session_id" in df.columns:
        tie = "session_id"
    if tie is None:
        columns = [F.col(c) for c in df.columns]
        return F.xxhash64(*columns), columns
    if isinstance(df.schema[tie].dataType, IntegralType):
        return F.col(tie).cast("long"), []
    return F.lit(0).cast("long"), [F.col(tie)]


def _minute(df: DataFrame, ts: str) -> Column:
    """Minute bucket, never falling as time goes on. An instant is taken as it
    is: wall-clock hours run backwards when daylight saving ends."""
    t = F.col(ts)
    if isinstance(df.schema[ts].dataType, TimestampType):
        return F.floor(F.unix_seconds(t) / 60)
    return (F.unix_date(F.to_date(t)) * 1440 + F.hour(t) * 60 + F.minute(t)).cast("long")


def _order_keys(df: DataFrame, user: str, ts: str, tie_key: Column, groups: list[str]) -> DataFrame:
    t = F.col(ts)
    return df.withColumns({
        "_u_null": F.col(user).isNull(),
        "_u": F.coalesce(F.col(user).cast("string"), F.lit("")),
        "_d_null": t.isNull(),
        "_d": F.coalesce(_minute(df, ts), F.lit(0).cast("long")),
        "_tie": F.coalesce(tie_key, F.lit(0).cast("long")),
    }).withColumns({
        # one number that never falls as (second, tie) goes up
        "_at": F.coalesce(F.second(t), F.lit(0)).cast("double") * float(1 << 63) * 2 + F.col("_tie").cast("double"),
        "_bucket": F.pmod(F.xxhash64(*groups), F.lit(BUCKETS)),
    })


def session_number(df: DataFrame, *, tie: str | None = None, user: str = "user_id",
                   ts: str = "timestamp", hot_rows: int = HOT_ROWS,
                   hot_from: DataFrame | None = None) -> DataFrame:
    """``row_number`` of each session within its user, by (timestamp, tie).

    A single user may own a third of all rows, so rows are numbered inside
    (user, minute) groups and shifted by the number of the user's sessions
    before. One group may be hot too: one instant of a bulk load, or all rows
    of a user without a time. The keys are counted by hash bucket first, which
    combines before the shuffle; buckets of more than ``hot_rows`` rows (and a
    thousandth of all, so at most a thousand) are numbered in parts, ranges of
    their (second, tie) span.

    ``hot_from``: a table whose rows include those of ``df`` (the raw sessions), to
    count the buckets on instead: the numbers stay the same, and it reads the
    three order columns only, without what cleaning joins and filters by.

    The sizes come from a narrow count of the keys; the wide rows are shuffled
    and sorted once, by the group keys. ``df`` is read three times, twice by its order
    columns only: if it is dear to derive, write it first (``stage(how="table")``). Null users and null timestamps are
    numbered too (null-flag keys; a null time comes first).
    """
    groups = ["_u_null", "_u", "_d_null", "_d"]
    names = [*groups, "_part"]
    tie_key, after = _tie(df, tie)
    t = F.col(ts)
    keyed = _order_keys(df, user, ts, tie_key, groups)
    counted = keyed
    if hot_from is not None:
        hot_tie, more = _tie(hot_from, tie)
        if not after and not more:  # else ties are broken by columns that the tables do not share
            counted = _order_keys(hot_from, user, ts, hot_tie, groups)
    buckets = counted.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("low"),
                                             F.max("_at").alias("high"))
    found = buckets.agg(F.collect_list(F.struct("_bucket", "n", "low", "high")).alias("all"),
                        F.sum("n").alias("rows"))
    least = F.greatest(F.lit(hot_rows), F.col("rows") / 1000)
    # at most a thousand buckets hold over a thousandth of the rows each
    hot = found.select(F.map_from_entries(F.transform(
        F.filter("all", lambda g: g["n"] > least),
        lambda g: F.struct(g["_bucket"], F.struct(F.ceil(g["n"] / least).alias("parts"), g["low"].alias("low"),
                                                  g["high"].alias("high"))))).alias("hot")).scalar()
    span = F.try_element_at(hot, F.col("_bucket"))  # one subquery, however often it is read
    part = F.when(span["high"] > span["low"], F.least(
        F.floor((F.col("_at") - span["low"]) / (span["high"] - span["low"]) * span["parts"]), span["parts"] - 1))
    keyed = keyed.withColumn("_part", F.coalesce(part, F.lit(0).cast("long")))
    local = keyed.withColumn("_local", F.row_number().over(
        Window.partitionBy(*names).orderBy(t, "_tie", *after)))
    earlier = (Window.partitionBy("_u_null", "_u")
               .orderBy(F.col("_d_null").desc(), "_d", "_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
               .select(*names, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off")))
    return (local.join(offsets, names, "left")
            .withColumn("session_number", (F.col("_local") + F.col("_off")).cast("int"))
            .drop(*names, "_tie", "_at", "_bucket", "_local", "_off"))


def transform(df: DataFrame, *, tie: str | None = None, hot_from: DataFrame | None = None) -> DataFrame:
    """Whole enrichment: calendar, length bucket, purchase flag, rating
    bucket, session number. Unused derived columns are pruned by Catalyst
    (an unreferenced ``session_number`` removes its window and join)."""
    out = review_category(purchase_flag(session_category(time_features(df))))
    return session_number(out, tie=tie, hot_from=hot_from)


def pages_per_minute(df: DataFrame) -> DataFrame:
    return df.withColumn("pages_per_minute",
                         safe_ratio(F.col("pages_viewed"), F.col("session_duration")))


def user_history(df: DataFrame) -> DataFrame:
    """Per-user averages and counts (hash aggregate with map-side combine,
    so a hot user costs one partial row per input partition)."""
    return (df.groupBy("user_id")
            .agg(money_avg_raw("purchase_amount").alias("avg_purchase_amount"),
                 F.sum("has_purchased").alias("total_purchases"),
                 F.count(F.lit(1)).alias("total_sessions"))
            .withColumn("purchase_frequency",
                        F.col("total_purchases") / F.col("total_sessions")))


def session_features(df: DataFrame) -> DataFrame:
    """Sessions + pages_per_minute + the user's history (left join; a null
    user gets null history). A hot user is split by AQE's skew join."""
    return split_join(pages_per_minute(df), user_history(df), "user_id", "user_id",
                      spread_nulls=["timestamp", "session_duration"]).select(
        *df.columns, "pages_per_minute", "avg_purchase_amount", "total_purchases", "total_sessions",
        "purchase_frequency")
