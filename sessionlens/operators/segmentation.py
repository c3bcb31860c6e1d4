"""Customer segmentation: per-user metrics, behaviour segments, RFM scoring.

The user table is one hash aggregate keyed by ``user_id`` (map-side combine
absorbs hot users). RFM cut points are a one-row aggregate joined back with
``crossJoin(broadcast(...))``; the library never collects them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.money import money_avg, money_sum, safe_ratio
from sessionlens.functions.quantiles import quantiles
from sessionlens.schema import (QUANTILE_REL_ERROR, RFM_ABOUT_TO_SLEEP, RFM_AT_RISK,
                                RFM_BIG_SPENDERS, RFM_CHAMPIONS, RFM_FREQUENT, RFM_LOST,
                                RFM_LOYAL, RFM_NEED_ATTENTION, RFM_POTENTIAL,
                                RFM_QUINTILES, RFM_RECENT, SEGMENT_LOYAL,
                                SEGMENT_NON_BUYER, SEGMENT_ONE_TIME, SEGMENT_REPEAT,
                                SEGMENT_UNKNOWN)

RFM_DIMENSIONS = ["recency_days", "frequency", "monetary"]


def user_metrics(df: DataFrame) -> DataFrame:
    return (df.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_sessions"),
                 F.sum("has_purchased").alias("total_purchases"),
                 money_avg("purchase_amount").alias("avg_purchase_value"),
                 F.round(money_sum("purchase_amount"), 2).alias("customer_lifetime_value"),
                 F.round(F.avg("review_score"), 2).alias("avg_rating"),
                 F.max("timestamp").alias("last_session"))
            .withColumn("purchase_frequency",
                        safe_ratio(F.col("total_purchases"), F.col("total_sessions"))))


def behavior_segments(metrics: DataFrame) -> DataFrame:
    p = F.col("total_purchases")
    return metrics.withColumn("user_segment",
                              F.when(p == 0, SEGMENT_NON_BUYER)
                              .when(p == 1, SEGMENT_ONE_TIME)
                              .when((p >= 2) & (p < 5), SEGMENT_REPEAT)
                              .when(p >= 5, SEGMENT_LOYAL)
                              .otherwise(SEGMENT_UNKNOWN))


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Users, mean lifetime value and mean rating per segment. The inputs are
    already rounded to cents, so the means are exact decimal means."""
    return (segments.groupBy("user_segment")
            .agg(F.count(F.lit(1)).alias("count"),
                 money_avg("customer_lifetime_value").alias("avg_clv"),
                 money_avg("avg_rating").alias("avg_rating"))
            .orderBy(F.desc("count"), "user_segment"))


def rfm_base(metrics: DataFrame, as_of: str | dt.date | Column | None = None) -> DataFrame:
    """Recency in days before ``as_of`` (default: today), frequency, monetary."""
    if as_of is None:
        ref = F.current_date()
    elif isinstance(as_of, Column):
        ref = as_of
    else:
        ref = F.lit(str(as_of)).cast("date")
    return metrics.withColumns({
        "recency_days": F.datediff(ref, F.to_date("last_session")),
        "frequency": F.col("total_purchases"),
        "monetary": F.col("customer_lifetime_value"),
    })


def rfm_quantiles(rfm: DataFrame, *, exact: bool = False,
                  rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """One row, one array of quintile cut points per RFM dimension."""
    return quantiles(rfm, RFM_DIMENSIONS, RFM_QUINTILES, exact=exact, rel_error=rel_error)


def rfm_quantiles_long(rfm: DataFrame, *, exact: bool = False,
                       rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """Cut points as rows: (dimension, quantile, cut_point)."""
    q = rfm_quantiles(rfm, exact=exact, rel_error=rel_error)
    rows = [F.struct(F.lit(d).alias("dimension"), F.lit(p).alias("quantile"),
                     F.element_at(d, i + 1).alias("cut_point"))
            for d in RFM_DIMENSIONS for i, p in enumerate(RFM_QUINTILES)]
    return q.select(F.inline(F.array(*rows)))


def _ladder(value: Column, cuts: Column, low_is_best: bool) -> Column:
    """Score 1..5 from four ascending cut points."""
    at = [F.element_at(cuts, i) for i in (1, 2, 3, 4)]
    if low_is_best:
        return (F.when(value <= at[0], 5).when(value <= at[1], 4)
                .when(value <= at[2], 3).when(value <= at[3], 2).otherwise(1))
    return (F.when(value >= at[3], 5).when(value >= at[2], 4)
            .when(value >= at[1], 3).when(value >= at[0], 2).otherwise(1))


def rfm_scores(rfm: DataFrame, cuts: DataFrame | None = None, *, exact: bool = False,
               rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """r/f/m scores (recency inverted: recent = 5) and their sum."""
    if cuts is None:
        cuts = rfm_quantiles(rfm, exact=exact, rel_error=rel_error)
    q = cuts.select(*[F.col(d).alias(f"_q_{d}") for d in RFM_DIMENSIONS])
    return (rfm.crossJoin(F.broadcast(q))
            .withColumns({
                "r_score": _ladder(F.col("recency_days"), F.col("_q_recency_days"), True),
                "f_score": _ladder(F.col("frequency"), F.col("_q_frequency"), False),
                "m_score": _ladder(F.col("monetary"), F.col("_q_monetary"), False),
            })
            .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .drop(*[f"_q_{d}" for d in RFM_DIMENSIONS]))


def rfm_segment_label(r: Column, f: Column, m: Column, total: Column) -> Column:
    """First matching rung wins; the gaps (9 with all scores 3, 5 with r >= 2)
    fall through to Lost, as in the reference."""
    return (F.when(total >= 13, RFM_CHAMPIONS)
            .when(total >= 10, RFM_LOYAL)
            .when((total >= 9) & (r >= 4), RFM_RECENT)
            .when((total >= 9) & (f >= 4), RFM_FREQUENT)
            .when((total >= 9) & (m >= 4), RFM_BIG_SPENDERS)
            .when((total >= 6) & (total < 9), RFM_POTENTIAL)
            .when((total >= 5) & (total < 6) & (r < 2), RFM_AT_RISK)
            .when((total >= 4) & (total < 5), RFM_ABOUT_TO_SLEEP)
            .when((total >= 3) & (total < 4), RFM_NEED_ATTENTION)
            .otherwise(RFM_LOST))


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("rfm_segment", rfm_segment_label(
        F.col("r_score"), F.col("f_score"), F.col("m_score"), F.col("rfm_score")))


def rfm_distribution(segmented: DataFrame) -> DataFrame:
    return (segmented.groupBy("rfm_segment")
            .agg(F.count(F.lit(1)).alias("count"),
                 money_avg("customer_lifetime_value").alias("avg_clv"))
            .orderBy(F.desc("avg_clv"), "rfm_segment"))
