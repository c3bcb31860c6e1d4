"""Temporal aggregates: by hour, weekday, month, weekday x hour, peak hour
per weekday, daily sales and their 7-row moving averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.money import (cents, money_avg, money_avg_raw, money_sum, rest,
                                         total_of)


def _activity_aggs():
    return [F.count(F.lit(1)).alias("sessions"),
            F.sum("has_purchased").alias("purchases"),
            money_avg("purchase_amount").alias("avg_purchase_amount")]


def sessions_by_hour(df: DataFrame) -> DataFrame:
    return df.groupBy("hour").agg(*_activity_aggs()).orderBy("hour")


def sessions_by_weekday(df: DataFrame) -> DataFrame:
    return df.groupBy("day_of_week").agg(*_activity_aggs())


def sessions_by_month(df: DataFrame) -> DataFrame:
    return (df.groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.sum("has_purchased").alias("purchases"),
                 F.round(money_sum("purchase_amount"), 2).alias("total_sales"),
                 money_avg("purchase_amount").alias("avg_purchase_amount"))
            .orderBy("year", "month"))


def weekday_hour_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("day_of_week", "hour").agg(F.count(F.lit(1)).alias("count"))


def peak_hour_by_weekday(df: DataFrame) -> DataFrame:
    """Busiest hour of each weekday; ties go to the earliest hour. The window
    runs on the weekday x hour count table (at most 7 x 24 rows + nulls),
    and Catalyst plans ``row_number() = 1`` as a WindowGroupLimit."""
    w = Window.partitionBy("day_of_week").orderBy(F.desc("count"), F.asc("hour"))
    return (weekday_hour_counts(df)
            .withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") == 1)
            .select("day_of_week", "hour", "count")
            .orderBy("day_of_week"))


def daily_sales(df: DataFrame) -> DataFrame:
    """Buyers only, one row per day: total_sales, order_count, avg_order_value."""
    return (df.filter(F.col("has_purchased") == 1)
            .groupBy("date")
            .agg(money_sum("purchase_amount").alias("total_sales"),
                 F.count(F.lit(1)).alias("order_count"),
                 money_avg_raw("purchase_amount").alias("avg_order_value"))
            .orderBy("date"))


def sales_trend(df: DataFrame, rows: int = 7) -> DataFrame:
    """Daily sales plus moving averages over the last ``rows`` *rows* (days
    without sales are absent, as in the reference). The window has no
    partition key but runs on the daily table — one row per calendar day —
    so its single task is bounded by the calendar, not by the data."""
    w = Window.orderBy("date").rowsBetween(-(rows - 1), 0)
    daily = (df.filter(F.col("has_purchased") == 1)
             .groupBy("date")
             .agg(F.sum(cents("purchase_amount")).alias("_cents"),
                  F.sum(rest("purchase_amount")).alias("_rest"),
                  F.count(F.lit(1)).alias("order_count"),
                  money_avg_raw("purchase_amount").alias("avg_order_value")))
    return (daily
            .withColumn("sales_7day_avg", total_of(F.sum("_cents").over(w), F.sum("_rest").over(w))
                        / F.count(F.lit(1)).over(w))
            .withColumn("orders_7day_avg", F.avg("order_count").over(w))
            .withColumn("total_sales", total_of(F.col("_cents"), F.col("_rest")))
            .select("date", "total_sales", "order_count", "avg_order_value",
                    "sales_7day_avg", "orders_7day_avg")
            .orderBy("date"))
