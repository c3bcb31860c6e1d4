"""Money without loss, the CSV entry path without ids, and hot join keys."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from sessionlens.functions.joins import split_join
from sessionlens.functions.money import money_avg, money_avg_raw, money_sum
from sessionlens.operators import cohorts, features, prediction, temporal
from sessionlens.plans import pipeline
from sessionlens.schema import SESSION_COLUMNS
from sessionlens.sources import (escape_breaks, read_sessions_csv, unescape_breaks, write_csv)
from sessionlens.sources.tables import read_table

from .conftest import sessions, ts


def _money(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return tuple(df.agg(money_sum("x"), money_avg("x"), money_avg_raw("x")).first())


def test_fractions_of_a_cent_are_not_cut(spark):
    total, mean, raw = _money(spark, [0.004, 0.004])
    assert total == pytest.approx(0.008) and raw == pytest.approx(0.004) and mean == 0.0
    assert _money(spark, [0.004, 1.25, None])[0] == pytest.approx(1.254)


def test_nan_infinity_and_huge_amounts(spark):
    assert all(math.isnan(v) for v in _money(spark, [1.0, float("nan"), 2.0]))
    assert _money(spark, [1.0, float("inf")]) == (math.inf, math.inf, math.inf)
    assert _money(spark, [1e19, 1e19])[0] == 2e19
    assert _money(spark, [None, None]) == (None, None, None)
    assert _money(spark, []) == (None, None, None)


def test_means_are_rounded_once(spark):
    assert _money(spark, [0.01] * 10_000 + [0.0] * 10_001)[1] == 0.0  # 100.00 / 20001
    assert _money(spark, [1.0, 1.01])[1] == 1.01 and _money(spark, [-1.0, -1.01])[1] == -1.01
    assert _money(spark, [0.1, 0.2, 0.3])[0] == 0.6


def test_money_in_queries(spark):
    rows = [dict(user_id="a", purchase_amount=0.004, timestamp=ts(1)), dict(user_id="a", purchase_amount=0.004, timestamp=ts(1))]
    e = features.transform(sessions(spark, rows))
    assert temporal.daily_sales(e).first().total_sales == pytest.approx(0.008)
    assert temporal.sales_trend(e).first().total_sales == pytest.approx(0.008)
    assert features.user_history(e).first().avg_purchase_amount == pytest.approx(0.004)
    many = spark.range(20_001).select(
        F.col("id").alias("session_id"), F.lit("u").alias("user_id"), F.lit(dt.datetime(2024, 1, 5)).alias("timestamp"),
        F.when(F.col("id") < 10_000, 0.01).otherwise(0.0).alias("purchase_amount"), F.lit(1).alias("has_purchased"))
    assert cohorts.cohort_activity(many).first().avg_purchase == 0.0


def test_csv_without_ids_through_the_whole_pipeline(spark, tmp_dir):
    rows = [dict(user_id=f"u{i % 3}", session_duration=i, pages_viewed=i % 7, product_category="Livres",
                 purchase_amount=float(i % 4), review_score=float(i % 5 + 1), review_text=f"  tr\u00e8s bon\n\\n {i} ",
                 timestamp=ts(1 + i % 20, i % 24), device_type="Mobile", country="France", city="Paris") for i in range(60)]
    table = sessions(spark, rows, with_id=False)
    path = os.path.join(tmp_dir, "csv")
    write_csv(escape_breaks(table, "review_text"), path)
    back = unescape_breaks(read_sessions_csv(spark, path), "review_text")
    assert back.columns == SESSION_COLUMNS
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
    written = pipeline.run(back, os.path.join(tmp_dir, "out"), as_of="2024-03-01")
    assert spark.read.parquet(written["enriched"]).count() == 60
    e = features.transform(back)
    numbers = sorted((r.user_id, r.session_number) for r in e.collect())
    assert numbers == [(f"u{u}", n) for u in range(3) for n in range(1, 21)]
    train, test = prediction.train_test_split(prediction.model_input(e))
    assert train.count() + test.count() == 60 and train.count() > 0 < test.count()


def test_split_takes_any_key(spark):
    keys = spark.createDataFrame([(1_830_000_000_000_000_000,), *[(-k,) for k in range(1, 1001)]], "k long")
    n = keys.where(prediction.in_training("k")).count()
    assert 600 < n < 800
    small = spark.range(1000).select((F.col("id") * 7919 % 100 < 70).alias("a"), prediction.in_training("id").alias("b"))
    assert small.where("a <> b").isEmpty()


def test_relations_see_new_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.parquet")
    spark.range(3).write.parquet(path)
    assert read_table(spark, tmp_dir, "t").count() == 3
    spark.range(2).write.mode("append").parquet(path)
    assert read_table(spark, tmp_dir, "t").count() == 5


LOW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
       "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def low_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_user_is_split(spark, low_thresholds):
    rows = spark.range(60_000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("user_id"),
        F.col("id").cast("int").alias("session_duration"), F.lit(1).alias("pages_viewed"), F.lit(1).alias("has_purchased"),
        F.lit(1.5).alias("purchase_amount"), F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("city"))
    df = features.session_features(rows)
    assert "skew=true" in _executed(df)
    assert df.where("user_id = 'hot'").select("total_sessions").distinct().collect()[0][0] == 20_000


def test_a_hot_customer_is_split_and_null_parts_are_spread(spark, low_thresholds):
    orders = spark.range(60_000).repartition(6).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000).alias("o_custkey"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    buyers = spark.range(4000).select(F.col("id").alias("c_custkey")).groupBy("c_custkey").agg(F.max("c_custkey").alias("n"))
    plan = _executed(split_join(orders, buyers, "o_custkey", "c_custkey"))
    assert "skew=true" in plan
    nulls = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")))
    df = split_join(nulls, buyers, "o_custkey", "c_custkey", spread_nulls=["o_orderkey"])
    assert df.count() == 60_000 and df.where("n is null").count() == 30_000
    assert df.where("o_custkey is null").select(F.spark_partition_id()).distinct().count() > 4
