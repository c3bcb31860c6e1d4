"""Distributed quantiles and skew-safe numbering against brute force."""

import math
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlens.functions.quantiles import quantiles
from sessionlens.operators import features

PROBS = [0.2, 0.25, 0.4, 0.6, 0.75, 0.8]


def _one_window(df, *order):
    return df.withColumn("session_number", F.row_number().over(
        Window.partitionBy("user_id").orderBy("timestamp", *(order or ["session_id"]))))


def _disc(values, p):
    s = sorted(v for v in values if v is not None)
    return float(s[math.ceil(p * len(s)) - 1]) if s else None


def test_exact_quantiles_match_brute_force(spark):
    rnd = random.Random(7)
    # one hot value holds a third of the rows, plus nulls and a long tail
    a = [5.0] * 400 + [rnd.uniform(-50, 500) for _ in range(800)] + [None] * 30
    b = [float(rnd.randint(0, 9)) for _ in range(len(a))]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = quantiles(df, ["a", "b"], PROBS, exact=True, accuracy=20).first()
    for col, vals in (("a", a), ("b", b)):
        assert got[col] == [_disc(vals, p) for p in PROBS]


def test_exact_quantiles_single_and_empty(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    assert quantiles(one, ["x"], [0.2, 0.8], exact=True).first()["x"] == [3.0, 3.0]
    empty = spark.createDataFrame([], "x double")
    assert quantiles(empty, ["x"], [0.5], exact=True).first()["x"] is None


def test_approx_quantiles_within_rank_bound(spark):
    rnd = random.Random(3)
    vals = [rnd.gauss(0, 1) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quantiles(df, ["x"], [0.25, 0.75], rel_error=0.05).first()["x"]
    s = np.sort(vals)
    for p, q in zip([0.25, 0.75], got):
        rank = np.searchsorted(s, q, side="right")
        assert abs(rank - p * len(s)) <= 0.05 * len(s) + 1


def test_session_number_hot_user_matches_single_window(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 200)}"
        day = rnd.randint(1, 28)
        rows.append((i, user if i % 97 else None, f"2024-02-{day:02d} {rnd.randint(0, 23):02d}:00:00"))
    df = (spark.createDataFrame(rows, "session_id long, user_id string, t string")
          .withColumn("timestamp", F.to_timestamp("t")).drop("t"))
    skew_safe = {r.session_id: r.session_number for r in features.session_number(df).collect()}
    simple = {r.session_id: r.session_number for r in _one_window(df).collect()}
    assert skew_safe == simple
    assert max(skew_safe.values()) == sum(1 for r in rows if r[1] == "hot")


def test_exact_quantiles_without_exchange_reuse(spark):
    """Every branch re-evaluates its inputs when exchanges are not shared;
    the bucket bounds must still agree, so the result stays exact."""
    rnd = random.Random(5)
    vals = [rnd.choice([1.0, 2.0, 2.0, 3.5]) * rnd.randint(1, 400) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = quantiles(df, ["x"], PROBS, exact=True, accuracy=30).first()["x"]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert got == [_disc(vals, p) for p in PROBS]


def _hot_user_sessions(spark, n=3000):
    rnd = random.Random(21)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 150)}"
        month = rnd.randint(1, 12)
        year = rnd.choice([2023, 2024])
        amount = rnd.choice([0.0, 0.0, round(rnd.uniform(1, 500), 2)])
        rows.append((i, user, rnd.randint(0, 40), rnd.randint(0, 20), amount, float(rnd.randint(1, 5)),
                     f"{year}-{month:02d}-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00"))
    df = spark.createDataFrame(rows, "session_id long, user_id string, session_duration int, "
                               "pages_viewed int, purchase_amount double, review_score double, t string")
    return df.withColumn("timestamp", F.to_timestamp("t")).drop("t").withColumns({
        "product_category": F.lit("Livres"), "device_type": F.lit("Mobile"),
        "country": F.lit("France"), "city": F.lit("Paris"), "review_text": F.lit(None).cast("string")})


def test_hot_user_cohorts_and_history_match_brute_force(spark):
    from sessionlens.operators import clean, cohorts, features, segmentation
    e = features.transform(clean.clean_sessions(_hot_user_sessions(spark)))
    # cohorts: the reference's join formulation, written directly
    first = e.groupBy("user_id").agg(F.min("timestamp").alias("fs"))
    joined = (e.join(first, "user_id")
              .withColumn("cohort", F.concat(F.year("fs").cast("string"), F.lit("-"), F.month("fs").cast("string")))
              .withColumn("msf", (F.year("timestamp") - F.year("fs")) * 12 + F.month("timestamp") - F.month("fs")))
    brute = {(r.cohort, r.msf): (r.a, r.p) for r in joined.groupBy("cohort", "msf").agg(
        F.count_distinct("user_id").alias("a"), F.sum("has_purchased").alias("p")).collect()}
    got = {(r.cohort, r.months_since_first): (r.active_users, r.purchases)
           for r in cohorts.cohort_activity(e).collect()}
    assert got == brute
    hot = [r for r in segmentation.user_metrics(e).collect() if r.user_id == "hot"][0]
    assert hot.total_sessions == 1000
    feats = features.session_features(e).filter(F.col("user_id") == "hot")
    assert feats.count() == 1000 and feats.select("total_sessions").distinct().first()[0] == 1000


def test_session_number_hot_instants_null_times_and_clock_change(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(4000):
        user = "hot" if i % 3 else (f"u{rnd.randint(0, 50)}" if i % 7 else None)
        t = f"2024-10-27 {i % 2:02d}:{15 if i % 3 else 30}:{rnd.randint(0, 59):02d}"  # 02:00 comes twice in Paris
        rows.append((rnd.randint(-10 ** 12, 10 ** 12), user,
                     None if i % 5 == 0 else "2024-10-27 00:30:05" if i % 11 == 0 else t, i))
    df = (spark.createDataFrame(rows, "session_id long, user_id string, t string, x int")
          .withColumn("timestamp", F.to_timestamp(F.concat("t", F.lit("Z")))).drop("t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Paris"):
            spark.conf.set("spark.sql.session.timeZone", name)
            want = {r.x: r.session_number for r in _one_window(df).collect()}
            for hot in (100_000, 50, 5):
                got = {r.x: r.session_number for r in features.session_number(df, hot_rows=hot).collect()}
                assert got == want, (name, hot)
            bare = df.drop("session_id")
            digest = F.xxhash64(*[F.col(c) for c in bare.columns])
            assert ({r.x: r.session_number for r in features.session_number(bare, hot_rows=20).collect()}
                    == {r.x: r.session_number for r in _one_window(bare, digest).collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hot_keys_counted_on_another_table_give_the_same_numbers(spark):
    """The raw table has more rows than the one that is numbered, or other ones
    altogether: the parts differ, the numbers don't."""
    df = _hot_user_sessions(spark).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    df = df.withColumn("timestamp", F.when(F.col("session_id") % 4 > 0, F.lit("2024-01-01 10:00:00").cast("timestamp")).otherwise(F.col("timestamp")))
    want = {r.session_id: r.session_number for r in _one_window(df).collect()}
    more = df.unionByName(df.withColumn("session_id", F.col("session_id") + 50_000))
    for other in (more, more.where("session_id % 5 = 0"), more.limit(0), df.drop("session_id")):
        got = {r.session_id: r.session_number for r in features.session_number(df, hot_rows=20, hot_from=other).collect()}
        assert got == want
    plan = features.session_number(df, hot_from=more.select("session_id", "user_id", "timestamp"))
    assert plan.count() == df.count()
