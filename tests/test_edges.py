"""Hand-made edge tables (boundaries, empty input, nulls, ties, ladders)."""

import itertools

from pyspark.sql import functions as F

from sessionlens.operators import (clean, cohorts, descriptive, features, quality, reviews,
                                   segmentation, series, temporal)
from tests.conftest import sessions, ts


def _enrich(spark, rows):
    return features.transform(clean.clean_sessions(sessions(spark, rows)))


def test_bucket_boundaries(spark):
    rows = [dict(user_id="u", session_duration=d, pages_viewed=1, timestamp=ts(1))
            for d in (0, 4, 5, 14, 15)]
    got = {r.session_duration: r.session_category
           for r in features.session_category(sessions(spark, rows)).collect()}
    assert got == {0: "Courte", 4: "Courte", 5: "Moyenne", 14: "Moyenne", 15: "Longue"}
    null = features.session_category(sessions(spark, [dict(session_duration=None)])).first()
    assert null.session_category == "Longue"


def test_rating_and_purchase_buckets(spark):
    ratings = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, None]
    df = features.review_category(sessions(spark, [dict(review_score=r) for r in ratings]))
    got = [r.review_category for r in df.orderBy("session_id").collect()]
    assert got == ["Négatif", "Négatif", "Non évalué", "Neutre", "Non évalué", "Positif",
                   "Positif", "Non évalué"]
    amounts = [-1.0, 0.0, 0.01, None]
    df = features.purchase_flag(sessions(spark, [dict(purchase_amount=a) for a in amounts]))
    assert [r.has_purchased for r in df.orderBy("session_id").collect()] == [0, 0, 1, 0]


def test_imputation_uses_raw_mean_and_is_its_own_class(spark):
    rows = [dict(user_id="a", session_duration=1, pages_viewed=1, review_score=1.0),
            dict(user_id="a", session_duration=1, pages_viewed=1, review_score=None),
            # invalid row: removed by the filter but still counted in the mean
            dict(user_id="a", session_duration=-1, pages_viewed=1, review_score=5.0)]
    out = clean.clean_sessions(sessions(spark, rows)).orderBy("session_id").collect()
    assert len(out) == 2
    assert out[1].review_score == 3.0 and out[1].purchase_amount == 0.0
    audit = clean.clean_audit(sessions(spark, rows)).first()
    assert (audit.rows_before, audit.rows_after) == (3, 2)


def test_empty_table(spark):
    empty = _enrich(spark, [])
    assert empty.count() == 0
    conv = descriptive.conversion_rate(empty).first()
    assert conv.total_sessions == 0 and conv.conversion_rate_percent is None
    assert descriptive.conversion_by_device(empty).count() == 0
    q = quality.data_quality(sessions(spark, []), exact=True).collect()
    assert len(q) == 12 and all(r.null_percent is None for r in q)
    assert segmentation.rfm_scores(segmentation.rfm_base(
        segmentation.user_metrics(empty), "2024-06-01"), exact=True).count() == 0
    assert cohorts.cohort_retention(empty).count() == 0
    assert clean.cap_outliers(sessions(spark, []), "session_duration").count() == 0


def test_all_null_table(spark):
    raw = sessions(spark, [{} for _ in range(3)])
    nulls = {r.column_name: r.null_count for r in clean.null_counts(raw).collect()}
    assert nulls["user_id"] == 3 and nulls["review_score"] == 3
    q = {r.column_name: r for r in quality.data_quality(raw, exact=True).collect()}
    assert q["session_duration"].mean == "N/A" and q["session_duration"].distinct_count == 1
    assert q["session_duration"].outlier_count == 0
    assert clean.clean_sessions(raw).count() == 0
    capped = clean.cap_outliers(raw, "session_duration", exact=True).collect()
    assert len(capped) == 3 and all(r.session_duration is None for r in capped)


def test_null_keys_group_but_do_not_join(spark):
    rows = [dict(user_id=None, session_duration=1, pages_viewed=1, timestamp=ts(1)),
            dict(user_id=None, session_duration=1, pages_viewed=1, timestamp=ts(2)),
            dict(user_id="", session_duration=1, pages_viewed=1, timestamp=ts(3)),
            dict(user_id="b", session_duration=1, pages_viewed=1, timestamp=None)]
    e = _enrich(spark, rows)
    metrics = {r.user_id: r.total_sessions for r in segmentation.user_metrics(e).collect()}
    assert metrics == {None: 2, "": 1, "b": 1}
    numbers = {r.session_id: r.session_number for r in e.collect()}
    assert sorted([numbers[0], numbers[1]]) == [1, 2] and numbers[2] == 1 and numbers[3] == 1
    feats = {r.session_id: r.total_sessions for r in features.session_features(e).collect()}
    assert feats[0] is None and feats[2] == 1
    act = cohorts.cohort_activity(e).collect()
    assert sum(r.active_users for r in act) == 2  # '' and b; null user dropped
    assert any(r.cohort is None for r in act)      # b has no timestamp -> no cohort


def test_ties_are_broken(spark):
    rows = [dict(user_id="u", session_duration=1, pages_viewed=1, timestamp=ts(1, 10)),
            dict(user_id="u", session_duration=1, pages_viewed=1, timestamp=ts(1, 10)),
            dict(user_id="v", session_duration=1, pages_viewed=1, timestamp=ts(1, 11))]
    e = _enrich(spark, rows)
    assert [r.session_number for r in e.orderBy("session_id").collect()] == [1, 2, 1]
    peak = temporal.peak_hour_by_weekday(e).collect()
    assert [(r.day_of_week, r.hour, r["count"]) for r in peak] == [("Monday", 10, 2)]
    rows2 = [dict(user_id="u", session_duration=1, pages_viewed=1, timestamp=ts(1, h)) for h in (9, 8)]
    assert temporal.peak_hour_by_weekday(_enrich(spark, rows2)).first().hour == 8


def test_rfm_ladder_all_triples(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r_score int, f_score int, m_score int").withColumn(
        "rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    got = {(r.r_score, r.f_score, r.m_score): r.rfm_segment
           for r in segmentation.rfm_segments(df).collect()}
    assert got[(3, 3, 3)] == "Lost"
    assert got[(2, 1, 2)] == "Lost"
    assert got[(1, 1, 3)] == "At Risk"
    assert got[(1, 1, 2)] == "About to Sleep"
    assert got[(1, 1, 1)] == "Need Attention"
    assert got[(5, 5, 3)] == "Champions" and got[(4, 3, 3)] == "Loyal Customers"
    assert got[(4, 3, 2)] == "Recent Customers" and got[(2, 4, 3)] == "Frequent Customers"
    assert got[(3, 2, 4)] == "Big Spenders" and got[(2, 2, 2)] == "Potential Loyalists"
    assert len(got) == 125


def test_behaviour_segments(spark):
    df = spark.createDataFrame([(p,) for p in (0, 1, 2, 4, 5, None)], "total_purchases long")
    got = [r.user_segment for r in segmentation.behavior_segments(df).collect()]
    assert got == ["Non-acheteur", "One-time buyer", "Repeat customer", "Repeat customer",
                   "Loyal customer", "Unknown"]


def test_moving_average_counts_rows_not_days(spark):
    rows = [dict(user_id="u", session_duration=1, pages_viewed=1, purchase_amount=10.0 * d,
                 timestamp=ts(d)) for d in (1, 2, 5, 20)]
    trend = temporal.sales_trend(_enrich(spark, rows), rows=2).collect()
    assert [r.total_sales for r in trend] == [10.0, 20.0, 50.0, 200.0]
    assert [r.sales_7day_avg for r in trend] == [10.0, 15.0, 35.0, 125.0]


def test_cohort_labels_and_month_distance(spark):
    rows = [dict(user_id="a", session_duration=1, pages_viewed=1, timestamp=ts(5, month=1)),
            dict(user_id="a", session_duration=1, pages_viewed=1, timestamp=ts(5, month=2)),
            dict(user_id="b", session_duration=1, pages_viewed=1, timestamp=ts(5, month=2)),
            dict(user_id="c", session_duration=1, pages_viewed=1, timestamp=ts(5, month=10)),
            dict(user_id="c", session_duration=1, pages_viewed=1, timestamp=ts(5, month=1, year=2025))]
    ret = cohorts.cohort_retention(_enrich(spark, rows)).collect()
    assert [r.cohort for r in ret] == ["2024-1", "2024-1", "2024-10", "2024-10", "2024-2"]
    assert [(r.months_since_first, r.retention_rate) for r in ret if r.cohort == "2024-10"] == \
        [(0, 100.0), (3, 100.0)]
    assert all(r.retention_rate == 100.0 for r in ret if r.months_since_first == 0)


def test_tokenizer(spark):
    df = spark.createDataFrame([("L'Été, très BON produit à prix naïf!",), ("",), (None,), ("12345 678",)],
                               "review_text string").withColumn("session_id", F.monotonically_increasing_id())
    toks = reviews.review_tokens(df).orderBy("session_id", "pos").collect()
    assert [t.term for t in toks] == ["lété", "très", "bon", "produit", "prix", "naf"]


def test_outlier_capping_and_removal(spark):
    values = [float(v) for v in range(1, 21)] + [1000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    capped = clean.cap_outliers(df, "x", exact=True).collect()
    assert len(capped) == 22 and sum(r.x is None for r in capped) == 1
    assert max(r.x for r in capped if r.x is not None) < 1000.0
    kept = clean.remove_outliers(df, "x", exact=True).collect()
    assert len(kept) == 20 and all(r.x is not None and r.x <= 20 for r in kept)
    ints = spark.createDataFrame([(v,) for v in range(1, 21)] + [(1000,)], "x int")
    assert dict(clean.cap_outliers(ints, "x").dtypes)["x"] == "double"


def test_correlation_edge_columns(spark):
    rows = [(float(x), 2.0 * x, -1.0 * x, 7.0, x % 2) for x in range(10)]
    df = spark.createDataFrame(rows, "x double, y double, z double, c double, h int")
    got = {(r.feature1, r.feature2): r.correlation
           for r in descriptive.correlation_matrix(df, ["x", "y", "z", "c"]).collect()}
    assert abs(got[("x", "y")] - 1.0) < 1e-12 and abs(got[("x", "z")] + 1.0) < 1e-12
    assert got[("x", "c")] is None and got[("c", "c")] is None and got[("x", "x")] == 1.0
    assert got[("y", "x")] == got[("x", "y")]


def test_dashboard_series_equal_single_charts(spark):
    from sessionlens.sources import session_view
    e = features.transform(clean.clean_sessions(session_view(spark, "/root/testdata/sf0.001", False)))
    dash = series.dashboard_series(e).collect()
    by = {}
    for r in dash:
        by.setdefault(r.series, {})[r.key] = (r.sessions, r.purchases)
    hours = {str(r.hour): (r.sessions, r.purchases) for r in series.chart_sessions_by_hour(e).collect()}
    assert by["hour"] == hours
    total = e.count()
    for name in ("category", "hour", "device", "weekday"):
        assert sum(v[0] for v in by[name].values()) == total
    assert all(v[0] > 50 for v in by["pages"].values())
    days = [r.day_of_week for r in series.chart_sessions_by_day(e).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_describe_text_matches_typed(spark):
    from sessionlens.sources import session_view
    e = features.transform(clean.clean_sessions(session_view(spark, "/root/testdata/sf0.001", False)))
    text = {r.summary: r for r in descriptive.describe_text(e).collect()}
    typed = {r.column_name: r for r in descriptive.describe_sessions(e).collect()}
    assert int(text["count"].session_duration) == typed["session_duration"]["count"]
    assert abs(float(text["mean"].purchase_amount) - typed["purchase_amount"].mean) < 1e-6
    assert float(text["max"].review_score) == typed["review_score"]["max"]
