"""End-to-end run and the streaming ingest against the batch results."""

import os

from pyspark.sql import functions as F

from sessionlens.operators import clean, descriptive, features
from sessionlens.plans.pipeline import run
from sessionlens.schema import SESSION_COLUMNS
from sessionlens.sources import session_view, write_csv
from sessionlens.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_pipeline_writes_every_report(spark, tmp_dir):
    raw = session_view(spark, SF)
    written = run(raw, os.path.join(tmp_dir, "out"), as_of="2002-01-01", exact=True)
    for key in ("audit/clean_audit", "descriptive/conversionByDevice", "temporal/salesTrend",
                "segmentation/rfmDistribution", "segmentation/cohortRetention",
                "reviews/topTerms", "dashboard/series", "quality/profile", "enriched"):
        assert key in written and os.path.isdir(written[key]), key
    conv = spark.read.parquet(written["descriptive/conversionByDevice"])
    expected = descriptive.conversion_by_device(features.transform(clean.clean_sessions(raw)))
    assert sorted(conv.collect()) == sorted(expected.collect())
    assert spark.read.parquet(written["audit/clean_audit"]).first().rows_before == 1500


def test_streaming_ingest_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    raw = session_view(spark, SF).select(*SESSION_COLUMNS)
    write_csv(raw.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")), src)
    q = ingest(spark, src, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"),
               multi_line=True, available_now=True)
    q.awaitTermination(300)
    sink = spark.read.parquet(os.path.join(tmp_dir, "sink"))
    batch = clean.valid_sessions(raw)
    assert sink.count() == batch.count() == 1442
    by_device = {r.device_type: r["count"] for r in sink.groupBy("device_type").count().collect()}
    want = {r.device_type: r["count"] for r in batch.groupBy("device_type").count().collect()}
    assert by_device == want
    assert sink.filter(F.col("has_purchased") == 1).count() == batch.filter(F.col("purchase_amount") > 0).count()


def test_pipeline_with_text_attached_after_cleaning(spark, tmp_dir):
    from sessionlens.sources.tables import attach_text
    narrow = session_view(spark, SF, with_text=False)
    written = run(narrow, os.path.join(tmp_dir, "out2"), as_of="2002-01-01",
                  attach=lambda df: attach_text(spark, SF, df))
    plain = run(session_view(spark, SF), os.path.join(tmp_dir, "out3"), as_of="2002-01-01", stage_how="table")
    for key in ("reviews/commonPositiveTerms", "audit/null_counts", "descriptive/countryDistribution", "enriched"):
        a = spark.read.parquet(written[key]).collect()
        b = spark.read.parquet(plain[key]).collect()
        assert sorted(a, key=str) == sorted(b, key=str), key
