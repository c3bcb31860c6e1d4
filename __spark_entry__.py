"""

Every query reads the driver's tables under ``sf_dir`` and derives the
session table from them (``sessionlens.sources.session_view``), so its work
grows with the data. Quantile-based queries run in exact mode (distributed
exact quantiles) so they are comparable with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.sql import AS_OF
from oracle.sql import oracle_sql as _oracle_sql
from sessionlens.operators import (clean, cohorts, descriptive, features, prediction,
                                   quality, reviews, segmentation, series, temporal)
from sessionlens.config import scratch_folder
from sessionlens.functions import sketches
from sessionlens.plans import reports, stage
from sessionlens.schema import QUANTILE_REL_ERROR, RFM_QUINTILES, SESSION_COLUMNS
from sessionlens.sources import (escape_breaks, quarantine, read_sessions_checked, read_sessions_csv,
                                 session_view, unescape_breaks, write_csv, write_parquet)
from sessionlens.sources.tables import SESSION_TABLES, attach_text, file_state

SMOKE_DIR = "/root/testdata/sf0.001"


def _prepare(spark: SparkSession) -> None:
    # Results must not depend on the machine's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_PLANS: dict[tuple, DataFrame] = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, text: bool, build) -> DataFrame:
    """Lazy, already-analysed plans are reused across queries of one session
    while the tables' files stay as they are: only plan construction is shared,
    every query still reads its tables."""
    key = (kind, spark.sparkContext.applicationId, sf_dir, text,
           tuple(file_state(spark, sf_dir, t) for t in SESSION_TABLES))
    df = _PLANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _PLANS[key] = build()
    # a new Dataset each call: a fresh physical plan, so nothing from an
    # earlier execution (e.g. finished shuffle stages) is ever reused
    return df.select("*")


def raw(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    _prepare(spark)
    return _memo("raw", spark, sf_dir, text, lambda: session_view(spark, sf_dir, with_text=text))


def cleaned(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    # Cleaning never reads the review text, so the text is attached after it
    # (same rows and values as cleaning the view with text).
    def build():
        out = clean.clean_sessions(raw(spark, sf_dir))
        return attach_text(spark, sf_dir, out) if text else out
    return _memo("cleaned", spark, sf_dir, text, build)


def enriched(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    # The text is joined after the enrichment too, so the session-numbering
    # shuffle moves narrow rows and the text crosses the network once.
    def build():
        out = features.transform(cleaned(spark, sf_dir), hot_from=raw(spark, sf_dir))
        return attach_text(spark, sf_dir, out) if text else out
    return _memo("enriched", spark, sf_dir, text, build)


def numbered(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    """The enriched table for results that read the session number: its keys are counted
    twice before the rows are numbered, so the cleaned table is derived and written
    once, and those counts read its order columns only."""
    out = features.transform(stage(cleaned(spark, sf_dir), how="table"))
    return attach_text(spark, sf_dir, out) if text else out


def _on_enriched(op: Callable[[DataFrame], DataFrame], text: bool = False):
    return lambda spark, sf_dir: op(enriched(spark, sf_dir, text))


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once, for results that read it several times."""
    path = scratch_folder(spark, name)
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.user_metrics(enriched(spark, sf_dir))


def _rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.rfm_base(_metrics(spark, sf_dir), AS_OF)


def _rfm_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read by both cut-point passes and the scoring
    return segmentation.rfm_base(_written(spark, _metrics(spark, sf_dir), "user-metrics"), AS_OF)


def _rfm_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.rfm_scores(_rfm_staged(spark, sf_dir), exact=True)


def _split(spark: SparkSession, sf_dir: str, data: DataFrame | None = None):
    """Training and test rows of the narrow model table, written once: indexing,
    fitting and scoring all read it."""
    data = prediction.model_input(enriched(spark, sf_dir)) if data is None else data
    return prediction.train_test_split(_written(spark, data, "model-input"))


def _signal(sessions: DataFrame) -> DataFrame:
    """The model table with a label that two features and some noise decide."""
    told = F.col("session_duration") + F.when(F.col("device_type") == "Desktop", 6).otherwise(0)
    noise = F.pmod(F.col("session_id") * 31, F.lit(17))
    return prediction.model_input(sessions.withColumn("has_purchased", (told + noise >= 22).cast("int")))


def _lr_model(spark: SparkSession, sf_dir: str, signal: bool = False):
    train, test = _split(spark, sf_dir, _signal(enriched(spark, sf_dir)) if signal else None)
    return prediction.fit_logistic(train), train, test


def _lr_auc(signal: bool):
    def run(spark, sf_dir):
        model, _, test = _lr_model(spark, sf_dir, signal)
        return prediction.evaluation_table(model, test, "logistic_regression")
    return run


def _lr_coefficients(signal: bool):
    def run(spark, sf_dir):
        model, train, _ = _lr_model(spark, sf_dir, signal)
        return prediction.coefficients(model, train).withColumn(
            "coefficient", F.round("coefficient", 4) + F.lit(0.0))
    return run


def _tree_leaves(signal: bool):
    """Test rows with the share of label 1 in their leaf of one tree."""
    def run(spark, sf_dir):
        train, test = _split(spark, sf_dir, _signal(enriched(spark, sf_dir)) if signal else None)
        return prediction.leaf_table(prediction.tree(train), test)
    return run


def _purchase_rf(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = prediction.fit(prediction.forest_pipeline(seed=42), train)
    return prediction.evaluation_table(model, test, "random_forest")


def _keeper(spark):
    """Writes a part of the grid search, so a lost executor fits no forest again."""
    base = scratch_folder(spark, "grid")

    def keep(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")
    return keep


def _purchase_cv(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = prediction.cross_validate(train, folds=3, parallelism=4, keep=_keeper(spark))  # 18 combinations
    return prediction.evaluation_table(model, test, "random_forest_cv")


def _purchase_cv_metrics(spark, sf_dir):
    """The area under the ROC curve of all 18 combinations on each of the 3 folds."""
    train, _ = _split(spark, sf_dir)
    candidates = prediction.grid(**prediction.GRID)
    counts = prediction.out_of_fold_counts(train, candidates, folds=3, parallelism=4, keep=_keeper(spark))
    return prediction.fold_metrics(counts, candidates)


def _feature_vectors(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = prediction.fit(Pipeline(stages=prediction.feature_stages()), train)
    return prediction.feature_vectors(model, test).select(
        "session_id", F.array_join(F.transform("features", lambda x: x.cast("string")), ",").alias("features"))


def _purchase_learnable_auc(spark, sf_dir):
    """The same model on a label that two of the features decide."""
    sessions, duration = enriched(spark, sf_dir), F.col("session_duration")
    least = F.when(F.col("device_type") == "Desktop", 8).otherwise(14)
    data = prediction.model_input(sessions.withColumn("has_purchased", (duration >= least).cast("int")))
    train, test = _split(spark, sf_dir, data)
    model = prediction.fit(prediction.logistic_pipeline(max_iter=50, reg=0.0, elastic_net=0.0), train)
    return prediction.evaluation_table(model, test, "logistic_regression").select(
        "model", "test_rows", (F.col("auc") > 0.9).alias("auc_above_0_9"))


def _purchase_scores(spark, sf_dir):
    model, _, test = _lr_model(spark, sf_dir)
    return _scored(prediction.score(model, test, ordered=False))


def _saved_model(signal: bool):
    """The model is saved, loaded again and scores the test rows."""
    def run(spark, sf_dir):
        model, _, test = _lr_model(spark, sf_dir, signal)
        path = scratch_folder(spark, "model")
        prediction.save(model, path)
        return _scored(prediction.score(prediction.load(path), test, ordered=False))
    return run


def _scored(scored):
    return scored.select("session_id", "label", "prediction", "purchase_probability",
                         "predicted_purchase")


def _scan_csv(spark, sf_dir):
    """CSV sink then CSV scan with the fixed schema: the session table is
    exported by Spark into the shared checkpoint folder and read back."""
    path = scratch_folder(spark, "sessions-csv")
    write_csv(escape_breaks(raw(spark, sf_dir, text=True).select(*SESSION_COLUMNS), "review_text"), path)
    return unescape_breaks(read_sessions_csv(spark, path), "review_text")


BAD_CELLS = {1: ("session_duration", "soon"), 2: ("purchase_amount", "12,5"), 3: ("timestamp", "yesterday")}


def _faulty_csv(spark, sf_dir):
    """The session table as CSV lines, where the last digits of the id plant bad
    cells (one, or two at once), lines that break off and lines with a field too many."""
    sessions = escape_breaks(raw(spark, sf_dir, text=True), "review_text")
    case = F.pmod("session_id", F.lit(50))
    cell = lambda n: F.col(n).cast("string")
    for value, (name, bad) in BAD_CELLS.items():
        here = F.lit(value) if name != "timestamp" else F.lit(3)
        sessions = sessions.withColumn(name, F.when((case == here) | ((case == 6) & F.lit(value < 3)), F.lit(bad)).otherwise(cell(name)))
    line = F.to_csv(F.struct(*SESSION_COLUMNS), {"escape": '"', "ignoreLeadingWhiteSpace": "false",
                                                 "ignoreTrailingWhiteSpace": "false"})
    line = F.when(case == 4, F.concat(line, F.lit(",more"))).when(case == 5, F.concat("user_id", F.lit(",7,"))).otherwise(line)
    path = scratch_folder(spark, "faulty-csv")
    sessions.select(line.alias("value")).write.text(path)
    return read_sessions_checked(spark, path, header=False)


def _csv_good(spark, sf_dir):
    """Sessions of a faulty CSV that are sound, typed."""
    return unescape_breaks(quarantine(_faulty_csv(spark, sf_dir))[0], "review_text")


def _csv_quarantine(spark, sf_dir):
    """Lines per reason, the good ones as ``good``."""
    checked = _faulty_csv(spark, sf_dir)
    return checked.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("line").alias("kept_lines"))


SKETCHED = ["session_duration", "pages_viewed", "purchase_amount", "review_score"]
COUNTED = ["session_id", "user_id", "product_category", "purchase_amount", "timestamp", "city"]


def _monthly(spark, sf_dir, build, cols):
    """Sketches per month, written as a store of them would be."""
    return _written(spark, build(enriched(spark, sf_dir), cols, ["year", "month"]), "sketches")


def _approximate_cut_ranks(spark, sf_dir):
    """Rank errors of approximate cut points: merged monthly sketches of the
    sessions, and the quantile mode of the RFM scores. ``within``: 0.05 of the rows."""
    sessions = enriched(spark, sf_dir)
    cuts = sketches.merged_quantiles(_monthly(spark, sf_dir, sketches.quantile_sketches, SKETCHED), SKETCHED, [0.25, 0.5, 0.75])
    rfm = _rfm_staged(spark, sf_dir)
    parts = [("sessions", sketches.rank_errors(sessions, cuts, SKETCHED, [0.25, 0.5, 0.75])),
             ("rfm", sketches.rank_errors(rfm, segmentation.rfm_quantiles(rfm, exact=False),
                                          segmentation.RFM_DIMENSIONS, RFM_QUINTILES))]
    rows = [df.select(F.lit(of).alias("of"), "column_name", "quantile", "rows",
                      (F.col("rank_error") <= QUANTILE_REL_ERROR).alias("within")) for of, df in parts]
    return rows[0].unionByName(rows[1])


def _approximate_distinct(spark, sf_dir):
    """Exact distinct counts, and whether the merged monthly sketches are within 5 %."""
    merged = sketches.merged_distinct(_monthly(spark, sf_dir, sketches.distinct_sketches, COUNTED), COUNTED)
    counts = quality.distinct_counts(enriched(spark, sf_dir).select(*COUNTED))
    exact = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_dist{i}").alias("distinct_count"))
                                             for i, c in enumerate(COUNTED)])))
    near = F.abs(F.col("estimate") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return exact.join(merged, "column_name").select("column_name", "distinct_count", near.alias("within"))


def _csv_enriched(spark, sf_dir):
    """The whole way from an 11-column CSV (no session id): scan, clean, enrich."""
    return features.transform(stage(clean.clean_sessions(_scan_csv(spark, sf_dir)), how="table"))


def _report(build):
    """All rows of a report's results, each with its result's name; the columns
    that a result does not have are null. The text of ``stats`` is read as numbers."""
    def run(spark, sf_dir):
        out = None
        for name, df in build(enriched(spark, sf_dir, text=True)).items():
            if name == "stats":
                df = df.select("summary", *(F.col(c).cast("double").alias(c) for c in df.columns if c != "summary"))
            part = df.select(F.lit(name).alias("result"), "*")
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out
    return run


def _parquet_sink(spark, sf_dir):
    """Parquet sink partitioned by year/month, read back from the shared
    checkpoint folder (partition columns come back as a trailing pair)."""
    path = scratch_folder(spark, "enriched-parquet")
    write_parquet(numbered(spark, sf_dir).drop("review_text"), path, partition_by=["year", "month"])
    return spark.read.parquet(path)


def _time_features(spark, sf_dir):
    return features.time_features(cleaned(spark, sf_dir)).select(
        "session_id", "date", "hour", "day_of_week", "month", "year")


def _session_features(spark, sf_dir):
    return features.session_features(numbered(spark, sf_dir)).drop("review_text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and cleaning
    "scan_sessions": lambda s, d: raw(s, d, text=True),
    "scan_csv": _scan_csv,
    "csv_enriched": _csv_enriched,
    "csv_good": _csv_good,
    "csv_quarantine": _csv_quarantine,
    "parquet_sink": _parquet_sink,
    "null_counts": lambda s, d: clean.null_counts(raw(s, d, text=True)),
    "clean_audit": lambda s, d: clean.clean_audit(raw(s, d)),
    "clean_sessions": lambda s, d: cleaned(s, d, text=True),
    # features
    "time_features": _time_features,
    "session_category": lambda s, d: features.session_category(cleaned(s, d)).select(
        "session_id", "session_duration", "session_category"),
    "purchase_flag": lambda s, d: features.purchase_flag(cleaned(s, d)).select(
        "session_id", "purchase_amount", "has_purchased"),
    "review_category": lambda s, d: features.review_category(cleaned(s, d)).select(
        "session_id", "review_score", "review_category"),
    "session_number": lambda s, d: numbered(s, d).select("session_id", "user_id", "timestamp", "session_number"),
    "enriched_sessions": lambda s, d: numbered(s, d, text=True),
    # cleaned sessions staged in the shared folder, then enriched
    "staged_sessions": lambda s, d: attach_text(s, d, features.transform(stage(cleaned(s, d), how="checkpoint"))),
    "pages_per_minute": lambda s, d: features.pages_per_minute(enriched(s, d)).select(
        "session_id", "pages_per_minute"),
    "user_history": _on_enriched(features.user_history),
    "session_features": _session_features,
    # descriptive
    "describe_sessions": _on_enriched(descriptive.describe_sessions),
    "category_distribution": _on_enriched(descriptive.category_distribution),
    "country_distribution": _on_enriched(descriptive.country_distribution),
    "conversion_rate": _on_enriched(descriptive.conversion_rate),
    "conversion_by_device": _on_enriched(descriptive.conversion_by_device),
    "conversion_by_session_category": _on_enriched(descriptive.conversion_by_session_category),
    "correlation_matrix": _on_enriched(descriptive.correlation_matrix),
    # temporal
    "sessions_by_hour": _on_enriched(temporal.sessions_by_hour),
    "sessions_by_weekday": _on_enriched(temporal.sessions_by_weekday),
    "sessions_by_month": _on_enriched(temporal.sessions_by_month),
    "weekday_hour_counts": _on_enriched(temporal.weekday_hour_counts),
    "peak_hour_by_weekday": _on_enriched(temporal.peak_hour_by_weekday),
    "daily_sales": _on_enriched(temporal.daily_sales),
    "sales_trend": _on_enriched(temporal.sales_trend),
    # customer segmentation
    "user_metrics": _on_enriched(segmentation.user_metrics),
    "behavior_segments": _on_enriched(lambda e: segmentation.behavior_segments(segmentation.user_metrics(e))),
    "segment_distribution": _on_enriched(lambda e: segmentation.segment_distribution(
        segmentation.behavior_segments(segmentation.user_metrics(e)))),
    "rfm_base": _rfm,
    "rfm_quantiles": lambda s, d: segmentation.rfm_quantiles_long(_rfm_staged(s, d), exact=True),
    "rfm_scores": _rfm_scored,
    "rfm_segments": lambda s, d: segmentation.rfm_segments(_rfm_scored(s, d)),
    "rfm_distribution": lambda s, d: segmentation.rfm_distribution(
        segmentation.rfm_segments(_rfm_scored(s, d))),
    # the reference's own approximate cut points (sketch, rel. error 0.05):
    # not comparable value-by-value with an exact oracle -> rows-only check
    "rfm_scores_approx": lambda s, d: segmentation.rfm_scores(_rfm_staged(s, d), exact=False),
    # what they and the merged monthly sketches miss by, exactly
    "approximate_cut_ranks": _approximate_cut_ranks,
    # cohorts
    "user_cohorts": _on_enriched(cohorts.user_cohorts),
    "cohort_activity": _on_enriched(cohorts.cohort_activity),
    "cohort_sizes": _on_enriched(cohorts.cohort_sizes),
    "cohort_retention": _on_enriched(cohorts.cohort_retention),
    # reviews and text
    "review_distribution": _on_enriched(reviews.review_distribution),
    "reviews_by_category": _on_enriched(reviews.reviews_by_category),
    "reviews_by_country": _on_enriched(reviews.reviews_by_country),
    "review_tokens": _on_enriched(reviews.review_tokens, text=True),
    "common_positive_terms": _on_enriched(reviews.positive_terms, text=True),
    "common_negative_terms": _on_enriched(reviews.negative_terms, text=True),
    "top_terms": _on_enriched(reviews.top_terms, text=True),
    "top_terms_sketched": _on_enriched(reviews.top_terms_sketched, text=True),
    "review_impact": _on_enriched(reviews.review_impact),
    # dashboard series
    "chart_category_distribution": _on_enriched(series.chart_category_distribution),
    "chart_conversion_by_category": _on_enriched(series.chart_conversion_by_category),
    "chart_sessions_by_hour": _on_enriched(series.chart_sessions_by_hour),
    "chart_review_distribution": _on_enriched(series.chart_review_distribution),
    "chart_purchase_by_pages": _on_enriched(series.chart_purchase_by_pages),
    "chart_conversion_by_device": _on_enriched(series.chart_conversion_by_device),
    "chart_sessions_by_day": _on_enriched(series.chart_sessions_by_day),
    "dashboard_series": _on_enriched(series.dashboard_series),
    # data quality and utilities
    "data_quality": lambda s, d: quality.data_quality(raw(s, d, text=True), exact=True),
    "data_quality_approx": lambda s, d: quality.data_quality(raw(s, d, text=True), exact=False),
    "approximate_distinct": _approximate_distinct,
    "table_summary": lambda s, d: quality.table_summary(raw(s, d)),
    "cap_outliers": lambda s, d: clean.cap_outliers(cleaned(s, d), "session_duration", exact=True).select(
        "session_id", "session_duration"),
    # raw durations hold outliers, negatives and nulls
    "remove_outliers": lambda s, d: clean.remove_outliers(
        raw(s, d).select("session_id", "session_duration"), "session_duration", exact=True),
    "table_schema": lambda s, d: quality.table_schema(raw(s, d, text=True)),
    "table_preview": lambda s, d: quality.table_preview(
        raw(s, d).drop("review_text", "timestamp"), order="session_id"),
    # whole reports
    "descriptive_report": _report(reports.descriptive_report),
    "temporal_report": _report(reports.temporal_report),
    "segmentation_report": _report(lambda e: reports.segmentation_report(
        e, as_of=AS_OF, exact=True, metrics=_written(e.sparkSession, segmentation.user_metrics(e), "user-metrics"))),
    "review_report": _report(reports.review_report),
    # machine learning
    "model_input": lambda s, d: prediction.model_input(enriched(s, d)),
    "train_test_split": lambda s, d: enriched(s, d).select(
        "session_id", prediction.in_training().alias("in_training")),
    "purchase_lr_auc": _lr_auc(False),
    "purchase_lr_coefficients": _lr_coefficients(False),
    "purchase_tree": _tree_leaves(False),
    "purchase_rf": _purchase_rf,
    "purchase_cv": _purchase_cv,
    "purchase_cv_metrics": _purchase_cv_metrics,
    "purchase_scores": _purchase_scores,
    "purchase_saved_model": _saved_model(False),
    # the same on a label that the features tell something about
    "signal_lr_auc": _lr_auc(True),
    "signal_lr_coefficients": _lr_coefficients(True),
    "signal_saved_model": _saved_model(True),
    "signal_tree": _tree_leaves(True),
    "purchase_learnable_auc": _purchase_learnable_auc,
    "feature_vectors": _feature_vectors,
}


try:  # the training-data operators are an optional part
    import corpus_pipeline
    from sessionlens.llm.queries import ORACLE_SQL as _LLM_SQL
    from sessionlens.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "sessionlens.llm"):
        raise
    _LLM_SQL = {}
else:
    QUERIES |= _LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_SQL = _LLM_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def entry(spark: SparkSession) -> DataFrame:
    return QUERIES["conversion_by_device"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in (_oracle_sql() | _LLM_SQL).items() if k in QUERIES}


if __name__ == "__main__":  # quick smoke: python __spark_entry__.py [sf_dir]
    import sys

    from sessionlens.config import local_session
    spark = local_session()
    d = sys.argv[1] if len(sys.argv) > 1 else SMOKE_DIR
    print(QUERIES["conversion_by_device"](spark, d).collect())
