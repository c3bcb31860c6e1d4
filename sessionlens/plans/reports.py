"""Whole reports: named maps of lazy result DataFrames (one per analysis
family), the way the reference hands results around. Nothing runs until a
caller writes or collects a result."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sessionlens.operators import (cohorts, descriptive, reviews, segmentation, series,
                                   temporal)


def descriptive_report(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "stats": descriptive.describe_text(df),
        "statsTyped": descriptive.describe_sessions(df),
        "categoryDistribution": descriptive.category_distribution(df),
        "countryDistribution": descriptive.country_distribution(df),
        "conversionRate": descriptive.conversion_rate(df),
        "conversionByDevice": descriptive.conversion_by_device(df),
        "conversionBySessionCategory": descriptive.conversion_by_session_category(df),
        "correlations": descriptive.correlation_matrix(df),
    }


def temporal_report(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "sessionsByHour": temporal.sessions_by_hour(df),
        "sessionsByDayOfWeek": temporal.sessions_by_weekday(df),
        "sessionsByMonth": temporal.sessions_by_month(df),
        "peakHours": temporal.peak_hour_by_weekday(df),
        "salesTrend": temporal.sales_trend(df),
    }


def segmentation_report(df: DataFrame, *, as_of=None, exact: bool = False,
                        metrics: DataFrame | None = None) -> dict[str, DataFrame]:
    """``metrics``: a staged ``user_metrics(df)``, read by five of the results
    and each cut-point pass; without it each result derives its own."""
    metrics = segmentation.user_metrics(df) if metrics is None else metrics
    behaviour = segmentation.behavior_segments(metrics)
    scored = segmentation.rfm_scores(segmentation.rfm_base(metrics, as_of), exact=exact)
    labelled = segmentation.rfm_segments(scored)
    return {
        "behaviorSegmentation": behaviour,
        "segmentDistribution": segmentation.segment_distribution(behaviour),
        "rfmAnalysis": scored,
        "rfmSegments": labelled,
        "rfmDistribution": segmentation.rfm_distribution(labelled),
        "cohortRetention": cohorts.cohort_retention(df),
    }


def review_report(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "reviewDistribution": reviews.review_distribution(df),
        "reviewsByCategory": reviews.reviews_by_category(df),
        "reviewsByCountry": reviews.reviews_by_country(df),
        "commonPositiveTerms": reviews.positive_terms(df),
        "commonNegativeTerms": reviews.negative_terms(df),
        "topTerms": reviews.top_terms(df),
        "reviewImpact": reviews.review_impact(df),
    }


def dashboard(df: DataFrame) -> dict[str, DataFrame]:
    """The chart series; ``series`` holds all of them from one scan."""
    return {
        "category_distribution": series.chart_category_distribution(df),
        "conversion_by_category": series.chart_conversion_by_category(df),
        "sessions_by_hour": series.chart_sessions_by_hour(df),
        "review_distribution": series.chart_review_distribution(df),
        "purchase_by_pages": series.chart_purchase_by_pages(df),
        "conversion_by_device": series.chart_conversion_by_device(df),
        "sessions_by_day": series.chart_sessions_by_day(df),
        "series": series.dashboard_series(df),
    }
