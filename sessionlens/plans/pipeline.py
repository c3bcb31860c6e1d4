"""End-to-end batch run: scan -> audit -> clean -> enrich -> stage once ->
every report -> Parquet sink.

The raw source is read by the null audit, the row audit, the raw mean and the
main pass, each with its own columns; the enriched table and the per-user table
are staged once and every result reads the staged copies.
With ``stage_how="checkpoint"`` or ``"table"`` the staged tables live in the cluster's
``spark.checkpoint.dir`` so lost executors cost a re-read, not a recompute.

usage: python -m sessionlens.plans.pipeline --csv PATH --out DIR [--as-of YYYY-MM-DD]
       python -m sessionlens.plans.pipeline --tables SF_DIR --out DIR
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionlens.operators import clean, features, quality, segmentation
from sessionlens.plans import reports
from sessionlens.plans.staging import stage, unstage
from sessionlens.sources import read_sessions_csv, session_view, write_parquet
from sessionlens.sources.tables import attach_text


def run(raw: DataFrame, out_dir: str, *, as_of=None, exact: bool = False,
        stage_how: str = "persist",
        attach: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, str]:
    """Compute and write every result under ``out_dir/<group>/<name>``;
    returns the written paths.

    ``attach`` adds columns kept in another table (the review text) after
    cleaning, which never reads them: the raw mean and the validity filter
    then run on the narrow table and the join sees only valid rows."""
    written: dict[str, str] = {}
    add = attach or (lambda df: df)

    def sink(group: str, results: dict[str, DataFrame]) -> None:
        for name, df in results.items():
            path = os.path.join(out_dir, group, name)
            write_parquet(df, path)
            written[f"{group}/{name}"] = path

    sink("audit", {"null_counts": clean.null_counts(add(raw)), "clean_audit": clean.clean_audit(raw)})
    valid, staged = add(clean.clean_sessions(raw)), []
    if stage_how == "table":  # session numbers count the keys twice: on the written order columns
        staged.append(stage(valid, how=stage_how))
        enriched = stage(features.transform(staged[0]), how=stage_how)
    else:
        enriched = stage(features.transform(valid, hot_from=raw), how=stage_how)
    staged.append(enriched)
    try:
        write_parquet(enriched, os.path.join(out_dir, "enriched"), partition_by=["year", "month"])
        written["enriched"] = os.path.join(out_dir, "enriched")
        sink("descriptive", reports.descriptive_report(enriched))
        sink("temporal", reports.temporal_report(enriched))
        metrics = stage(segmentation.user_metrics(enriched), how=stage_how)
        staged.append(metrics)
        sink("segmentation", reports.segmentation_report(enriched, as_of=as_of, exact=exact, metrics=metrics))
        sink("reviews", reports.review_report(enriched))
        sink("dashboard", reports.dashboard(enriched))
        sink("quality", {"profile": quality.data_quality(enriched, exact=exact)})
    finally:
        if stage_how in ("persist", "table"):
            for df in staged:
                unstage(df)
    return written


def main() -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv")
    src.add_argument("--tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--exact", action="store_true")
    ap.add_argument("--zone", default="UTC", help="time zone of hours, days and months")
    ap.add_argument("--stage", default="persist", choices=["persist", "checkpoint", "table", "none"])
    args = ap.parse_args()
    spark = (SparkSession.builder.appName("sessionlens")
             .config("spark.sql.session.timeZone", args.zone)
             .config("spark.ui.enabled", "false").getOrCreate())
    if args.csv:
        raw, attach = read_sessions_csv(spark, args.csv), None
    else:
        raw = session_view(spark, args.tables, with_text=False)
        attach = lambda df: attach_text(spark, args.tables, df)
    for key, path in sorted(run(raw, args.out, as_of=args.as_of, exact=args.exact,
                                stage_how=args.stage, attach=attach).items()):
        print(key, path)


if __name__ == "__main__":
    main()
