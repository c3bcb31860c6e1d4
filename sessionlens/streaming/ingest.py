"""Continuous form of the loader + Parquet sink.

Session CSV files that keep arriving in a folder are read with the same
fixed schema, validity-filtered, given the purchase fill and the row-level
derived columns, and appended to Parquet partitioned by year/month, with
exactly-once file output through the checkpoint. Rating imputation and
session numbering need the whole table (a global mean, a per-user order),
so they stay in the batch plan that reads this sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlens.operators import clean, features
from sessionlens.schema import SESSION_SCHEMA


def stream_sessions(spark: SparkSession, folder: str, *, header: bool = True, sep: str = ",",
                    multi_line: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(SESSION_SCHEMA)
              .option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("multiLine", multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def prepare(stream: DataFrame) -> DataFrame:
    """Row-level cleaning and enrichment (no cross-row state needed)."""
    valid = clean.valid_sessions(stream).withColumn(
        "purchase_amount", F.coalesce(F.col("purchase_amount"), F.lit(0.0)))
    return features.review_category(features.purchase_flag(
        features.session_category(features.time_features(valid))))


def ingest(spark: SparkSession, source_folder: str, sink_folder: str, checkpoint: str, *,
           multi_line: bool = False, available_now: bool = False) -> StreamingQuery:
    """Start the append stream; ``available_now`` processes what is there and stops."""
    writer = (prepare(stream_sessions(spark, source_folder, multi_line=multi_line)).writeStream
              .format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .partitionBy("year", "month"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_folder)
