"""File sources and sinks: CSV scan (fixed schema), Parquet and CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sessionlens.schema import SESSION_SCHEMA


def read_sessions_csv(spark: SparkSession, path: str, *, header: bool = True,
                      sep: str = ",", schema: StructType = SESSION_SCHEMA,
                      mode: str = "PERMISSIVE", multi_line: bool = False,
                      timestamp_format: str | None = None) -> DataFrame:
    """Scan session CSV files with an explicit schema (no inference).

    PERMISSIVE keeps malformed rows and nulls the bad cells, as the
    reference's default read does. Splittable (one task per file block)
    unless ``multi_line`` is set for quoted fields holding line breaks, in
    which case each file is one task.
    """
    reader = (spark.read.schema(schema)
              .option("header", header)
              .option("sep", sep)
              .option("mode", mode)
              .option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False)
              .option("multiLine", multi_line))
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def read_sessions_checked(spark: SparkSession, path: str, *, header: bool = True, sep: str = ",",
                          schema: StructType = SESSION_SCHEMA, multi_line: bool = False) -> DataFrame:
    """Scan session CSV files and say what is wrong with each line.

    All typed columns, ``reason`` (null for a good row) and ``line`` (the text of a
    bad row, to be mended and read again). ``ragged``: fewer or more fields than
    the schema has; its cells are what could be told apart. ``bad <column>, ...``: the
    cells that are not of their column's type, null here; blanks around numbers
    are no fault. Cells are read as text and cast, so one pass finds both."""
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    names = [f.name for f in schema.fields]
    rows = (spark.read.schema(texts.add("_line", StringType()))
            .option("header", header).option("sep", sep).option("mode", "PERMISSIVE").option("escape", '"')
            .option("columnNameOfCorruptRecord", "_line")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("multiLine", multi_line).csv(path))
    typed = {f.name: F.col(f.name) if isinstance(f.dataType, StringType) else F.col(f.name).try_cast(f.dataType)
             for f in schema.fields}
    bad = F.array_compact(F.array(*[F.when(F.col(n).isNotNull() & typed[n].isNull(), F.lit(n)) for n in names]))
    reason = F.when(F.col("_line").isNotNull(), "ragged").when(
        F.size(bad) > 0, F.concat(F.lit("bad "), F.array_join(bad, ", ")))
    whole = F.to_csv(F.struct(*names), {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false",
                                        "ignoreTrailingWhiteSpace": "false"})
    return rows.select(*[typed[n].alias(n) for n in names], reason.alias("reason"),
                       F.when(reason.isNotNull(), F.coalesce("_line", whole)).alias("line"))


def quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Checked rows -> good sessions, and the bad lines with their reasons. Every
    row is in exactly one of them."""
    good = checked.where("reason is null").drop("reason", "line")
    return good, checked.where("reason is not null").select("reason", "line")


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink; ``partition_by`` (e.g. year, month) enables pruning later. Rows
    of one partition are brought together before the write, else each task would
    leave a file in every partition; adaptive execution cuts large ones (a hot month)
    into several tasks, and files, of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and packs small ones."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def escape_breaks(df: DataFrame, *columns: str) -> DataFrame:
    """Line breaks (and backslashes) of text columns as two-character escapes,
    so that a CSV has one line a row and can be split among tasks."""
    def escaped(c):
        for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            c = F.replace(c, F.lit(plain), F.lit(code))
        return c
    return df.withColumns({c: escaped(F.col(c)) for c in columns})


def unescape_breaks(df: DataFrame, *columns: str) -> DataFrame:
    """The reverse of ``escape_breaks``."""
    def plain(c):
        # a backslash pair is put aside first, so that its second half starts no escape
        c = F.replace(c, F.lit("\\\\"), F.lit("\\\0"))
        for code, text in (("\\n", "\n"), ("\\r", "\r"), ("\\\0", "\\")):
            c = F.replace(c, F.lit(code), F.lit(text))
        return c
    return df.withColumns({c: plain(F.col(c)) for c in columns})


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",",
              single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV export; blanks at the edges of a text stay, quotes are doubled.
    ``single_file`` funnels the write through one task and is
    only meant for small result tables (dashboards), never for raw data."""
    if single_file:
        df = df.coalesce(1)
    (df.write.mode(mode).option("header", header).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("escape", '"').csv(path))
