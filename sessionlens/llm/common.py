"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from sessionlens.config import scratch_path

ROWS_PER_SLICE = 512

_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64())}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors as Spark sends any ``--py-files``
    archive, once per application, so tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="ship-")  # on the driver; Spark serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def map_arrow(df: DataFrame, run, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(doc_id).cast("string"))


def per_text(df: DataFrame, kernel: Callable[[], Callable[[list], Sequence]],
             fields: Sequence[tuple[str, str]], *, text: str = "text",
             keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus new ``fields`` computed from each row's text.

    ``kernel()`` is called once per task and returns a function from a list of
    texts (None for null) to one sequence per field. Rows stream through in
    slices, so memory follows the slice and not the partition. A new field
    replaces a kept column of the same name.
    """
    names = {n for n, _ in fields}
    keep = [c for c in keep if c not in names]
    schema = StructType([df.schema[c] for c in keep]
                        + [StructField(n, _parse_datatype_string(t)) for n, t in fields])
    source = df.select(*[F.col(f"`{c}`") for c in keep],
                       *([] if text in keep else [F.col(f"`{text}`")]))
    at, types = source.columns.index(text), [_ARROW[t] for _, t in fields]
    out_names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = kernel()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(start, ROWS_PER_SLICE)
                made = apply(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.array(c, type=t) for c, t in zip(made, types)], names=out_names)

    return map_arrow(source, run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def within_bytes(rows: DataFrame, value: str, by: Sequence[str], order: Sequence[str], budget: int) -> DataFrame:
    """Of a bounded table the rows whose binary values, added up per ``by`` in the
    order given, stay within ``budget``; the first of each stays in any case."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.octet_length(value).cast("long")).over(window)
    return (rows.withColumn("_upto", upto).withColumn("_nth", F.count(F.lit(1)).over(window))
            .where((F.col("_upto") <= budget) | (F.col("_nth") == 1)).drop("_upto", "_nth"))


class Scratch:
    """Written intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage, so a lost executor never causes the work
    before it to run again, and its reads are plain scans. What is left when
    Python ends, such as the tables that lazy results read, is deleted then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        atexit.register(self._end, SparkContext._active_spark_context)

    def _end(self, context: SparkContext) -> None:
        if context is not None and context is SparkContext._active_spark_context:
            self.drop()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(rows: DataFrame, order: Sequence[str | Column], scratch: Scratch, name: str,
             number: str = "at") -> DataFrame:
    """``rows`` plus ``number``: 0, 1, 2, ... in the order given, rows that are
    equal in it in any order. Rows are dealt by ranges of the order, equal ones
    over several ranges where they are many, and numbered from the count of the
    ranges before, so no task holds more than a range."""
    dealt = (rows.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie"))
    placed = scratch.write(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*rows.columns, (inside + F.col("_before")).alias(number)))
