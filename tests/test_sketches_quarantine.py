import glob
import os

import pytest
from pyspark.sql import functions as F

from sessionlens.functions import sketches
from sessionlens.operators import quality, reviews
from sessionlens.schema import SESSION_SCHEMA
from sessionlens.sources import quarantine, read_sessions_checked, read_sessions_csv, write_csv, write_parquet

HEAD = ",".join(f.name for f in SESSION_SCHEMA.fields)
LINES = [
    'U1,10,3,Livres,12.5,4.0,"bon, ""vraiment""",2024-01-02 10:00:00,Mobile,France,Paris',  # good
    "U2,soon,3,Livres,12.5,4.0,,2024-01-02 10:00:00,Mobile,France,Paris",
    'U3,10,x,Livres,"12,5",4.0,"a ""b"", c",2024-13-02 10:00:00,Mobile,France,Paris',
    "U4,10,3",
    "U5,10,3,Livres,12.5,4.0,,2024-01-02 10:00:00,Mobile,France,Paris,more,and more",
    "U6,,,,,,,,,,",                                                                         # good: all null
    "U7,99999999999,3,Livres,1e3,NaN,,2024-01-02,Mobile,France,Genève",
]


def test_every_line_is_good_or_quarantined_with_its_reason(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write("\n".join([HEAD, *LINES]) + "\n")
    checked = read_sessions_checked(spark, path)
    reasons = {r.user_id: r.reason for r in checked.collect()}
    assert reasons == {"U1": None, "U2": "bad session_duration", "U3": "bad pages_viewed, purchase_amount, timestamp",
                       "U4": "ragged", "U5": "ragged", "U6": None, "U7": "bad session_duration"}
    good, bad = quarantine(checked)
    assert good.schema == SESSION_SCHEMA and good.count() + bad.count() == len(LINES)
    # the bad lines, mended or not, are lines of CSV that say the same
    again = os.path.join(tmp_dir, "again")
    bad.select("line").write.text(again)
    assert sorted((r.user_id, r.reason) for r in read_sessions_checked(spark, again, header=False).collect()) == sorted(
        (u, r) for u, r in reasons.items() if r)
    # the plain scan reads the good rows the same way
    plain = read_sessions_csv(spark, path).where(F.col("user_id").isin("U1", "U6"))
    assert plain.exceptAll(good).isEmpty() and good.count() == 2
    # counting alone must not lose the faults of columns it does not read
    assert bad.count() == 5 and checked.groupBy("reason").count().where("reason = 'ragged'").first()["count"] == 2


def test_checked_scan_of_an_empty_file_and_a_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty.csv")
    with open(path, "w") as f:
        f.write(HEAD + "\n")
    assert read_sessions_checked(spark, path).collect() == []
    rows = [("U1", 1, None, "", 0.1, None, ' a "quoted, text" ', None, "x;y", "é", None)] * 3
    df = spark.createDataFrame(rows, SESSION_SCHEMA)
    write_csv(df, os.path.join(tmp_dir, "out"))
    got, bad = quarantine(read_sessions_checked(spark, os.path.join(tmp_dir, "out")))
    assert bad.isEmpty() and got.collect() == read_sessions_csv(spark, os.path.join(tmp_dir, "out")).collect()


def test_partitioned_sink_bounds_files_by_bytes(spark, tmp_dir):
    """24 months, one with most rows, over many input tasks: small months are one
    file each, the hot one several, none far above the advisory size."""
    month = F.when(F.col("id") % 10 < 7, 3).otherwise(F.col("id") % 12 + 1)
    year = F.when(F.col("id") % 10 < 7, 2024).otherwise(F.col("id") % 2 + 2023)
    rows = spark.range(200_000, numPartitions=40).select(year.alias("year"), month.alias("month"), F.col("id"),
                                                         F.sha2(F.col("id").cast("string"), 256).alias("text"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        write_parquet(rows, tmp_dir, partition_by=["year", "month"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {d: glob.glob(f"{d}/*.parquet") for d in glob.glob(f"{tmp_dir}/year=*/month=*")}
    hot = files.pop(f"{tmp_dir}/year=2024/month=3")
    # plain writing leaves up to 40 files in each month
    assert len(hot) > 4 and all(len(f) <= 2 for f in files.values())
    assert max(os.path.getsize(f) for f in hot) < 3 << 20
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 200_000 and back.select("id").distinct().count() == 200_000


def _months(spark):
    values = spark.range(30_000).select((F.col("id") % 7).alias("month"), F.pow(F.col("id") % 9973, 2.0).alias("x"),
                                        F.when(F.col("id") % 3 == 0, F.col("id") % 11).alias("k"), F.lit(None).cast("double").alias("none"))
    odd = spark.createDataFrame([(0, float("nan"), None, None)], "month long, x double, k long, none double")
    return values.unionByName(odd)


def test_merged_sketches_are_near_and_empty_ones_null(spark):
    df, probs = _months(spark), [0.0, 0.1, 0.5, 0.9, 1.0]
    per_month = sketches.quantile_sketches(df, ["x", "k", "none"], ["month"])
    assert per_month.count() == 7
    cuts = sketches.merged_quantiles(per_month, ["x", "k", "none"], probs)
    errors = {(r.column_name, r.quantile): r for r in sketches.rank_errors(df, cuts, ["x", "k", "none"], probs).collect()}
    assert len(errors) == 15
    for (name, _), r in errors.items():
        if name == "none":
            assert (r.cut_point, r.rows, r.rank_error) == (None, 0, None)
        else:
            assert r.rank_error <= 0.02 and r.rows == (30_000 if name == "x" else 10_000)
    nothing = sketches.merged_quantiles(sketches.quantile_sketches(df.limit(0), ["x"]), ["x"], probs)
    assert nothing.first().x is None


def test_rank_errors_are_exact(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 2, 3, 4, 5, 6, 7, 8)], "v double")
    cuts = spark.createDataFrame([([2.0, 2.0, 9.0, 0.0],)], "v array<double>")
    got = [r.rank_error for r in sketches.rank_errors(df, cuts, ["v"], [0.1, 0.5, 0.9, 0.25]).collect()]
    assert got == pytest.approx([0.0, 0.1, 0.1, 0.25])


def test_merged_distinct_counts(spark):
    df = _months(spark)
    got = {r.column_name: r.estimate for r in
           sketches.merged_distinct(sketches.distinct_sketches(df, ["x", "k", "none"], ["month"]), ["x", "k", "none"]).collect()}
    assert abs(got["x"] - 9974) < 0.05 * 9974 and got["k"] == 11 and got["none"] == 0


@pytest.mark.parametrize("tracked", [16, 64, 1 << 16])
def test_sketched_top_terms_are_exact_however_small_the_sketch(spark, tracked):
    """Frequent, tied and evenly spread words; small sketches must fall back."""
    zipf = F.expr("concat_ws(' ', transform(sequence(1, 20), k -> concat('mot', translate(cast(cast(pow((id * 31 + k * 17) % 997, 2) / 9000 as int) as string), '0123456789', 'abcdefghij'))))")
    even = F.expr("concat_ws(' ', transform(sequence(1, 8), k -> concat('w', translate(cast((id * 8 + k) % 400 as string), '0123456789', 'abcdefghij'))))")
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "Positif").otherwise("Négatif").alias("review_category"),
                                  F.when(F.col("id") % 2 == 0, zipf).otherwise(even).alias("review_text"))
    df = df.unionByName(spark.createDataFrame([("Positif", None), ("Neutre", "mot mot")], "review_category string, review_text string"))
    want = [tuple(r) for r in reviews.top_terms(df).collect()]
    assert [tuple(r) for r in reviews.top_terms_sketched(df, tracked=tracked).collect()] == want and len(want) == 20
    assert reviews.top_terms_sketched(df.limit(0), tracked=tracked).collect() == []
    few = df.where("review_category = 'Neutre'").withColumn("review_category", F.lit("Positif"))
    assert [tuple(r) for r in reviews.top_terms_sketched(few).collect()] == [("Positif", "mot", 2, 1)]


def test_schema_counts_filled_cells(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, "b")], "x int, y string")
    assert [tuple(r) for r in quality.table_schema(df).collect()] == [(0, "x", "int", 2), (1, "y", "string", 2)]
