"""Sources/sinks round trips and ML determinism."""

import os

from pyspark.sql import functions as F

from sessionlens.operators import clean, features, prediction
from sessionlens.plans.staging import stage, unstage
from sessionlens.sources import read_sessions_csv, session_view, write_csv, write_parquet

SF = "/root/testdata/sf0.001"

BAD_CSV = """user_id,session_duration,pages_viewed,product_category,purchase_amount,review_score,review_text,timestamp,device_type,country,city
u1,abc,3,Livres,10.5,4,"bon, vraiment",2024-01-01T10:11:12,Mobile,France,Paris
u2,3.0,2,Livres,,5,ok,2024-01-01 10:11:12,Desktop,France,Lyon
u3,7,4,Sport,20.0,,,2024-01-02 08:00:00,Mobile,Suisse,Genève
"""


def test_csv_scan_is_permissive_with_fixed_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write(BAD_CSV)
    rows = read_sessions_csv(spark, path).orderBy("user_id").collect()
    assert len(rows) == 3
    assert rows[0].session_duration is None and rows[0].review_text == "bon, vraiment"
    assert rows[1].session_duration is None and rows[1].purchase_amount is None
    assert rows[0].timestamp is not None and rows[1].timestamp is not None
    assert rows[2].city == "Genève"


def test_parquet_and_csv_round_trip(spark, tmp_dir):
    raw = session_view(spark, SF, with_text=False).drop("review_text")
    enriched = features.transform(clean.clean_sessions(raw))
    out = os.path.join(tmp_dir, "enriched")
    write_parquet(enriched, out, partition_by=["year", "month"])
    back = spark.read.parquet(out)
    assert back.count() == enriched.count()
    pruned = back.filter((F.col("year") == 1996) & (F.col("month") == 3))
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    csv_out = os.path.join(tmp_dir, "export")
    write_csv(enriched.select("session_id", "device_type"), csv_out, sep=";", single_file=True)
    files = [f for f in os.listdir(csv_out) if f.endswith(".csv")]
    assert len(files) == 1
    assert spark.read.option("header", True).option("sep", ";").csv(csv_out).count() == enriched.count()


def test_checkpoint_staging_cuts_lineage(spark):
    df = clean.clean_sessions(session_view(spark, SF, with_text=False))
    staged = stage(df, how="checkpoint")
    assert staged.count() == df.count()
    assert "LogicalRDD" in staged._jdf.queryExecution().analyzed().toString()


def test_table_staging_reads_the_columns_asked_for_and_is_freed(spark):
    df = clean.clean_sessions(session_view(spark, SF, with_text=False))
    staged = stage(df, how="table")
    assert staged.dtypes == df.dtypes and sorted(staged.collect(), key=str) == sorted(df.collect(), key=str)
    plan = staged.select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:string>" in plan and "orders.parquet" not in plan
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder)
    unstage(staged)
    assert not os.path.exists(folder)
    assert unstage(stage(df)) is None  # a persisted one


def _learnable(spark, n=2000):
    df = spark.range(n).select(
        F.col("id").alias("session_id"),
        (F.col("id") * 37 % 40).cast("int").alias("session_duration"),
        (F.col("id") * 13 % 9 + 1).cast("int").alias("pages_viewed"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.when(F.col("id") % 2 == 0, "Desktop").otherwise("Mobile").alias("device_type"),
        F.when(F.col("id") % 3 == 0, "Livres").otherwise("Sport").alias("product_category"),
        F.when(F.col("id") % 7 == 0, "Monday").otherwise("Friday").alias("day_of_week"))
    buy = (((F.col("device_type") == "Desktop") & (F.col("session_duration") >= 15)) |
           ((F.col("device_type") == "Mobile") & (F.col("session_duration") >= 25)))
    flip = F.col("session_id") % 20 == 0
    return df.withColumn("label", F.when(buy != flip, 1).otherwise(0))


def test_models_learn_and_are_deterministic(spark, tmp_dir):
    data = _learnable(spark)
    train, test = prediction.train_test_split(data)
    lr = prediction.fit(prediction.logistic_pipeline(max_iter=50, reg=0.0, elastic_net=0.0), train)
    auc = prediction.area_under_roc(lr, test)
    assert auc > 0.9
    lr2 = prediction.fit(prediction.logistic_pipeline(max_iter=50, reg=0.0, elastic_net=0.0), train)
    assert abs(prediction.area_under_roc(lr2, test) - auc) < 1e-9
    rf = prediction.fit(prediction.forest_pipeline(seed=42), train)
    assert prediction.area_under_roc(rf, test) > 0.9
    coefs = prediction.coefficients(lr, train).collect()
    assert any(abs(r.coefficient) > 0 for r in coefs if r.feature != "(intercept)")
    assert {"session_duration", "(intercept)"} <= {r.feature for r in coefs}

    path = os.path.join(tmp_dir, "model")
    prediction.save(lr, path)
    scored = prediction.score(lr, test).select("session_id", "purchase_probability").collect()
    reloaded = prediction.score(prediction.load(path), test).select("session_id", "purchase_probability").collect()
    assert sorted(scored) == sorted(reloaded)
    assert all(0.0 <= r.purchase_probability <= 100.0 for r in scored)
    probs = [r.purchase_probability for r in scored]
    assert probs == sorted(probs, reverse=True)


def test_unseen_category_is_kept(spark):
    data = _learnable(spark, 400)
    train, test = prediction.train_test_split(data)
    model = prediction.fit(prediction.logistic_pipeline(), train)
    odd = test.withColumn("device_type", F.lit("Tablet"))
    assert prediction.score(model, odd).count() == test.count()


def test_cross_validation_small_grid(spark):
    data = _learnable(spark, 600)
    train, test = prediction.train_test_split(data)
    best = prediction.cross_validate(train, num_trees=(5, 10), max_depth=(3,), impurity=("gini",),
                                     folds=2, parallelism=2)
    assert prediction.area_under_roc(best, test) > 0.8


class _FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _FakeContext:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getConf(self):
        return _FakeConf()

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _FakeSession:
    def __init__(self, master):
        self.sparkContext = _FakeContext(master)
        self.conf = _FakeConf()


def test_no_local_checkpoint_folder_on_a_cluster():
    from sessionlens.config import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(_FakeSession("yarn")) is None          # never invent a local folder
    local = _FakeSession("local[4]")
    made = ensure_checkpoint_dir(local)                                   # tests/bench only
    assert made and local.sparkContext.dir == made
    shared = _FakeSession("k8s://cluster")
    shared.conf["spark.checkpoint.dir"] = "hdfs://nn/ckpt"
    assert ensure_checkpoint_dir(shared) == "hdfs://nn/ckpt"
