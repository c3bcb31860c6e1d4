import numpy as np
from pyspark.sql import functions as F

from sessionlens.llm import toxicity as T

DATA = "/root/testdata/sf0.1"


def test_features_are_words_pairs_and_skips():
    assert len(T.features("One two, three FOUR")) == 4 + 3 + 2
    assert (T.features("a-b c") == T.features("A b  C!")).all()
    assert len(T.features(None)) == len(T.features(" .,")) == 0


def test_ftrl_against_the_update_rule_row_by_row():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 64, 8)) for _ in range(60)]
    y = np.array([float(5 in r) for r in rows])
    y[0] = 1.0
    model = T.ftrl(rows, y, bits=6, epochs=2, seed=4)
    z, n, order = [0.0] * 65, [0.0] * 65, np.random.default_rng(4)

    def weight(i):
        if abs(z[i]) <= T.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * T.L1) / ((T.BETA + n[i] ** 0.5) / T.ALPHA + T.L2)
    for _ in range(2):
        for k in order.permutation(60):
            at = [*rows[k], 64]
            w = [weight(i) for i in at]
            g = 1 / (1 + np.exp(-sum(w))) - y[k]
            for i, wi in zip(at, w):
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / T.ALPHA
                z[i] += g - s * wi
                n[i] += g * g
    want = np.array([weight(i) for i in range(65)])
    assert np.allclose(model.dense(), want[:64], atol=1e-5)
    assert abs(model.bias - want[64]) < 1e-9


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = T.fit(docs, labels, fold=T.learned_fold())
    assert len(model.index) < 5_000  # L1 keeps the weights few
    got = (T.score(docs.withColumn("held_out", T.held_out()), model, keep=("doc_id", "held_out"))
           .where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect())
    share = {r.toxic: r.p for r in got}
    assert share[1] > 0.7 and share[0] < 0.01


def test_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(5, 1, None), (5, 0, 1), (4, 0, 0), (6, None, 1), (None, 1, 1), (6, 0, 0)],
                                   "doc_id long, toxic int, quality int")
    model = T.fit(edge_docs, labels)
    rows = T.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept = T.drop_toxic(edge_docs, model)
    assert kept.schema == edge_docs.schema
    none = T.fit(edge_docs, labels.limit(0))
    assert len(none.index) == 0 and none.bias == 0.0
    assert T.score(empty_docs, none).collect() == []


def test_sample_is_bounded_when_ids_repeat(spark):
    docs = spark.range(20_000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 5).alias("text"))
    docs = docs.unionByName(spark.range(2, 500).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")))
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = T.training_rows(docs, labels, F.lit(True), 100)
    assert rows.count() == 100 and rows.select("doc_id").distinct().count() == 100
    assert T.training_rows(docs, labels, F.lit(True), 10_000).where("doc_id < 2").count() == 2
    assert T.fit(docs, labels, max_bytes=300) is not None
