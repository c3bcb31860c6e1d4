import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import language_id as L

DATA = "/root/testdata/sf0.01"

def slow_grams(text):
    spelled = []
    for c in text.lower():
        s = ord(c) if c.isalpha() else 0
        if s or not spelled or spelled[-1]:
            spelled.append(s)
    return {tuple(spelled[i:i + n]) for n in (1, 2, 3) for i in range(len(spelled) - n + 1)}


@pytest.mark.parametrize("block", [1 << 20, 5, 1])
def test_kernel_against_sets(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    texts = ["abc abc é", "a  --  b", "Dad dé x", "....", "zzz", "cab", "日本 本日", "кот"]
    sets = [np.unique(L.grams(t)) for t in texts]
    vocabulary = np.unique(np.concatenate(sets[:3]))
    landmarks = np.array([np.isin(vocabulary, s) for s in sets[:3]], np.float32).T
    got = L.Scorer(vocabulary, landmarks, np.array([len(s) for s in sets[:3]], float)).kernel(texts)
    for i, x in enumerate(texts):
        for j, z in enumerate(texts[:3]):
            a, b = slow_grams(x), slow_grams(z)
            assert got[i, j] == pytest.approx(len(a & b) / np.sqrt(max(1, len(a)) * len(b)), rel=1e-6)


def test_ridge_is_kernel_ridge_when_all_rows_are_landmarks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12, 30))
    k, y = x @ x.T, rng.normal(size=(12, 2))
    full = np.linalg.solve(k + L.RIDGE * 12 * np.eye(12), y)
    assert np.allclose(k @ L.ridge(k, k, y), k @ full, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    model = L.fit(docs, fold=L.learned_fold())
    got = L.predict(docs.withColumn("held_out", L.held_out()), model, keep=("doc_id", "held_out", "lang"))
    right, n = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98
    assert got.where("score < 0 or score > 1").isEmpty()


def test_edges(spark, edge_docs, empty_docs):
    model = L.fit(edge_docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(edge_docs, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[5][0] == "fr" and got[4][0] == "en" and got[7][0] in ("en", "fr")
    assert L.fit(empty_docs) is None and L.predict(empty_docs, None).collect() == []
    assert {r.lang_pred for r in L.predict(edge_docs, None).collect()} == {"und"}


# The first letter of each script's block and how many follow.
SCRIPTS = {"el": (0x3B1, 24), "ru": (0x430, 32), "hy": (0x561, 38), "he": (0x5D0, 27), "ar": (0x627, 20), "hi": (0x905, 40),
           "th": (0xE01, 46), "ka": (0x10D0, 33), "ko": (0xAC00, 900), "ja": (0x3041, 80), "zh": (0x4E00, 1500)}


def test_ten_scripts_beside_an_english_majority(spark):
    rng = np.random.default_rng(4)

    def text(first, n):
        letters = [chr(c) for c in range(first, first + n) if chr(c).isalpha()]
        weight = 1 / np.arange(1, len(letters) + 1)
        return " ".join("".join(rng.choice(letters, 4, p=weight / weight.sum())) for _ in range(30))
    rows = [(k, text(*SCRIPTS[lang]), lang) for k, lang in enumerate(lang for lang in SCRIPTS for _ in range(45))]
    rows += [(1000 + k, text(0x61, 26), "en") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, fold=L.learned_fold())
    got = L.predict(docs.withColumn("held_out", L.held_out()), model, keep=("held_out", "lang")).where("held_out")
    by = {r["lang"]: r["right"] for r in got.groupBy("lang").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    assert len(by) == 12 and min(by.values()) > 0.95


def test_sample_is_bounded(spark):
    one = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text again").alias("text"), F.lit("en").alias("lang"))
    docs = one.unionByName(spark.range(5_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("fr").alias("lang")))
    got = L._sample(docs, F.lit(True), 600)
    assert got.count() <= 600 and got.where("lang = 'en'").count() <= 1 and got.where("lang = 'fr'").count() == 300
    assert L.fit(docs, max_bytes=2_000) is not None
