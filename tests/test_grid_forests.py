"""The grid search's shared forests against forests fitted for each candidate."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from sessionlens.operators import prediction as P


def _rows(spark, n=600):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(1, 40)), int(rng.integers(1, 9)), int(rng.integers(0, 24)), "DM"[i % 2],
             "abcdef"[int(rng.integers(0, 6))], "1234567"[i % 7]) for i in range(n)]
    rows = [(*r, int((r[1] > 20) ^ (r[5] in "ab") ^ (rng.random() < 0.2))) for r in rows]
    return spark.createDataFrame(rows, ["session_id", *P.NUMERIC_FEATURES, *P.CATEGORICAL_FEATURES, P.LABEL]).coalesce(2)


def test_one_forest_for_all_depths_scores_as_one_for_each(spark, monkeypatch):
    train, fits, plain = _rows(spark), [], RandomForestClassifier._fit
    candidates = P.grid(num_trees=(3, 5), max_depth=(2, 4, 9), impurity=("gini",))
    ready = Pipeline(stages=P.feature_stages()).fit(train).transform(P.folded(train)).cache()
    want = set()
    for (number, how), fold in ((c, fold) for c in enumerate(candidates) for fold in range(3)):
        rf = P.forest_pipeline(seed=42, **how).getStages()[-1]
        scored = rf.fit(ready.where(F.col("fold") != fold)).transform(ready.where(F.col("fold") == fold))
        want |= {(number, fold, *r) for r in P.score_counts(scored).collect()}
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, data: fits.append(1) or plain(self, data))
    got = P.out_of_fold_counts(train, candidates, parallelism=2, keep=lambda df, name: df.cache())
    assert {tuple(r) for r in got.collect()} == want
    assert len(fits) == 6  # two numbers of trees, three folds


def test_cut_leaves_by_hand():
    # 0 (1 (2 3) 4 (5 6)): cut at 1 both sides say class 1, so the root is the only leaf
    tree, left, right = np.zeros(7, int), np.array([1, 2, -1, -1, 5, -1, -1]), np.array([4, 3, -1, -1, 6, -1, -1])
    counts = np.array([[6, 10], [3, 5], [3, 0], [0, 5], [3, 5], [1, 5], [2, 0]], float)
    assert np.allclose(P.cut_leaves(tree, left, right, counts, 1), [[6 / 16, 10 / 16]] * 4)
    assert np.allclose(P.cut_leaves(tree, left, right, counts, 2), [[1, 0], [0, 1], [1 / 6, 5 / 6], [1, 0]])
    alone = np.zeros(1, int)
    assert np.allclose(P.cut_leaves(alone, alone - 1, alone - 1, np.array([[1.0, 3.0]]), 5), [[0.25, 0.75]])


def test_deep_forests_keep_the_nodes_of_rows(spark):
    ready = Pipeline(stages=P.feature_stages()).fit(_rows(spark)).transform(_rows(spark)).cache()
    deep, flat = (P.forest_pipeline(num_trees=4, max_depth=d).getStages()[-1] for d in (10, 5))
    assert deep.getCacheNodeIds() and not flat.getCacheNodeIds()
    assert deep.fit(ready).toDebugString.split("\n", 1)[1] == deep.setCacheNodeIds(False).fit(ready).toDebugString.split("\n", 1)[1]


def test_forests_that_memory_cannot_hold_together_are_fitted_one_by_one(spark, monkeypatch):
    train, running, most, plain = _rows(spark), [], [], RandomForestClassifier._fit

    def fit(self, data):
        running.append(1)
        most.append(len(running))
        try:
            return plain(self, data)
        finally:
            running.pop()
    monkeypatch.setattr(RandomForestClassifier, "_fit", fit)
    monkeypatch.setattr(P, "storage_bytes", lambda spark: P.forest_bytes(train.count(), 3))
    candidates = P.grid(num_trees=(3,), max_depth=(2, 4), impurity=("gini", "entropy"))
    P.out_of_fold_counts(train, candidates, parallelism=3, keep=lambda df, name: df.cache())
    assert len(most) == 6 and max(most) == 1


def test_memory_for_held_rows(spark):
    assert P.storage_bytes(spark) > 100 << 20
    assert P.forest_bytes(1000, 30) > P.forest_bytes(1000, 10) > 0


def test_equal_rows_are_scored_once(spark, monkeypatch):
    rows = _rows(spark, 60).collect()
    many = spark.createDataFrame([(100 * i + r.session_id, *r[1:]) for r in rows for i in range(20)], _rows(spark, 1).schema)
    scored, plain = [], P.score_counts
    monkeypatch.setattr(P, "score_counts", lambda df, *a, **b: scored.append(df.count()) or plain(df, *a, **b))
    counts = P.out_of_fold_counts(many, P.grid(num_trees=(3,), max_depth=(2, 4), impurity=("gini",)), keep=lambda df, name: df.cache())
    assert len(scored) == 6 and max(scored) <= 60
    got = counts.groupBy("candidate").agg(F.sum(F.col("positives") + F.col("negatives")).alias("rows")).collect()
    assert [r.rows for r in got] == [1200, 1200]
