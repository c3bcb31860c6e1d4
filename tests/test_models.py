"""Models against independent solvers and brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle.sql import AREA
from sessionlens.operators import prediction

SF = "/root/testdata/sf0.001"


def slow_area(pairs):
    """Share of (positive, negative) pairs with the positive ahead, ties half."""
    up, down = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    if not up or not down:
        return None
    return sum((a > b) + (a == b) / 2 for a in up for b in down) / len(up) / len(down)


@pytest.mark.parametrize("seed", range(3))
def test_areas_against_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(0, 3)), float(np.round(rng.random() ** 3, 2)), int(rng.random() < .4)) for _ in range(300)]
    rows += [(7, 0.5, 1), (7, 1.0, 1), (8, 0.0, 0), (9, 1.0, 1), (9, 0.0, 0), (9, 0.0, 1)]
    rows += [(None, 0.25, y) for y in (0, 1, 1)]
    counts = spark.createDataFrame(rows, "g int, score double, y int").groupBy("g", "score").agg(
        F.count_if(F.col("y") > 0).alias("positives"), F.count_if(F.col("y") == 0).alias("negatives"))
    got = {r.g: (r.rows, r.auc) for r in prediction.roc_areas(counts, ("g",)).collect()}
    for g in {r[0] for r in rows}:
        pairs = [(s, y) for k, s, y in rows if k == g]
        assert got[g][0] == len(pairs) and got[g][1] == (pytest.approx(slow_area(pairs)) if slow_area(pairs) is not None else None)
    whole = prediction.roc_areas(counts.groupBy("score").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")))
    assert whole.first().auc == pytest.approx(slow_area([(s, y) for _, s, y in rows]))
    assert prediction.roc_areas(counts.limit(0)).collect() == [(0, None)]


def solved(x, y, reg=0.01, elastic_net=0.8):
    """Elastic-net logistic weights by Newton steps and coordinate descent, over
    features divided by their deviation."""
    sd = x.std(axis=0, ddof=1)
    z = np.c_[np.ones(len(x)), x / np.where(sd > 0, sd, 1)]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-z @ w))
        g, h, before = z.T @ (p - y) / len(y), (z * (p * (1 - p))[:, None]).T @ z / len(y), w.copy()
        for _ in range(400):
            for j in range(len(w)):
                r = g[j] + h[j] @ (w - before) - h[j, j] * w[j]
                w[j] = -r / h[j, j] if j == 0 else -np.sign(r) * max(abs(r) - reg * elastic_net, 0) / (h[j, j] + reg * (1 - elastic_net))
        if abs(w - before).max() < 1e-10:
            break
    return w[0], w[1:] / np.where(sd > 0, sd, 1)


@pytest.mark.parametrize("signal", [False, True])
def test_logistic_weights_against_an_own_solver(spark, signal):
    model, train, _ = E._lr_model(spark, SF, signal)
    rows = prediction.feature_vectors(model, train).join(train.select("session_id", "label"), "session_id").collect()
    bias, weights = solved(np.array([r.features for r in rows]), np.array([r.label for r in rows], float))
    got = [r.coefficient for r in prediction.coefficients(model, train).orderBy("position").collect()]
    assert np.allclose(got, [*weights, bias], atol=1e-6)
    if signal:
        assert np.count_nonzero(got) > 5


def test_grouped_fit_is_the_row_fit(spark):
    _, train, _ = E._lr_model(spark, SF, True)
    rows = prediction.fit(prediction.logistic_pipeline(max_iter=500), train)
    a = [r.coefficient for r in prediction.coefficients(rows, train).collect()]
    b = [r.coefficient for r in prediction.coefficients(prediction.fit_logistic(train), train).collect()]
    assert np.allclose(a, b, atol=5e-3)


def test_fold_metrics_against_sql_over_the_same_scores(spark):
    train, _ = E._split(spark, SF, E._signal(E.enriched(spark, SF)))
    candidates = prediction.grid(num_trees=(3, 5), max_depth=(2, 4), impurity=("gini",))
    kept = {}

    def keep(df, name):
        kept[name] = df.toPandas() if name.startswith("scores") else None
        return spark.createDataFrame(kept[name], df.schema) if kept[name] is not None else df.cache()
    counts = prediction.out_of_fold_counts(train, candidates, folds=3, parallelism=2, keep=keep)
    got = prediction.fold_metrics(counts, candidates).collect()
    assert len(got) == 12 and len(kept) == 13
    con, table = duckdb.connect(), counts.toPandas()
    for r in got:
        part = table[(table.candidate == r.candidate) & (table.fold == r.fold)]
        con.register("part", part)
        rows = "(SELECT score, 1 AS y FROM part, range(positives) UNION ALL SELECT score, 0 FROM part, range(negatives))"
        _, n, auc = con.execute(AREA.format(name="'x'", scored=rows)).fetchall()[0]
        assert (r.rows, r.auc) == (n, pytest.approx(auc, abs=1e-12))
        assert {k: r[k] for k in ("num_trees", "max_depth", "impurity")} == candidates[r.candidate]
    by_fold = {r.fold: r.rows for r in got}
    assert sum(by_fold.values()) == train.count()
    mean = {c: np.mean([r.auc for r in got if r.candidate == c]) for c in range(4)}
    assert prediction.best_candidate(spark.createDataFrame(got)) == max(mean, key=lambda c: (mean[c], -c))


def test_one_tree_has_the_best_first_split(spark):
    """Gini gain of every split of the root by hand."""
    train, _ = E._split(spark, SF, E._signal(E.enriched(spark, SF)))
    model = prediction.tree(train, max_depth=1)
    rows = prediction.feature_vectors(model, train).join(train.select("session_id", "label"), "session_id").collect()
    x, y = np.array([r.features for r in rows]), np.array([r.label for r in rows], float)
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) if len(v) else 0
    best = max(((gini(y) - (m := x[:, j] <= v).mean() * gini(y[m]) - (~m).mean() * gini(y[~m]), -j, -v)
                for j in range(x.shape[1]) for v in np.unique(x[:, j])[:-1]))
    j, v = -best[1], -best[2]
    want = np.where(x[:, j] <= v, y[x[:, j] <= v].mean(), y[x[:, j] > v].mean())
    got = {r.session_id: r.probability for r in prediction.leaf_table(model, train).collect()}
    same = model.stages[-1].trees[0].depth == 1  # equal predictions would become one leaf
    assert not same or np.allclose([got[r.session_id] for r in rows], want)
