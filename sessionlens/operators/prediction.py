"""Purchase prediction with Spark ML.

Features: session_duration, pages_viewed, hour (numeric) and one-hot
device_type, product_category, day_of_week; label = has_purchased.
Training is distributed by MLlib (tree aggregates for LR, per-partition
statistics for forests); the driver only holds model parameters. The features
take few values, so the logistic model is fitted on counts of equal rows: one
pass over the sessions, then iterations over at most as many rows as there are
combinations of values. The grid search grows one forest for all depths of a
candidate: a tree grown to depth 5 is the upper part of the one grown to 15. It
grows them from the rows, as each row is drawn by itself, and scores equal rows once.
"""

from __future__ import annotations

from contextlib import contextmanager
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Condition

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LogisticRegression, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StandardScalerModel,
                                StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlens.config import delete_path, scratch_folder

NUMERIC_FEATURES = ["session_duration", "pages_viewed", "hour"]
CATEGORICAL_FEATURES = ["device_type", "product_category", "day_of_week"]
LABEL = "label"


KEY = "session_id"
WALKED_DEPTH = 5  # to this depth walking down is as fast as reading kept nodes


def row_key(df: DataFrame, key: str | None = None) -> Column:
    """A whole number that tells rows apart: ``key``, else ``session_id``, else
    a digest of the row."""
    name = key or (KEY if KEY in df.columns else None)
    return F.col(name) if name else F.xxhash64(*[F.col(c) for c in df.columns])


def model_input(df: DataFrame, key: str | None = None) -> DataFrame:
    """The model table: the six features and the label, and the row key as
    ``session_id`` (a digest of the row where the sessions have no id)."""
    return df.select(row_key(df, key).alias(key or KEY), *NUMERIC_FEATURES, *CATEGORICAL_FEATURES,
                     F.col("has_purchased").alias(LABEL))


def in_training(key: str | Column = KEY, percent_train: int = 70) -> Column:
    """Row-stable 70/30 split from the key (independent of partitioning, so a
    re-run or a lost task puts every row in the same half). Any key will do:
    negative and very large ones are reduced first."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(key, F.lit(100)) * 7919, F.lit(100)) < percent_train


def train_test_split(df: DataFrame, key: str | None = None,
                     percent_train: int = 70) -> tuple[DataFrame, DataFrame]:
    cond = in_training(row_key(df, key), percent_train)
    return df.filter(cond), df.filter(~cond)


def feature_stages() -> list:
    index_cols = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    vec_cols = [f"{c}_vec" for c in CATEGORICAL_FEATURES]
    return [
        StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=index_cols,
                      handleInvalid="keep", stringOrderType="frequencyDesc"),
        # the indexer's extra bucket covers unseen values; it is the slot that the
        # encoder drops
        OneHotEncoder(inputCols=index_cols, outputCols=vec_cols),
        VectorAssembler(inputCols=NUMERIC_FEATURES + vec_cols, outputCol="features"),
    ]


def logistic_pipeline(max_iter: int = 10, reg: float = 0.01, elastic_net: float = 0.8) -> Pipeline:
    lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net,
                            labelCol=LABEL, featuresCol="features")
    return Pipeline(stages=feature_stages() + [lr])


def forest_pipeline(seed: int = 42, num_trees: int = 20, max_depth: int = 5,
                    impurity: str = "gini") -> Pipeline:
    """Below ``WALKED_DEPTH`` MLlib keeps the node of every row and tree. Else each level
    would walk all rows down from the root again; the trees are the same."""
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", seed=seed, numTrees=num_trees,
                                maxDepth=max_depth, impurity=impurity, cacheNodeIds=max_depth > WALKED_DEPTH)
    return Pipeline(stages=feature_stages() + [rf])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(train)


def row_counts(train: DataFrame, *by: str) -> DataFrame:
    """Equal training rows (of one ``by``) as one, with their number ``n``."""
    return train.groupBy(*by, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL).agg(F.count(F.lit(1)).alias("n"))


def fit_logistic(train: DataFrame, *, max_iter: int = 500, reg: float = 0.01, elastic_net: float = 0.8,
                 tol: float = 1e-13) -> PipelineModel:
    """The model of ``logistic_pipeline`` at its optimum, from counts of equal rows.

    The penalty is on features over their standard deviation among all rows, as
    there. A weighted fit would work out another deviation, so a scaler fitted on
    the rows stands before it; ``coefficients`` undoes it."""
    features = Pipeline(stages=[*feature_stages(), StandardScaler(inputCol="features", outputCol="scaled")]).fit(train)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, tol=tol, labelCol=LABEL,
                            featuresCol="scaled", weightCol="n", standardization=False)
    return PipelineModel([*features.stages, lr.fit(features.transform(row_counts(train)))])


# --- area under the ROC curve ------------------------------------------------

SCORE_BINS = 4096


def score_counts(scored: DataFrame, by: tuple[str, ...] = (), score: str | Column = "probability",
                 n: str | None = None) -> DataFrame:
    """(by, score, positives, negatives): rows per distinct probability of label 1,
    from a vector of probabilities (its name) or a column. ``n``: the column that says
    how many rows a row stands for."""
    positive, rows = F.col(LABEL) > 0, F.col(n) if n else F.lit(1)
    value = vector_to_array(score)[1] if isinstance(score, str) else score
    return scored.groupBy(*by, value.alias("score")).agg(
        *[F.coalesce(F.sum(F.when(said, rows)).cast("long"), F.lit(0).cast("long")).alias(name)
          for said, name in ((positive, "positives"), (~positive, "negatives"))])


def roc_areas(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve per ``by`` from score counts: the share of
    (positive, negative) pairs in which the positive has the higher score, ties
    half. Negatives below a score are those of lower bins of the score range and
    those below it in its bin, so no window holds more than the bins or one bin's
    distinct scores. Null without rows of both labels."""
    bins = counts.withColumn("bin", F.floor(F.col("score") * SCORE_BINS).cast("int"))
    per_bin = bins.groupBy(*by, "bin").agg(F.sum("negatives").alias("negatives"))
    lower = F.sum("negatives").over(Window.partitionBy(*by).orderBy("bin")) - F.col("negatives")
    key = [F.col(c).alias(f"_{c}") for c in (*by, "bin")]
    per_bin = per_bin.select(*key, lower.alias("lower"))
    met = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "bin")]
    inside = F.sum("negatives").over(Window.partitionBy(*by, "bin").orderBy("score")) - F.col("negatives")
    placed = bins.withColumn("below", inside).join(per_bin, met)
    won = F.col("positives") * (F.col("lower") + F.col("below") + F.col("negatives") / 2)
    totals = (F.sum(won).alias("won"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    sums = placed.groupBy(*by).agg(*totals) if by else placed.agg(*totals)
    return sums.select(*by, F.coalesce(F.col("positives") + F.col("negatives"), F.lit(0)).alias("rows"),
                       F.expr("try_divide(try_divide(won, positives), negatives)").alias("auc"))


def area_under_roc(model: PipelineModel, test: DataFrame) -> float:
    return roc_areas(score_counts(model.transform(test))).first()["auc"]


def evaluation_table(model: PipelineModel, test: DataFrame, name: str) -> DataFrame:
    """One-row table (model, test_rows, auc), exact."""
    return roc_areas(score_counts(model.transform(test))).select(
        F.lit(name).alias("model"), F.col("rows").alias("test_rows"), "auc")


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Fitted logistic-regression weights by feature name, plus the intercept.
    Names come from the ML attribute metadata of the assembled vector (read
    from the schema of ``model.transform(df)``; no job runs)."""
    lr, scale = model.stages[-1], None
    for stage in model.stages:
        if isinstance(stage, StandardScalerModel):
            scale = stage.std.toArray().tolist()
    meta = model.transform(df.limit(0)).schema["features"].metadata
    attrs = meta.get("ml_attr", {}).get("attrs", {})
    names = dict(sorted((a["idx"], a["name"]) for group in attrs.values() for a in group))
    weights = lr.coefficients.toArray().tolist()
    if scale:
        weights = [w / s if s else 0.0 for w, s in zip(weights, scale)]
    rows = [(i, names.get(i, f"f{i}"), float(w)) for i, w in enumerate(weights)]
    rows.append((len(rows), "(intercept)", float(lr.intercept)))
    return df.sparkSession.createDataFrame(rows, "position int, feature string, coefficient double")


def feature_vectors(model: PipelineModel, df: DataFrame, key: str = KEY) -> DataFrame:
    """(key, features): the assembled vector as an array, after the fitted
    indexers and encoder."""
    stages = [s for s in model.stages if not hasattr(s, "predictionCol")]
    return PipelineModel(stages).transform(df).select(key, vector_to_array("features").alias("features"))


def tree(train: DataFrame, *, max_depth: int = 5, impurity: str = "gini", max_bins: int = 512) -> PipelineModel:
    """One tree over all rows and features: no bootstrap, no feature subsets. With
    at least as many bins as a feature has values every split is looked at; MLlib
    looks for the values in a sample of about ``max_bins`` squared rows."""
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", seed=0, numTrees=1, maxDepth=max_depth,
                                impurity=impurity, bootstrap=False, subsamplingRate=1.0,
                                featureSubsetStrategy="all", maxBins=max_bins)
    return Pipeline(stages=[*feature_stages(), rf]).fit(train)


def leaf_table(model: PipelineModel, rows: DataFrame, key: str = KEY) -> DataFrame:
    """Per row: ``key``, label and the probability of label 1 in the leaf it falls into."""
    return model.transform(rows).select(key, LABEL, vector_to_array("probability")[1].alias("probability"))


# --- grid search -------------------------------------------------------------

GRID = {"num_trees": (10, 20, 30), "max_depth": (5, 10, 15), "impurity": ("gini", "entropy")}


def grid(**values) -> list[dict]:
    """All combinations of the values, the last name changing fastest."""
    return [dict(zip(values, combination)) for combination in product(*values.values())]


def folded(train: DataFrame, folds: int = 3, seed: int = 42, key: str | None = None) -> DataFrame:
    """``train`` and ``fold``, which follows from a row's key, not from where it lies."""
    return train.withColumn("fold", F.pmod(F.xxhash64(row_key(train, key), F.lit(seed)), F.lit(folds)).cast("int"))


def cut_leaves(tree: np.ndarray, left: np.ndarray, right: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
    """Class shares of a forest cut at ``depth``, per leaf of the whole forest (trees
    one after the other, leaves from left to right).

    A node at that depth becomes a leaf, and as in MLlib leaves of one parent that
    predict the same class become one. Nodes are in preorder, with the places of
    their children or -1."""
    inner, nodes = left >= 0, np.arange(len(tree))
    levels = [np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]][:len(tree)])]
    while len(up := levels[-1][inner[levels[-1]]]):
        levels.append(np.r_[left[up], right[up]])
    says, leaf = counts.argmax(axis=1), ~inner
    for n, level in enumerate(levels[depth::-1]):
        if n == 0 and len(levels) > depth:
            leaf[level] = True
        up = level[~leaf[level]]
        same = leaf[left[up]] & leaf[right[up]] & (says[left[up]] == says[right[up]])
        says[up[same]], leaf[up[same]] = says[left[up[same]]], True
    at = nodes.copy()  # the leaf of the cut tree above a node, or the node
    for level in levels:
        up = level[inner[level]]
        ended = leaf[at[up]]
        for child in (left[up], right[up]):
            at[child] = np.where(ended, at[up], child)
    ends = counts[at[~inner]]
    return ends / np.maximum(ends.sum(axis=1, keepdims=True), 1e-300)


def forest_nodes(model: RandomForestClassificationModel) -> tuple[np.ndarray, ...]:
    """Tree, left and right child (places, -1 in leaves) and class counts of the
    nodes, from the saved form of the model."""
    spark = SparkSession.active()
    path = scratch_folder(spark, "forest")
    save(model, path)
    rows = (spark.read.parquet(f"{path}/data").select("treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild",
                                                       "nodeData.impurityStats").toArrow())
    delete_path(spark, path)
    tree, node, left, right = (rows.column(i).to_numpy().astype(np.int64) for i in range(4))
    order = np.lexsort((node, tree))
    counts = np.array(rows.column(4).combine_chunks().flatten()).reshape(len(tree), -1)[order]
    tree, left, right = tree[order], left[order], right[order]
    first = np.searchsorted(tree, tree)
    return tree, np.where(left < 0, -1, left + first), np.where(right < 0, -1, right + first), counts


def cut_forest_scores(scored: DataFrame, nodes: tuple[np.ndarray, ...], depth: int) -> DataFrame:
    """(label, n, probability) of counted rows with their ``leaves`` in a forest, when
    its trees are cut at ``depth``."""
    tree, left, _, _ = nodes
    shares, first = cut_leaves(*nodes, depth), np.r_[0, np.cumsum(np.bincount(tree[left < 0]))]
    sent = scored.sparkSession.sparkContext.broadcast((shares, first))

    def run(batches):
        shares, first = sent.value
        for batch in batches:
            leaves = batch.column(2).flatten().to_numpy().astype(np.int64).reshape(-1, len(first) - 1)
            votes = np.zeros((len(leaves), shares.shape[1]))
            for t in range(leaves.shape[1]):
                votes += shares[leaves[:, t] + first[t]]
            votes /= votes.sum(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(votes[:, 1])],
                                             names=[LABEL, "n", "probability"])
    kind = scored.schema[LABEL].dataType.simpleString()
    return scored.select(LABEL, "n", vector_to_array("leaves").alias("leaves")).mapInArrow(
        run, f"{LABEL} {kind}, n long, probability double")


def forest_bytes(rows: int, num_trees: int) -> int:
    """About what MLlib holds while a forest is fitted: binned rows, and a draw and the
    node before and after a level for each row and tree."""
    return rows * (250 + 12 * num_trees)


def storage_bytes(spark: SparkSession) -> int:
    """Memory for held rows on all executors. One of several block managers is the driver's."""
    kept, each = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), []
    while kept.hasNext():
        each.append(kept.next()._1())
    return sum(each) * (len(each) - 1 or 1) // len(each)


class Room:
    """Lets jobs in while what they hold together is within ``size``, or one alone."""

    def __init__(self, size: int):
        self.size = self.left = size
        self.change = Condition()

    @contextmanager
    def take(self, n: int):
        n = min(n, self.size)
        with self.change:
            self.change.wait_for(lambda: n <= self.left)
            self.left -= n
        try:
            yield
        finally:
            with self.change:
                self.left += n
                self.change.notify_all()


def out_of_fold_counts(train: DataFrame, candidates: list[dict], *, folds: int = 3, seed: int = 42,
                       parallelism: int = 1, key: str | None = None, keep=lambda df, name: df) -> DataFrame:
    """(candidate, fold, score, positives, negatives): every row scored by the
    forests that did not see its fold, as counts per distinct score. Features are
    indexed and assembled once. Candidates that differ in depth alone share one
    forest, grown to the greatest and cut for the others: with the same seed MLlib
    grows the same upper levels. Equal rows of a fold are scored once. ``keep`` gets each
    part of the table and a name for it, to write it where a lost executor should not
    fit its forest again.

    Of the ``parallelism`` forests only as many are fitted at once as four fifths of the
    memory for held rows take (``forest_bytes``), one at least: large ones keep the
    cluster busy alone, and several would push each other's rows to disk."""
    features, dealt = Pipeline(stages=feature_stages()).fit(train), folded(train, folds, seed, key)
    ready = keep(features.transform(dealt).select("features", LABEL, "fold"), "features")
    # in as many parts as the rows: each part reads the whole forest
    equal = (features.transform(row_counts(dealt, "fold")).select("features", LABEL, "fold", "n")
             .coalesce(max(1, ready.rdd.getNumPartitions())).persist())
    sizes = {r["fold"]: r["rows"] for r in equal.groupBy("fold").agg(F.sum("n").alias("rows")).collect()}
    room = Room(storage_bytes(train.sparkSession) * 4 // 5)
    shared: dict[tuple, dict[int, int]] = {}
    for number, how in enumerate(candidates):
        same = tuple(sorted((k, v) for k, v in how.items() if k != "max_depth"))
        shared.setdefault(same, {})[number] = how.get("max_depth", 5)

    def part(job):
        (how, depths), fold = job
        deepest = max(depths.values())
        rf = forest_pipeline(seed=seed, max_depth=deepest, **dict(how)).getStages()[-1]
        cut = min(depths.values()) < deepest
        others = sum(rows for of, rows in sizes.items() if of != fold)
        with room.take(forest_bytes(others, rf.getNumTrees())):
            model = (rf.setLeafCol("leaves") if cut else rf).fit(ready.where(F.col("fold") != fold))
        scored, nodes, out = model.transform(equal.where(F.col("fold") == fold)), forest_nodes(model) if cut else None, {}
        for number, depth in depths.items():
            counts = (score_counts(scored, n="n") if depth == deepest
                      else score_counts(cut_forest_scores(scored, nodes, depth), score=F.col("probability"), n="n"))
            counts = counts.select(F.lit(number).alias("candidate"), F.lit(fold).alias("fold"),
                                   "score", "positives", "negatives")
            out[number, fold] = keep(counts, f"scores-{number}-{fold}")
        return out

    # the forests with most trees first, so that none is left over at the end
    jobs = sorted(product(shared.items(), range(folds)), key=lambda job: -dict(job[0][0]).get("num_trees", 0))
    try:
        with ThreadPool(parallelism) as pool:
            parts = {k: v for made in pool.map(part, jobs, chunksize=1) for k, v in made.items()}
    finally:
        equal.unpersist()
    out, *others = (parts[k] for k in sorted(parts))
    for p in others:
        out = out.unionByName(p)
    return out


def fold_metrics(counts: DataFrame, candidates: list[dict]) -> DataFrame:
    """Out-of-fold counts -> (candidate, its values, fold, rows, auc)."""
    areas = roc_areas(counts, ("candidate", "fold"))
    names = list(candidates[0])
    table = areas.sparkSession.createDataFrame([(i, *c.values()) for i, c in enumerate(candidates)],
                                               ["candidate", *names])
    table = table.withColumn("candidate", F.col("candidate").cast("int"))
    return areas.join(F.broadcast(table), "candidate").select("candidate", *names, "fold", "rows", "auc")


def best_candidate(metrics: DataFrame) -> int:
    """The candidate with the highest mean AUC over its folds, the first of equals."""
    ranked = metrics.groupBy("candidate").agg(F.avg("auc").alias("auc")).orderBy(F.desc_nulls_last("auc"), "candidate")
    return ranked.first()["candidate"]


def cross_validate(train: DataFrame, *, num_trees=GRID["num_trees"], max_depth=GRID["max_depth"],
                   impurity=GRID["impurity"], folds: int = 3, seed: int = 42, parallelism: int = 1,
                   key: str | None = None, keep=lambda df, name: df) -> PipelineModel:
    """Grid search over forest parameters with k-fold cross-validation (by default
    the reference's 3 x 3 x 2 grid), refitted on all rows with the best values."""
    candidates = grid(num_trees=num_trees, max_depth=max_depth, impurity=impurity)
    counts = out_of_fold_counts(train, candidates, folds=folds, seed=seed, parallelism=parallelism, key=key, keep=keep)
    best = candidates[best_candidate(fold_metrics(counts, candidates))]
    return fit(forest_pipeline(seed=seed, **best), train)


def score(model: PipelineModel, sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """All input columns + model outputs + purchase_probability (percent, 2
    decimals) and predicted_purchase, most likely buyers first, ties by key. Scoring
    alone is a map; ``ordered=False`` leaves the global sort out."""
    out = model.transform(sessions).select(
        "*", F.round(vector_to_array("probability")[1] * 100, 2).alias("purchase_probability"),
        F.col("prediction").alias("predicted_purchase"))
    return out.orderBy(F.desc("purchase_probability"), row_key(sessions)) if ordered else out


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
