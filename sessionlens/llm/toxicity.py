"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

A text's features are the hashed presence of its words, word pairs and
one-word skip pairs. The model is fitted on a bounded sample of labelled rows
(``MAX_TRAIN`` ids, half per class, chosen by a hash of the id, one text each, and
``MAX_BYTES`` of features) with
per-coordinate learning rates and L1 sparsity; the few nonzero weights are
sent to the tasks, which score every whole text.

Cases: a null or empty text has no features and gets the score of the bias.
Labelled rows with a null label or id are not learned from; when an id has
several labels the largest counts, when it has several texts the one with the
smallest digest is learned from; repeated rows are scored each. A row with
a null id is scored and not held out. With no labelled rows (or one class)
the model is the smoothed share of label 1. Empty tables give no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc, map_arrow, per_text, within_bytes

MAX_TRAIN = 6_000       # documents the model is fitted on, at most
MAX_BYTES = 64 << 20    # of their features
BITS = 20               # hashed feature space
EPOCHS = 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.1

_SPACES = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def words(text: str) -> list[bytes]:
    """Lower-cased words, cut at white space and ASCII punctuation."""
    return text.lower().encode().translate(_SPACES).split()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed features, repeats included: words, pairs, pairs around one word."""
    tokens = words(text or "")
    h = np.fromiter(map(crc32, tokens), np.uint32, len(tokens)).astype(np.uint64)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    skip = h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9)
    mixed = np.concatenate([h * np.uint64(0xFF51AFD7ED558CCD), pair * np.uint64(0xFF51AFD7ED558CCD),
                            skip * np.uint64(0xFF51AFD7ED558CCD)])
    return (mixed >> np.uint64(64 - bits)).astype(np.uint32)


@dataclass
class Model:
    """Nonzero weights by feature, and the bias."""
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.weight
        return out


def ftrl(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS,
         seed: int = 0) -> Model:
    """FTRL-proximal over sparse binary rows; the last coordinate is the bias."""
    d = (1 << bits) + 1
    z, n = np.zeros(d), np.zeros(d)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(0, np.uint32), np.zeros(0, np.float32),
                     float(np.log(share / (1 - share))), bits)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        return w

    order = np.random.default_rng(seed)
    rows = [np.append(r, d - 1).astype(np.int64) for r in rows]
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(d))
    index = np.flatnonzero(w[:-1]).astype(np.uint32)
    return Model(index, w[index].astype(np.float32), float(w[-1]), bits)


def training_rows(docs: DataFrame, labels: DataFrame, fold: Column, max_train: int) -> DataFrame:
    """At most ``max_train`` labelled ids (half per class, by hash), each with a text."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & fold)
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label")))
    by_hash = known.withColumn("rank", F.xxhash64("doc_id", F.lit("toxicity")))
    half = max_train // 2
    chosen = [by_hash.where(F.col("label") == y).orderBy("rank", "doc_id").limit(half) for y in (0, 1)]
    found = docs.select("doc_id", "text").join(
        chosen[0].unionByName(chosen[1]).select("doc_id", "label", "rank"), "doc_id")
    return found.groupBy("doc_id", "label", "rank").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, *, fold: Column | None = None,
        max_train: int = MAX_TRAIN, max_bytes: int = MAX_BYTES, bits: int = BITS) -> Model:
    """Model of ``labels.toxic`` from documents whose id passes ``fold``."""
    rows = training_rows(docs, labels, F.lit(True) if fold is None else fold, max_train)

    def kernel():
        return lambda texts: [[np.unique(features(t, bits)).astype("<u4").tobytes() for t in texts]]

    found = per_text(rows, kernel, [("features", "binary")], keep=("doc_id", "label", "rank"))
    got = within_bytes(found, "features", ["label"], ["rank", "doc_id"], max_bytes // 2).collect()
    got.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["features"])))
    x = [np.frombuffer(r["features"], "<u4") for r in got]
    return ftrl(x, np.array([r["label"] for r in got], float), bits)


def scores(texts: list, dense: np.ndarray, bias: float, bits: int) -> np.ndarray:
    """Probabilities. Only features with a weight are counted once each."""
    out = np.empty(len(texts))
    for k, text in enumerate(texts):
        i = features(text, bits)
        i = np.unique(i[dense[i] != 0])
        out[k] = bias + dense[i].astype(np.float64).sum()
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def score(docs: DataFrame, model: Model, *, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        m = sent.value
        dense = m.dense()

        def apply(texts):
            p = scores(texts, dense, m.bias, m.bits)
            return [p, (p >= 0.5).astype(np.int32)]
        return apply

    return per_text(docs, kernel, [("score", "double"), ("predicted", "int")], keep=keep)


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows whose text scores under 0.5, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        m = sent.value
        dense = m.dense()
        for batch in batches:
            p = scores(batch.column(at).to_pylist(), dense, m.bias, m.bits)
            yield batch.filter(pa.array(p < 0.5))

    return map_arrow(docs, run, docs.schema)


def learned_fold() -> Column:
    """Rows that may be learned from: crc32 of the id as text mod 5 is not 0."""
    return id_crc() % 5 != 0


def held_out() -> Column:
    return F.coalesce(id_crc() % 5 == 0, F.lit(False))
