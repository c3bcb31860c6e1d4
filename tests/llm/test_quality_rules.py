import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionlens.llm import quality_rules as R

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow(text):
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    marked = {k for i, x in enumerate(windows) if n[x] > 1 for k in range(i, i + 5)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(marked), len(lines))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab# \n\t\x0b\x1c\x85\xa0é|", max_size=200))
def test_statistics(text):
    assert R.statistics(text) == slow(text)


def test_repeats_and_long_texts():
    text = "a b c d e f " * 3 + "x\n" * 5 + "é " * 100_000
    assert R.statistics(text) == slow(text)
    assert R.statistics(None) == (0, 0, 0, 0, 0, 0)


def test_forest_paths_against_recursion():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(300, 3)), [[9, 9, 9]]])
    forest = R.grow(x, trees=20, subsample=64, seed=2)

    def path(t, row):
        at = 0
        while forest.feature[t][at] >= 0:
            at = forest.child[t][at] + (row[forest.feature[t][at]] >= forest.split[t][at])
        return forest.length[t][at]
    mean = [np.mean([path(t, row) for t in range(20)]) for row in x]
    assert np.allclose(forest.score(x), 2.0 ** (-np.array(mean) / forest.scale))
    assert forest.score(x).argmax() == 300


def test_threshold():
    assert R.threshold([(500, 1000, 0), (600, 2, 5), (700, 0, 50)]) == pytest.approx(0.6)
    assert R.threshold([(500, 1000, 10), (600, 100, 50), (700, 0, 5)]) == pytest.approx(0.7)
    assert R.threshold([]) == R.threshold([(500, 9, 0)]) == float("inf")


def test_labelled_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = R.judge(docs, labels).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count()
    n = {(r.quality, r.kept): r["count"] for r in got.collect()}
    assert n.get((1, False), 0) <= R.MAX_LOSS * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] > 0.9 * (n[0, False] + n.get((0, True), 0))


def test_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = R.judge(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].base_failed and by[2].base_failed and not by[1].kept and by[4].base_failed
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert R.judge(empty_docs, labels).collect() == []


def _ahead(score, low):
    """Area under the ROC curve: low-quality rows should score higher."""
    low_scores, good_scores = np.sort(score[low]), np.sort(score[~low])
    below = np.searchsorted(good_scores, low_scores, "left") + np.searchsorted(good_scores, low_scores, "right")
    return below.mean() / 2 / len(good_scores)


def test_forest_beats_every_single_rate_on_held_out_rows(spark):
    """Tolerances and forest from labelled rows of even id, judged on odd ones."""
    d = "/root/testdata/sf0.1"
    rows = (R.measure(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"))
            .join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "doc_id", "left")
            .where(~R.base_failed()).orderBy("doc_id").collect())
    x = np.array([[r[c] for c in [*R.STATISTICS, "n_lines"]] for r in rows], float)
    low, known = np.array([r.quality == 0 for r in rows]), np.array([r.quality is not None for r in rows])
    even = np.array([r.doc_id % 2 == 0 for r in rows])
    forest = R.fit(x, x[known & ~low & even])
    held = known & ~even
    score = forest.judge(*x[held].T)
    single = [_ahead(v, low[held]) for v in R.deviations(R.rates(*x[held].T), forest.usual).T]
    assert _ahead(score, low[held]) > max(single) > 0.9
    cut = np.sort(score[~low[held]])[::-1][int(R.MAX_LOSS * (~low[held]).sum())]
    caught, lost = (score[low[held]] > cut).mean(), (score[~low[held]] > cut).mean()
    assert caught > 0.95 and lost <= R.MAX_LOSS


def test_lengths_and_tolerances_come_from_all_rows(spark):
    """Over more rows than are drawn for the trees, against quantiles of them all."""
    rng = np.random.default_rng(3)
    x = np.c_[rng.integers(20, 4000, 45_001), rng.integers(100, 30_000, 45_001), rng.integers(0, 50, 45_001),
              rng.integers(0, 9, 45_001), rng.integers(0, 300, 45_001), rng.integers(9, 20, 45_001)]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(x.tolist())], ["doc_id", *R.STATISTICS, "n_lines"])
    forest = R.fit_table(rows.repartition(5), rows.where("doc_id % 2 = 0"), 500)
    rate = R.rates(*x.astype(float).T)
    usual = np.quantile(rate[:, :2], 0.5, axis=0)
    assert np.allclose(forest.usual, usual, rtol=1e-12)
    known = R.deviations(rate[::2], usual)
    assert np.allclose(forest.tolerance, np.quantile(known, 1 - R.MAX_LOSS, axis=0), rtol=1e-12)
    few = R.fit_table(rows.where("doc_id < 800"), rows.where("doc_id < 300"))
    same = R.fit(x[:800].astype(float), x[:300].astype(float))
    assert (few.usual == same.usual).all() and (few.tolerance == same.tolerance).all()
    none = R.tolerances(rows.limit(0), rows.limit(0))
    assert not none[0].any() and not none[1].any()
