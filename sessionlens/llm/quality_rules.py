"""Quality rules: fixed base rules and an isolation forest on rule statistics.

Each whole text gives a few statistics. A document fails the base rules when
it has under ``MIN_WORDS`` words or over ``MAX_REPEAT`` percent of its words
lie in repeated five-word windows. The others are judged by an isolation
forest: random splits of small samples isolate unusual statistics after few
steps, so short mean path lengths mean anomalous documents. The trees split on how
far the length in words, the mean word length and the shares of symbols, repeated
lines and repeated words lie beyond what labelled good documents show: their
quantile of ``1 - MAX_LOSS``. The usual lengths, these quantiles and the
threshold on the score are exact over all rows: nothing of them is sampled. Each tree
grows on ``SUBSAMPLE`` rows, as the method has it, drawn from about ``MAX_SAMPLE``
rows by a hash of the id (grown on all rows, a forest ranks labelled low-quality
rows worse than a single rate does). The threshold is calibrated on all labelled rows
that pass the base rules: the best balance of caught low-quality rows and spared good ones with
at most ``MAX_LOSS`` of the good ones lost.

Cases: a null or empty text has no words and fails; a very long one is judged by
its whole text like any other. Without labelled rows of both qualities the forest
rejects nothing. When an id has several labels the
smallest counts. Repeated rows are judged each; a row with a null id is
judged and has no label. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.quantiles import quantiles

from .common import Scratch, map_arrow, per_text

MIN_WORDS = 10
MAX_REPEAT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

TREES = 200
SUBSAMPLE = 64
MAX_SAMPLE = 20_000
MAX_LOSS = 0.005
STEPS = 1000  # calibration works on scores in steps of 1 / STEPS

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, tokens), np.int64, len(tokens)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    # equal hashes are only candidates: count the windows themselves
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(twice).tolist():
        seen.setdefault(tuple(tokens[i:i + window]), []).append(i)
    covered = np.zeros(len(tokens) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            covered[places] += 1
            covered[np.array(places) + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = text or ""
    tokens = text.encode().split()  # bytes.split cuts at 0x20 and 0x09-0x0D
    lines = [s for s in text.split("\n") if s.strip(SPACES)]
    return (len(tokens), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(tokens), len(lines))


def measure(docs: DataFrame, *, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus the statistics of every whole text."""
    def kernel():
        return lambda texts: [np.array(c, np.int64) for c in zip(*map(statistics, texts))] or [[]] * 6
    return per_text(docs, kernel, [(c, "long") for c in [*STATISTICS, "n_lines"]], keep=keep)


# --- isolation forest --------------------------------------------------------

def rates(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) -> np.ndarray:
    """Logarithm of the words, mean word length, symbols a word, shares of repeated
    lines and words."""
    n, lines = np.maximum(1, n_words), np.maximum(1, n_lines)
    return np.stack([np.log1p(n_words), word_chars / n, n_symbols / n, n_dup_lines / lines, n_repeat_words / n],
                    axis=1).astype(float)


def deviations(rate: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Distance of the lengths from the usual ones, and the other rates."""
    out = rate.copy()
    out[:, :2] = np.abs(rate[:, :2] - usual)
    return out


def expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    h = np.log(m - 1) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees in arrays: leaves have feature -1 and carry the path length."""
    feature: list[np.ndarray]
    split: list[np.ndarray]
    child: list[np.ndarray]   # left child; the right one follows
    length: list[np.ndarray]
    scale: float
    usual: np.ndarray | None = None      # median lengths
    tolerance: np.ndarray | None = None  # of each deviation

    def judge(self, *statistics) -> np.ndarray:
        return self.score(np.maximum(0, deviations(rates(*statistics), self.usual) - self.tolerance))

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher for rows that few splits isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, child, length in zip(self.feature, self.split, self.child, self.length):
            at = np.zeros(len(x), np.int64)
            live = rows
            while len(live):
                live = live[feature[at[live]] >= 0]
                node = at[live]
                at[live] = child[node] + (x[live, feature[node]] >= split[node])
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.scale) if self.feature else total


def grow(x: np.ndarray, *, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 0) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    if size < 2:
        return Forest([], [], [], [], 1.0)
    deepest = math.ceil(math.log2(size))
    out = Forest([], [], [], [], float(expected_path(size)))
    for _ in range(trees):
        feature, split, child, length = [-1], [0.0], [0], [0.0]
        todo = [(0, x[rng.choice(len(x), size, replace=False)], 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            uneven = np.flatnonzero(high > low)
            if depth >= deepest or len(rows) < 2 or not len(uneven):
                length[node] = depth + float(expected_path(len(rows)))
                continue
            f = int(rng.choice(uneven))
            cut = rng.uniform(low[f], high[f])
            right = rows[:, f] >= cut
            feature[node], split[node], child[node] = f, cut, len(feature)
            for side in (~right, right):
                todo.append((len(feature), rows[side], depth + 1))
                feature.append(-1), split.append(0.0), child.append(0), length.append(0.0)
        for made, got in zip((out.feature, out.split, out.child, out.length), (feature, split, child, length)):
            made.append(np.array(got))
    return out


def tuned(sample: np.ndarray, usual: np.ndarray, tolerance: np.ndarray) -> Forest:
    """Forest over what rows of the statistics have beyond the tolerances."""
    forest = grow(np.maximum(0, deviations(rates(*sample.T), usual) - tolerance))
    forest.usual, forest.tolerance = usual, tolerance
    return forest


def fit(sample: np.ndarray, good: np.ndarray, max_loss: float = MAX_LOSS) -> Forest:
    """Forest over rows of the statistics in memory; ``good``: rows whose variety is no
    fault (all of the sample where there are none). ``fit_table`` is for tables."""
    rate = rates(*sample.T)
    usual = np.median(rate[:, :2], axis=0) if len(rate) else np.zeros(2)
    known = deviations(rates(*(good if len(good) else sample).T), usual)
    tolerance = np.quantile(known, 1 - max_loss, axis=0) if len(known) else np.zeros(5)
    return tuned(sample, usual, tolerance)


def base_failed():
    """Column: the text fails the fixed rules."""
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


def scored(measured: DataFrame, forest: Forest) -> DataFrame:
    """Measured rows plus ``anomaly``, the forest's score."""
    names = [*STATISTICS, "n_lines"]
    at = [measured.columns.index(c) for c in names]
    sent = measured.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            made = sent.value.judge(*(batch.column(i).to_numpy() for i in at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())],
                                             names=[*batch.schema.names, "anomaly"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in measured.schema.fields)
    return map_arrow(measured, run, f"{types}, anomaly double")


def threshold(counts: list[tuple[int, int, int]], max_loss: float = MAX_LOSS) -> float:
    """From (score step, good rows, low-quality rows): the lowest score to reject."""
    good, bad = sum(c[1] for c in counts), sum(c[2] for c in counts)
    best, cut, lost, caught = 0.0, math.inf, 0, 0
    if not good or not bad:
        return cut
    for step, g, b in sorted(counts, reverse=True):
        lost, caught = lost + g, caught + b
        if lost > max_loss * good:
            break
        if caught / bad - lost / good > best:
            best, cut = caught / bad - lost / good, step / STEPS
    return cut


def _rows(measured: DataFrame, max_sample: int) -> np.ndarray:
    """About ``max_sample`` rows of the statistics by a hash of the id, twice as many at most."""
    share = min(1.0, max_sample / max(1, measured.count()))
    rank = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    names = [*STATISTICS, "n_lines"]
    rows = measured.where(rank < share).orderBy("doc_id", *names).limit(2 * max_sample).collect()
    return np.array([[r[c] for c in names] for r in rows], float).reshape(-1, len(names))


RATES = [f"rate{i}" for i in range(5)]


def per_rates(measured: DataFrame, made: Callable = lambda rate: rate) -> DataFrame:
    """``made(rates)`` of measured rows, as columns ``RATES``."""
    def run(batches):
        for batch in batches:
            rate = made(rates(*(c.to_numpy() for c in batch.columns)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rate.T.copy()], names=RATES)
    return map_arrow(measured.select(*STATISTICS, "n_lines"), run, ", ".join(f"{c} double" for c in RATES))


def exact_cuts(rows: DataFrame, columns: list[str], p: float) -> np.ndarray | None:
    """The ``p`` quantile of each column over all rows, between two neighbours as numpy
    has it (over half a million rows these may be one rank off); None without rows."""
    n = rows.count()
    if not n:
        return None
    place = (n - 1) * p
    k, part = int(place), place - int(place)
    near = [(k + 0.5) / n, min(n, k + 1.5) / n]  # the quantile q is the value of rank ceil(q * n)
    low, high = np.array(quantiles(rows, columns, near, exact=True).first()).T
    return high - (high - low) * (1 - part) if part >= 0.5 else low + (high - low) * part


def tolerances(measured: DataFrame, good: DataFrame, max_loss: float = MAX_LOSS) -> tuple[np.ndarray, np.ndarray]:
    """Median lengths of all rows, and the quantile of each deviation over all good rows
    (all rows where there are none)."""
    usual = exact_cuts(per_rates(measured), RATES[:2], 0.5)
    if usual is None:
        return np.zeros(2), np.zeros(5)
    far = lambda rows: exact_cuts(per_rates(rows, lambda rate: deviations(rate, usual)), RATES, 1 - max_loss)
    tolerance = far(good)
    return usual, far(measured) if tolerance is None else tolerance


def fit_table(measured: DataFrame, good: DataFrame, max_sample: int = MAX_SAMPLE) -> Forest:
    return tuned(_rows(measured, max_sample), *tolerances(measured, good))


def judge(docs: DataFrame, labels: DataFrame, *, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """Per document: doc_id, the statistics, base_failed, kept, anomaly."""
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.write(measure(docs.select("doc_id", "text")), "measured")
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    good = scratch.write(measured.where(~base_failed()).join(known.where("quality > 0").select("doc_id"), "doc_id"), "good")
    forest = fit_table(measured, good, max_sample)
    scratch.drop("good")
    judged = scratch.write(scored(measured, forest), "scored")
    scratch.drop("measured")
    step = F.floor(F.col("anomaly") * STEPS).cast("int")
    counts = (judged.where(~base_failed()).join(known, "doc_id").groupBy(step.alias("step"))
              .agg(F.sum((F.col("quality") > 0).cast("int")), F.sum((F.col("quality") <= 0).cast("int")))
              .collect())  # one row per score step
    cut = threshold([tuple(r) for r in counts])
    return judged.select("doc_id", *STATISTICS, base_failed().alias("base_failed"),
                         (~base_failed() & (F.col("anomaly") < F.lit(cut))).alias("kept"), "anomaly")
