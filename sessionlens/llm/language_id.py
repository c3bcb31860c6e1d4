"""Language ID by string kernels.

The kernel of two texts is the number of character n-grams (1 to 3, the
blended spectrum) that both have, over the square root of the product of
their numbers of distinct n-grams. Letters of every script are lower-cased and
stand for themselves; everything else is one separator. N-grams are hashed to
``1 << BITS`` codes. Nyström landmarks - whole texts of the training sample -
stand for the full kernel, and a one-versus-rest kernel ridge regression on
them gives one column of coefficients per language. A batch of texts is
scored by two matrix products: presence rows times landmark rows, and the
normalised kernel values times the coefficients.

The model is fitted on a bounded sample: at most ``MAX_TRAIN`` different texts
and ``MAX_BYTES`` of n-gram codes in all (or one text per language), spread evenly
over the languages by a hash of id and text. Every document is scored by its
whole text.

Cases: a null text, or one without a letter, is ``und`` with score 0, as is
every text when no row can be learned from. Rows with a null language, text
or id are not learned from. Ties go to the first language by name. Repeated
rows are scored each; empty tables give no rows; extra columns are ignored.
A row with a null id counts as not held out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, id_crc, per_text, within_bytes

MAX_TRAIN = 2_000     # documents the ridge is fitted on, at most
MAX_BYTES = 64 << 20  # of their n-gram codes
MAX_LANDMARKS = 160   # of them, Nyström landmarks
BITS = 18             # of an n-gram's code
RIDGE = 1e-3
BLOCK = 1 << 20       # characters taken at once from one long text
SCORED_AT_ONCE = 128
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_SECOND, _THIRD, _SPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def grams(text: str, bits: int = BITS) -> np.ndarray:
    """Codes of all 1- to 3-grams of the text, repeats included."""
    symbols, shift = letters(), np.uint64(64 - bits)
    parts, last = [], np.zeros(0, np.uint64)
    for start in range(0, len(text), BLOCK):
        block = text[start:start + BLOCK].lower()
        s = symbols[np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4")]
        s = np.concatenate([last, s])
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)   # runs of separators are one
        s = s[keep]
        pair = s[:-1] * _SECOND + s[1:]
        triple = pair[:-1] * _THIRD + s[2:]
        parts += [((x + np.uint64(n)) * _SPREAD >> shift).astype(np.int32) for n, x in enumerate((s, pair, triple))]
        last = s[-2:]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """A number per code point: 0 where it is no letter, else one of its own,
    spread over 64 bits."""
    is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    x = np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return np.where(is_letter, x * np.uint64(0xFF51AFD7ED558CCD) | np.uint64(1), np.uint64(0))


@dataclass
class Model:
    languages: list[str]
    vocabulary: np.ndarray    # codes of the landmarks' n-grams, ascending
    landmarks: np.ndarray     # presence, vocabulary x landmarks
    sizes: np.ndarray         # distinct n-grams of each landmark
    coefficients: np.ndarray  # landmarks x languages
    bits: int = BITS


class Scorer:
    """Kernel rows of texts against the landmarks, by batched matrix products."""

    def __init__(self, vocabulary, landmarks, sizes, bits=BITS):
        self.bits = bits
        self.column = np.full(1 << bits, len(vocabulary), np.int32)
        self.column[vocabulary] = np.arange(len(vocabulary))
        self.landmarks = landmarks.astype(np.float32)
        self.sizes = sizes

    def kernel(self, texts: list[str]) -> np.ndarray:
        n = len(self.landmarks)
        x = np.zeros((len(texts), n + 1), np.float32)
        size = np.ones(len(texts))
        seen = np.zeros(1 << self.bits, bool)
        for k, text in enumerate(texts):
            codes = grams(text, self.bits)
            seen[codes] = True
            size[k] = max(1, np.count_nonzero(seen))
            seen[codes] = False
            x[k, self.column[codes]] = 1
        return (x[:, :n] @ self.landmarks) / np.sqrt(size[:, None] * self.sizes[None, :])


def ridge(k_xz: np.ndarray, k_zz: np.ndarray, y: np.ndarray, strength: float = RIDGE) -> np.ndarray:
    """Nyström kernel ridge regression, one column per language."""
    left = k_xz.T @ k_xz + strength * len(k_xz) * (k_zz + 1e-6 * np.eye(len(k_zz)))
    return np.linalg.solve(left, k_xz.T @ y)


def _sample(docs: DataFrame, fold: Column, max_train: int) -> DataFrame:
    """At most ``max_train`` different texts (or one per language), as many of
    each language where there are so many, chosen by a hash of id and text."""
    known = docs.where(fold & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                       & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return known.withColumn("rank", F.lit(0.0)).limit(0)
    each = max(1, max_train // len(counts))
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, 1.5 * each / row["count"]))).otherwise(share)
    rank = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = known.withColumn("rank", rank).where(F.col("rank") < share)
    texts = drawn.groupBy("lang", "text").agg(F.min("rank").alias("rank"), F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("lang").orderBy("rank", "doc_id", "text")
    return texts.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each).drop("nth")


def fit(docs: DataFrame, *, fold: Column | None = None, max_train: int = MAX_TRAIN,
        max_landmarks: int = MAX_LANDMARKS, max_bytes: int = MAX_BYTES) -> Model | None:
    """Model of ``lang`` from rows that pass ``fold``; None with nothing to learn."""
    scratch = Scratch(docs.sparkSession, "language-id")
    sample = _sample(docs.select("doc_id", "text", "lang"), F.lit(True) if fold is None else fold, max_train)

    def kernel():
        return lambda texts: [[np.unique(grams(t)).astype("<i4").tobytes() if _LETTER.search(t) else b""
                               for t in texts]]

    rows = scratch.write(per_text(sample, kernel, [("grams", "binary")], keep=("rank", "doc_id", "lang")), "sample")
    names = max(1, rows.select("lang").distinct().count())
    rows = within_bytes(rows.where(F.octet_length("grams") > 0), "grams", ["lang"], ["rank", "doc_id", "grams"],
                        max_bytes // names).collect()
    scratch.drop()
    rows.sort(key=lambda r: (r["rank"], r["doc_id"], r["lang"], bytes(r["grams"])))
    return fit_rows([(r["lang"], np.frombuffer(r["grams"], "<i4")) for r in rows], max_landmarks)


def fit_rows(rows: list[tuple[str, np.ndarray]], max_landmarks: int, bits: int = BITS) -> Model | None:
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    each = max(1, max_landmarks // len(languages))
    chosen = [g for name in languages for g in [g for lang, g in rows if lang == name][:each]]
    vocabulary = np.unique(np.concatenate(chosen))
    column = np.full(1 << bits, len(vocabulary), np.int32)
    column[vocabulary] = np.arange(len(vocabulary))

    def presence(sets):
        out = np.zeros((len(sets), len(vocabulary) + 1), np.float32)
        for k, g in enumerate(sets):
            out[k, column[g]] = 1
        return out[:, :-1]

    z = presence(chosen)
    sizes = np.array([len(g) for g in chosen], float)
    blocks = [presence([g for _, g in rows[i:i + 256]]) @ z.T for i in range(0, len(rows), 256)]
    k_xz = np.concatenate(blocks) / np.sqrt(np.array([len(g) for _, g in rows])[:, None] * sizes)
    k_zz = (z @ z.T) / np.sqrt(sizes[:, None] * sizes)
    y = np.array([[1.0 if lang == name else -1.0 for name in languages] for lang, _ in rows])
    return Model(languages, vocabulary, z.T.copy(), sizes,
                 ridge(k_xz.astype(float), k_zz.astype(float), y), bits)


def predict(docs: DataFrame, model: Model | None, *, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` (0 to 1) per text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        m = sent.value
        scorer = Scorer(m.vocabulary, m.landmarks, m.sizes, m.bits) if m else None

        def apply(texts):
            names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [k for k, t in enumerate(texts) if m and t and _LETTER.search(t)]
            for i in range(0, len(known), SCORED_AT_ONCE):
                some = known[i:i + SCORED_AT_ONCE]
                s = scorer.kernel([texts[k] for k in some]) @ m.coefficients
                best = s.argmax(axis=1)
                for k, j, value in zip(some, best, s.max(axis=1)):
                    names[k] = m.languages[j]
                    score[k] = round(float(np.clip((value + 1) / 2, 0, 1)), 6)
            return [names, score]
        return apply

    return per_text(docs, kernel, [("lang_pred", "string"), ("score", "double")], keep=keep)


def learned_fold() -> Column:
    """Rows that may be learned from: crc32 of the id as text mod 3 is not 1."""
    return id_crc() % 3 != 1


def held_out() -> Column:
    return F.coalesce(id_crc() % 3 == 1, F.lit(False))
