"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and cut at white space and ASCII punctuation. A document
and a benchmark item meet when they share a seed, ``SEED`` words in a row, or all
words of an item that has fewer. For
such a pair the longest common run of unmarked words is found by running
Karp-Rabin hashes (every equal hash is checked word by word), all its
non-overlapping matches are marked, and this is repeated with shorter runs
down to ``TILE`` words. The share of the item's words under tiles is its
coverage; from ``COVERAGE`` on the document holds the item, in whatever order
its parts appear.

All documents stream once past a bitmap of the benchmark's seeds (``MAX_BITS``, so at
most 16 MB, whatever the benchmark holds); those without a bit set are done. The
others meet the items by joins on the seeds themselves, and each pair is tiled
where document and item come together, one item after the other. Nothing of the
benchmark but that bitmap and the lengths of its seeds passes the driver. Pairs in
which too few of the item's words occur in the document at all are not tiled.

Cases: null or empty texts hold nothing; items without words (null ones
included) never match, items of a few words match where these words stand in a
row. Equal items and repeated documents are each reported. A null id is carried along. Empty tables give no
rows. Extra columns are ignored. Whole texts are read, whatever their length.
"""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import ROWS_PER_SLICE, Scratch, free_name, map_arrow
from .toxicity import words

SEED = 5
TILE = 3
COVERAGE = 0.8
MAX_BITS = 27  # of the numbers that seeds have in the bitmap

_B = 0x9E3779B97F4A7C15 | 1
_B_INVERSE = pow(_B, -1, 1 << 64)
_SPREAD = 0xFF51AFD7ED558CCD


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class KarpRabin:
    """Hashes of every window of a word sequence, for any window length."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        # spread the small word numbers before they are weighted
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(_B, n), dtype=np.uint64)])
        self.scale = _powers(_B_INVERSE, n)

    def windows(self, s: int) -> np.ndarray:
        return (self.sums[s:] - self.sums[:-s]) * self.scale[:len(self.sums) - s]


def _free(marked: np.ndarray, s: int) -> np.ndarray:
    """Whether each window of ``s`` holds no marked word."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return total[s:] == total[:-s]


def _matches(doc, doc_hash, doc_marked, item, item_hash, item_marked, s) -> list[tuple[int, int]]:
    if s > len(item) or s > len(doc):
        return []
    hi, hd = item_hash.windows(s), doc_hash.windows(s)
    starts: dict[int, list[int]] = {}
    for p in np.flatnonzero(_free(item_marked, s)):
        starts.setdefault(int(hi[p]), []).append(int(p))
    at = np.flatnonzero(_free(doc_marked, s))
    at = at[np.isin(hd[at], np.array(list(starts), np.uint64))]
    return [(int(a), p) for a in at for p in starts[int(hd[a])]
            if np.array_equal(doc[a:a + s], item[p:p + s])]


def tiles(doc: np.ndarray, item: np.ndarray, shortest: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length). Word numbers
    under 0 match nothing. Longest first; ties by place in doc, then in item."""
    doc_hash, item_hash = KarpRabin(doc), KarpRabin(item)
    doc_marked, item_marked = doc < 0, item < 0
    out: list[tuple[int, int, int]] = []
    longest = min(len(doc), len(item))
    while longest >= shortest:
        # the longest length with a match: matches of s contain matches of s - 1
        low, high, found = shortest, longest, []
        while low <= high:
            s = (low + high) // 2
            got = _matches(doc, doc_hash, doc_marked, item, item_hash, item_marked, s)
            if got:
                found, best, low = got, s, s + 1
            else:
                high = s - 1
        if not found:
            break
        for a, p in found:
            if not doc_marked[a:a + best].any() and not item_marked[p:p + best].any():
                doc_marked[a:a + best] = item_marked[p:p + best] = True
                out.append((a, p, best))
        longest = best
    return out


def held(doc: list[bytes], item: list[bytes], coverage: float, shortest: int = TILE):
    """Coverage and tiles of an item that a document holds, else None."""
    known = set(doc)
    # no tile covers a word that the document does not have
    if not item or sum(w in known for w in item) < coverage * len(item):
        return None
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in item], np.int64)
    place = np.fromiter(map(number.get, doc, repeat(-1)), np.int64, len(doc))
    got = tiles(place, ids, min(shortest, len(item)))
    share = sum(n for _, _, n in got) / len(item)
    return (share, got) if share >= coverage else None


# --- seeds -------------------------------------------------------------------

def seeds(tokens: list[bytes], lengths) -> np.ndarray:
    """Hashes of all runs of words of the given lengths, each once. Equal runs have
    equal hashes; whether others do too shows when they are tiled."""
    ids = np.fromiter(map(crc32, tokens), np.int64, len(tokens))
    hashes = KarpRabin(ids) if len(ids) else None
    made = [(hashes.windows(n) ^ np.uint64(n)) * np.uint64(_SPREAD) for n in lengths if n <= len(ids)]
    return np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64), pa.int64()))


def indexed(benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """(item, item_id, text, length, seeds) of the items that have words; length is
    that of their seeds."""
    def run(batches):
        for batch in batches:
            tokens = [words(t or "") for t in batch.column("text").to_pylist()]
            lengths = [min(SEED, len(t)) for t in tokens]
            made = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths, pa.int32()), _lists([seeds(t, (n,)) if n else np.zeros(0, np.uint64)
                                                                        for t, n in zip(tokens, lengths)])],
                names=["item_id", "text", "length", "seeds"])
            yield made.filter(pa.array(np.array(lengths, int) > 0))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = map_arrow(benchmark.select("item_id", "text"), run, f"item_id {kind}, text string, length int, seeds array<long>")
    return scratch.write(items.withColumn("item", F.monotonically_increasing_id()), "items")


class Bitmap:
    """Which seeds the benchmark may have: bit ``seed >> (64 - bits)``."""

    def __init__(self, items: DataFrame, max_bits: int = MAX_BITS):
        count = items.agg(F.sum(F.size("seeds"))).first()[0] or 0
        self.bits = min(max_bits, max(16, (count * 4096).bit_length()))
        self.lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # SEED at most
        at = F.shiftrightunsigned("seed", 64 - self.bits) + 1  # bitmap functions count from 1
        rows = (items.select(F.explode("seeds").alias("seed")).groupBy(F.bitmap_bucket_number(at).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bytes"))).collect()  # 4 KB each
        self.bytes = np.zeros(1 << self.bits >> 3, np.uint8)
        for r in rows:
            start = (r["bucket"] - 1) * 4096
            some = np.frombuffer(r["bytes"], np.uint8)[:len(self.bytes) - start]
            self.bytes[start:start + len(some)] = some

    def met(self, found: np.ndarray) -> np.ndarray:
        at = found >> np.uint64(64 - self.bits)
        return found[self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0]


def _candidates(docs: DataFrame, bitmap: Bitmap, text: str, name: str | None) -> DataFrame:
    """Rows that may share a seed with the benchmark, with these seeds as ``name``;
    without a name the other rows."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    at = docs.columns.index(text)

    def run(batches):
        b = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(start, ROWS_PER_SLICE)
                met = [b.met(seeds(words(t or ""), b.lengths)) for t in part.column(at).to_pylist()]
                some = pa.array(np.array([len(m) > 0 for m in met], bool))
                if name is None:
                    yield part.filter(pc.invert(some))
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns, _lists(met)], names=[*part.schema.names, name]).filter(some)
    schema = StructType([*docs.schema.fields] + ([StructField(name, ArrayType(LongType()))] if name else []))
    return map_arrow(docs, run, schema)


def _tiled(some: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """Candidates (uid, text, seeds) -> (uid, item_id, coverage, n_tiles, longest_tile)."""
    asked = (some.select("uid", F.explode("seeds").alias("seed"))
             .join(items.select("item", F.explode("seeds").alias("seed")), "seed").select("uid", "item").distinct()
             .join(items.select("item", "item_id", "text"), "item"))
    kind = items.schema["item_id"].dataType
    rows = (some.select("uid", F.lit(-1).cast("long").alias("item"), F.lit(None).cast(kind).alias("item_id"), "text")
            .unionByName(asked.select("uid", "item", "item_id", "text"))
            .repartition("uid").sortWithinPartitions("uid", "item"))

    def run(batches):
        uid, doc = None, []
        for batch in batches:
            out = []
            for owner, item, item_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if item < 0:
                    uid, doc = owner, words(text or "")
                elif owner == uid and (got := held(doc, words(text), coverage)):
                    out.append((owner, item_id, got[0], len(got[1]), max(n for _, _, n in got[1])))
            if out:
                owners, ids, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), pa.array(ids, batch.column(2).type), *map(pa.array, rest)],
                    names=["uid", "item_id", "coverage", "n_tiles", "longest_tile"])
    return map_arrow(rows, run, f"uid long, item_id {kind.simpleString()}, coverage double, n_tiles long, longest_tile long")


def leaks(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, coverage,
    n_tiles, longest_tile."""
    scratch = Scratch(docs.sparkSession, "leaks")
    items = indexed(benchmark, scratch)
    some = _candidates(docs.select("doc_id", "text"), Bitmap(items), "text", "seeds")
    some = scratch.write(some.withColumn("uid", F.monotonically_increasing_id()), "candidates")
    found = _tiled(some, items, coverage)
    return found.join(some.select("uid", "doc_id"), "uid").select(
        "doc_id", "item_id", "coverage", "n_tiles", "longest_tile")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE,
               text: str = "text") -> DataFrame:
    """The rows that hold no benchmark item, all columns as they are. Those that
    share no seed pass by; the others are written and tiled."""
    scratch = Scratch(docs.sparkSession, "leaks")
    items = indexed(benchmark, scratch)
    bitmap = Bitmap(items)
    uid, seed = free_name(docs, "uid"), free_name(docs, "seeds")
    some = _candidates(docs, bitmap, text, seed).withColumn(uid, F.monotonically_increasing_id())
    some = scratch.write(some, "candidates")
    found = _tiled(some.select(F.col(uid).alias("uid"), F.col(text).alias("text"), F.col(seed).alias("seeds")), items, coverage)
    gone = scratch.write(found.select(F.col("uid").alias(uid)).distinct(), "gone")
    clean = some.join(gone, uid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return _candidates(docs, bitmap, text, None).unionByName(clean)
