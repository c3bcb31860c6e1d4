"""Token-id store: one wavelet matrix per shard.

Documents are dealt by ranges of their id, encoded with the tokenizers library
in id order, closed by an end id each, and gathered into shards of about
``SHARD_TOKENS`` ids (a document never spans two). A shard is one compressed
file: bit-planes of the ids from the highest bit down, each plane stably
parted by its bit before the next, with counts of ones per block, so that any
id can be read, and the ids of a value counted and found, without the others.
Spark writes one shard per Parquet file, so tasks that are lost or run twice
leave no half-written shard, and any store that Spark can reach will do.

Cases: a null or empty text is just the end id. Equal ids are ordered by a
hash of their texts, then by the texts; null ids come first. An empty table
gives no shard and no rows. Extra columns are ignored. Whole texts are encoded.
"""

from __future__ import annotations

import json
import re
import struct
import sys
from array import array
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_arrow

TOKENIZER = "byte_bpe_50k.json"
END = 0
SHARD_TOKENS = 1 << 21
BLOCK = 512                # bits per rank block
MAGIC = b"WMX1"
CACHED_CHUNKS = 2_000_000  # distinct chunks kept per worker, at most
CACHED_LENGTH = 48
LONG = 1 << 20             # code points of a text that are cut at once, about
BATCH_BYTES = 8 << 20      # of texts
PARTED = 1 << 15           # ids parted at once: what fits near the processor


# --- encoding ----------------------------------------------------------------

class Encoder:
    """Ids of whole texts by the tokenizers library.

    A byte-level BPE tokenizer splits before a space or line break that follows
    a non-space, whatever surrounds it. So the ids of a text are those of the
    chunks between such places. Texts are cut in Arrow, a batch's distinct chunks
    are looked up once, and what is not known goes to the library: plain letters
    and the punctuation after them to its BPE model piece by piece, any other
    chunk, and a text that holds a special token, through its whole pipeline."""

    _PLAIN = re.compile(r"[\x20-\x7e\nÀ-ÖØ-öø-ÿ]*")
    _PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+"
                        r"| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
    _CUT = re.compile(r"(?<=\S)(?=[ \n])")
    _START, _END = "\x01", "\x02"  # stand before and after a text while it is cut
    _PUNCTUATION = ".,;:!?()\"'-"

    def __init__(self, path: str, end: int = END):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        size = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.levels = max(1, (size - 1).bit_length())
        self.dtype = np.dtype("<u2" if self.levels <= 16 else "<u4")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_chunk = (model.get("type") == "BPE" and not model.get("dropout")
                         and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex") and not pre.get("add_prefix_space"))
        self.letters = _byte_letters()
        self.closing = self._pack([end])
        self.pieces = _Cache(self._piece, 1 << 16)
        self.words = _Cache(self._word, CACHED_CHUNKS)

    def _pack(self, ids) -> bytes:
        if sys.byteorder == "little":
            return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._pack([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])

    def _chunk(self, chunk: str) -> bytes:
        if self._PLAIN.fullmatch(chunk):
            return b"".join(map(self._piece, self._PIECE.findall(chunk)))
        return self._pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes | None:
        """The ids of what a space or line break led to; None where the text must
        not be cut there (the place before is white space too, or the text's end)."""
        if word == self._START:
            return b""
        if word == self._END:
            return self.closing
        if not word or word[-1].isspace():
            return None
        if word[0] == self._START:
            return self._chunk(word[1:])
        core = word.rstrip(self._PUNCTUATION)
        if core.isascii() and core.isalpha():
            ids = self._pack([t.id for t in self.model.tokenize(self.letters[0x20] + core)])
            return ids if len(core) == len(word) else ids + self.pieces[word[len(core):]]
        return self._chunk(word if word[0] == "\n" else " " + word)

    def whole(self, text: str | None) -> bytes:
        """The ids of any text."""
        if not text:
            return b""
        if not self.by_chunk or any(s in text for s in self.specials):
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self._chunk, self._CUT.split(text)))

    def __call__(self, text: str | None) -> bytes:
        """The ids, packed."""
        return self.batch(pa.array([text], pa.string()))[0][:-1].tobytes()

    def _pieces_of(self, text: str | None) -> list[str]:
        """A long text in parts that can be encoded one by one."""
        if text is None or len(text) <= LONG or not self.by_chunk or any(s in text for s in self.specials):
            return [text or ""]
        out, start = [], 0
        while len(text) - start > LONG:
            cut = self._CUT.search(text, start + LONG)
            if cut is None:
                break
            out.append(text[start:cut.start()])
            start = cut.start()
        return [*out, text[start:]]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, each closed by the end id, and
        how many each has."""
        owner = None
        if self.by_chunk and (pc.max(pc.utf8_length(texts)).as_py() or 0) > LONG:
            parts = [self._pieces_of(t) for t in texts.to_pylist()]
            if sum(map(len, parts)) > len(parts):
                owner = np.repeat(np.arange(len(parts)), list(map(len, parts)))
                texts = pa.array([p for some in parts for p in some], pa.string())
        slow = np.full(len(texts), not self.by_chunk)
        for s in (*self.specials, self._START, self._END):
            slow |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        fast = texts if not slow.any() else pa.array(np.where(slow, "", texts.to_numpy(zero_copy_only=False)), pa.string())
        marked = pc.binary_join_element_wise(self._START, fast, " " + self._END, "", null_handling="replace")
        words = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        starts = words.offsets.to_numpy()
        found = words.flatten().dictionary_encode()
        made = list(map(self.words.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        at = found.indices.to_numpy()
        bad = np.array([m is None for m in made], bool)
        if bad.any():
            slow |= np.logical_or.reduceat(bad[at], starts[:-1])
            made = [m or b"" for m in made]
        size = np.fromiter(map(len, made), np.int64, len(made)) // self.dtype.itemsize
        first = np.cumsum(size) - size
        n = size[at]
        upto = np.cumsum(n)
        pool = np.frombuffer(b"".join(made), self.dtype)
        ids = pool[np.arange(upto[-1]) + np.repeat(first[at] - (upto - n), n)]
        lengths = np.diff(np.concatenate([[0], upto])[starts])
        if slow.any():
            other = [np.frombuffer(self.whole(texts[i].as_py()) + self.closing, self.dtype) for i in np.flatnonzero(slow)]
            kept, sizes = ids[np.repeat(~slow, lengths)], lengths.copy()
            sizes[slow] = [len(o) for o in other]
            ids, taken = np.empty(sizes.sum(), self.dtype), np.repeat(slow, sizes)
            ids[~taken], ids[taken], lengths = kept, np.concatenate(other), sizes
        if owner is not None:  # one end id per text, not per part
            last = np.append(owner[1:] != owner[:-1], True)
            ends = np.cumsum(lengths) - 1
            ids = np.delete(ids, ends[~last])
            lengths = np.bincount(owner, lengths - ~last).astype(np.int64)
        return ids, lengths


class _Cache(dict):
    """A dict that makes missing values and keeps those of short keys: the ones
    in use since the last two turnovers, ``size`` at most."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.half, self.before = make, size // 2, {}

    def __missing__(self, key):
        made = self.before.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= self.half:
                self.before = dict(self)
                self.clear()
            self[key] = made
        return made


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def encoder(path: str, end: int = END) -> Encoder:
    return Encoder(path, end)


def slices(column: pa.Array):
    """Runs of texts of some ``BATCH_BYTES``, one text at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    group = (np.cumsum(sizes) - 1) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield a, column.slice(a, b - a)


# --- wavelet matrix ----------------------------------------------------------

class WaveletMatrix:
    """Rank/select structure over a sequence of ids below ``2 ** levels``."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks
        self.levels = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        n, planes, zeros, ranks = len(ids), [], [], []
        for level in range(levels):
            bit = (ids >> ids.dtype.type(levels - 1 - level)) & ids.dtype.type(1) != 0
            packed = np.packbits(bit)
            ones = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK // 8),
                                   dtype=np.uint32) if n else np.zeros(0, np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)]))
            planes.append(packed)
            zero, parted = ~bit, np.empty_like(ids)
            low, high = 0, n - int(np.count_nonzero(bit))
            zeros.append(high)
            for at in range(0, n, PARTED):
                some = ids[at:at + PARTED]
                left, right = some[np.flatnonzero(zero[at:at + PARTED])], some[np.flatnonzero(bit[at:at + PARTED])]
                parted[low:low + len(left)], parted[high:high + len(right)] = left, right
                low, high = low + len(left), high + len(right)
            ids = parted
        return cls(n, planes, zeros, ranks)

    def all(self, dtype=np.uint32) -> np.ndarray:
        """Every id in order: undo the partings from the last plane to the first."""
        ids = np.zeros(self.n, dtype)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            zero, before = ~bit, np.empty(self.n, dtype)
            low, high = 0, self.zeros[level]
            ids[high:] |= dtype(1 << (self.levels - 1 - level))
            for at in range(0, self.n, PARTED):
                some = before[at:at + PARTED]
                left, right = np.flatnonzero(zero[at:at + PARTED]), np.flatnonzero(bit[at:at + PARTED])
                some[left], some[right] = ids[low:low + len(left)], ids[high:high + len(right)]
                low, high = low + len(left), high + len(right)
            ids = before
        return ids

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before place ``i``."""
        block, rest = divmod(i, BLOCK)
        total = int(self.ranks[level][block])
        if rest:
            part = self.planes[level][block * BLOCK // 8:block * BLOCK // 8 + -(-rest // 8)].copy()
            if rest % 8:
                part[-1] &= 0xFF << (8 - rest % 8) & 0xFF
            total += int(np.bitwise_count(part).sum())
        return total

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.levels):
            bit = self.planes[level][i >> 3] >> (7 - (i & 7)) & 1
            ones = self._ones(level, i)
            out = out << 1 | int(bit)
            i = self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` occurs before place ``i``."""
        low, high = self._range(token, 0, i)
        return high - low

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        low, high = self._range(token, low, self.n if high is None else high)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``token``."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) one or zero of a plane."""
        ones = self.ranks[level].astype(np.int64)
        upto = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(upto, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - upto[block]])

    def places(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


class Shard:
    """A wavelet matrix with the ids and token counts of its documents."""

    def __init__(self, matrix: WaveletMatrix, doc_ids: list[int | None], lengths: np.ndarray):
        self.matrix, self.doc_ids, self.lengths = matrix, doc_ids, lengths

    def to_bytes(self) -> bytes:
        m = self.matrix
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        parts = [struct.pack("<QIB", m.n, len(ids), m.levels), np.array(m.zeros, "<u8").tobytes(),
                 known.tobytes(), ids.tobytes(), self.lengths.astype("<u8").tobytes()]
        for plane, rank in zip(m.planes, m.ranks):
            parts += [plane.tobytes(), rank.astype("<u4").tobytes()]
        return MAGIC + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def from_bytes(cls, blob: bytes) -> Shard:
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        data = zstandard.ZstdDecompressor().decompress(blob[4:])
        n, docs, levels = struct.unpack_from("<QIB", data)
        at = 13

        def take(dtype, count):
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        zeros = [int(z) for z in take("<u8", levels)]
        known, ids, lengths = take(np.uint8, docs), take("<i8", docs), take("<u8", docs)
        planes, ranks = [], []
        for _ in range(levels):
            planes.append(take(np.uint8, -(-n // 8)))
            ranks.append(take("<u4", -(-n // BLOCK) + 1))
        return cls(WaveletMatrix(n, planes, zeros, ranks),
                   [int(d) if k else None for d, k in zip(ids, known)], lengths.astype(np.int64))


# --- Spark -------------------------------------------------------------------

SCHEMA = "part int, shard int, before long, n_tokens long, n_docs long, blob binary"


def write(docs: DataFrame, path: str, *, tokenizer: str | None = None, end: int = END,
          shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` in id order into wavelet-matrix shards under ``path``."""
    tokenizer_path = tokenizer or public_tokenizers.path(TOKENIZER)
    digest = F.xxhash64("text")
    ordered = (docs.select("doc_id", "text").withColumn("digest", digest)
               .repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "text")
               .select("doc_id", "text"))

    def run(batches):
        encode, part, shard, before = encoder(tokenizer_path, end), TaskContext.get().partitionId(), 0, 0
        ids, lengths, tokens, held = [], [], [], 0

        def row():
            made = Shard(WaveletMatrix.build(np.concatenate(tokens), encode.levels),
                         [i for some in ids for i in some], np.concatenate(lengths))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before]),
                 pa.array([made.matrix.n]), pa.array([len(made.doc_ids)]), pa.array([made.to_bytes()])],
                names=["part", "shard", "before", "n_tokens", "n_docs", "blob"])

        for batch in batches:
            for at, texts in slices(batch.column(1)):
                made, size = encode.batch(texts)
                doc_ids, upto = batch.column(0).slice(at, len(texts)).to_pylist(), np.cumsum(size)
                start = 0
                while start < len(size):  # up to the document that fills the shard
                    done = upto[start - 1] if start else 0
                    stop = min(len(size), int(np.searchsorted(upto, done + shard_tokens - held)) + 1)
                    ids.append(doc_ids[start:stop])
                    lengths.append(size[start:stop])
                    tokens.append(made[done:upto[stop - 1]])
                    held, start = held + int(upto[stop - 1] - done), stop
                    if held >= shard_tokens:
                        yield row()
                        ids, lengths, tokens, held, shard, before = [], [], [], 0, shard + 1, before + held
        if ids:
            yield row()

    (map_arrow(ordered, run, SCHEMA).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").parquet(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (over little-endian 32-bit ids)."""
    starts, total = {}, 0
    # one row per written partition, whose number the session sets
    for row in (shards(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
                .orderBy("part").collect()):
        starts[row["part"]], total = total, total + row["n"]

    def run(batches):
        for batch in batches:
            for part, before, blob in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                made = Shard.from_bytes(blob)
                narrow = made.matrix.levels <= 16
                ids = made.matrix.all(np.uint16 if narrow else np.uint32)
                ends = np.cumsum(made.lengths)
                begins = ends - made.lengths
                wide = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [crc32(wide[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.doc_ids, pa.int64()), pa.array(begins + (starts[part] + before)),
                     pa.array(made.lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(shards(spark, path).select("part", "before", "blob"), run,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Per shard (part, shard): how often ``token`` occurs, from the bit-planes."""
    def run(batches):
        for batch in batches:
            n = [Shard.from_bytes(b.as_py()).matrix.count(token) for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                                             names=["part", "shard", "n"])
    return map_arrow(shards(spark, path).select("part", "shard", "blob"), run, "part int, shard int, n long")
