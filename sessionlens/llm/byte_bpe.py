"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is a local file on every worker; its path is a parameter.
Texts longer than ``SEGMENT`` characters are cut at places where the split
pattern ends a match whatever follows, so the ids equal those of one call
over the whole text.

Cases: a null text is the empty text (no ids, digests of zero bytes);
repeated rows and equal ids are each encoded; an empty table gives no rows;
extra columns are ignored. Text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from .common import per_text

RANKS = "byte_bpe_multi_50k.tiktoken"
SEGMENT = 200_000

# No alternative of the pattern goes on from a non-space into white space, from
# a letter into a digit or punctuation, or from a digit into a letter.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?=[ \t\r\n])")
_IN_WORD = re.compile(r"(?<=[A-Za-z])(?=[0-9!-/:-@])|(?<=[0-9])(?=[A-Za-z])")


@lru_cache(maxsize=2)
def encoding(rank_path: str) -> tiktoken.Encoding:
    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut only at safe places.
    A run with no such place (one endless word) stays whole."""
    start = 0
    while len(text) - start > size:
        cut = (_BEFORE_SPACE.search(text, start + size, start + 2 * size)
               or _IN_WORD.search(text, start + size, start + 2 * size)
               or _BEFORE_SPACE.search(text, start + size) or _IN_WORD.search(text, start + size))
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str, size: int = SEGMENT) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for part in segments(text, size) for i in enc.encode_ordinary(part)]


def encode(docs: DataFrame, rank_path: str | None = None, *, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``ids`` (array of token ids) of every whole text."""
    path = rank_path or public_tokenizers.path(RANKS)

    def kernel():
        enc = encoding(path)
        return lambda texts: [[np.array(encode_text(enc, t or ""), np.int32) for t in texts]]

    return per_text(docs, kernel, [("ids", "array<int>")], keep=keep)


def decode_bytes(enc: tiktoken.Encoding, ids: list[int]) -> bytes:
    """Raw bytes of the ids; a token may hold part of a character."""
    return enc.decode_bytes(ids)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def round_trip(docs: DataFrame, rank_path: str | None = None, *, keep=("doc_id",),
               with_ids: bool = False) -> DataFrame:
    """Encode, decode again and digest both: ``n_tokens``, ``ids_sha256`` (ids as
    little-endian 32-bit), ``decoded_sha256``; ``with_ids`` adds the ids."""
    path = rank_path or public_tokenizers.path(RANKS)

    def kernel():
        enc = encoding(path)

        def apply(texts):
            n, digest, back, arrays = [], [], [], []
            for text in texts:
                ids = encode_text(enc, text or "")
                packed = np.array(ids, "<u4")
                n.append(len(ids))
                digest.append(_sha(packed.tobytes()))
                back.append(_sha(decode_bytes(enc, ids)))
                if with_ids:
                    arrays.append(packed.astype(np.int32))
            return [n, digest, back, *([arrays] if with_ids else [])]
        return apply

    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return per_text(docs, kernel, fields + [("ids", "array<int>")] * with_ids, keep=keep)
