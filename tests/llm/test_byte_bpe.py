import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionlens.llm import byte_bpe as B

ENC = B.encoding(public_tokenizers.path(B.RANKS))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 'sdtéZ09.,!\n\t\r\x1c\x85\xa0漢́", max_size=60), st.integers(1, 9))
def test_segments_change_no_id(text, size):
    assert "".join(B.segments(text, size)) == text
    assert B.encode_text(ENC, text, size) == ENC.encode_ordinary(text)


def test_whole_texts_and_round_trip(spark, edge_docs):
    got = B.round_trip(edge_docs).collect()
    want = []
    for row in edge_docs.collect():
        data = (row.text or "").encode()
        ids = ENC.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(data).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_endless_words():
    for text in ("a" * 500_000, " " * 500_000, "1" * 300_000 + "x" * 300_000):
        assert ENC.decode_bytes(B.encode_text(ENC, text)) == text.encode()


def test_encode_and_empty_table(edge_docs, empty_docs):
    rows = B.encode(edge_docs.where("doc_id = 5")).collect()
    assert [list(r.ids) for r in rows] == [ENC.encode_ordinary("a b c d")] * 2
    assert B.round_trip(empty_docs).collect() == []
