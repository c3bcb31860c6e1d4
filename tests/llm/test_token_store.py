from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionlens.llm import token_store as T
from sessionlens.llm.common import Scratch

PATH = T.public_tokenizers.path(T.TOKENIZER)
ENCODE = T.encoder(PATH)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 60, n).astype("<u2")
    shard = T.Shard(T.WaveletMatrix.build(ids, 6), [3, None], np.array([n, 0]))
    back = T.Shard.from_bytes(shard.to_bytes())
    m = back.matrix
    assert back.doc_ids == [3, None] and back.lengths.tolist() == [n, 0]
    assert (m.all(np.uint16) == ids).all()
    assert [m.access(i) for i in range(0, n, 41)] == ids[::41].tolist()
    for token in (0, 7, 59, 63, 64):
        where = np.flatnonzero(ids == token).tolist()
        assert m.places(token) == where and m.count(token) == len(where)
        assert m.rank(token, n // 2) == sum(w < n // 2 for w in where)
        assert m.count(token, n // 4, n // 2) == sum(n // 4 <= w < n // 2 for w in where)
    with pytest.raises(IndexError):
        m.access(n)
    with pytest.raises(IndexError):
        m.select(7, m.count(7))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"ab Z'strel ldé\xa0\x1c\x85\t\r\n.,!_012²½ÿ×漢́🙂\0", "<|endoftext|>", "'s", "  ",
                                 "\n\n", " the"]), max_size=30))
def test_encoder_equals_the_library(parts):
    text = "".join(parts)
    want = ENCODE.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODE(text), ENCODE.dtype).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z'\xa0\t\n.,!12é漢\x01\x02"), max_size=20) | st.none(), max_size=9), st.sampled_from([3, 1 << 20]))
def test_batches_equal_the_library(texts, long):
    before, T.LONG = T.LONG, long
    try:
        ids, lengths = ENCODE.batch(pa.array([*texts, "<|endoftext|> a"], pa.string()).slice(0, len(texts) + 1))
    finally:
        T.LONG = before
    want = [[*ENCODE.tokenizer.encode(t or "", add_special_tokens=False).ids, T.END] for t in [*texts, "<|endoftext|> a"]]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_slices_are_bounded():
    texts = pa.array(["x" * n for n in (0, 5, T.BATCH_BYTES + 3, 1, 1)] + [None], pa.string())
    runs = [(at, len(t)) for at, t in T.slices(texts)]
    assert sum(n for _, n in runs) == len(texts) and [at for at, _ in runs] == np.cumsum([0, *(n for _, n in runs)])[:-1].tolist()


def brute(rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*ENCODE.tokenizer.encode(text or "", add_special_tokens=False).ids, T.END], "<u4")
        out.append((doc_id, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [T.SHARD_TOKENS, 500])
def test_files_against_brute_force(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    scratch = Scratch(spark, "tokens")
    path = f"{scratch.base}/shards"
    T.write(docs, path, shard_tokens=size)
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    assert sorted(map(tuple, T.read_documents(spark, path).collect())) == brute(rows)
    all_ids = np.concatenate([np.frombuffer(ENCODE(t), ENCODE.dtype) for _, t in rows])
    assert T.count_token(spark, path, 262).agg({"n": "sum"}).first()[0] == (all_ids == 262).sum()
    scratch.drop()


def test_edges(spark, edge_docs, empty_docs):
    scratch = Scratch(spark, "tokens")
    T.write(edge_docs, f"{scratch.base}/a")
    got = T.read_documents(spark, f"{scratch.base}/a").collect()
    assert sorted(r.start for r in got)[0] == 0 and len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 1 and by[None].start == 0
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (n, c) for _, _, n, c in brute([(r.doc_id, r.text) for r in edge_docs.collect()]))
    T.write(empty_docs, f"{scratch.base}/b")
    assert T.read_documents(spark, f"{scratch.base}/b").collect() == []
    scratch.drop()
