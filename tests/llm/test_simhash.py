import re

import numpy as np
import pytest
import xxhash

from sessionlens.llm import simhash as S
from sessionlens.llm.common import Scratch
from sessionlens.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow_fingerprint(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(fps, radius=3):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def some_fingerprints(seed, centre=250):
    rng = np.random.default_rng(seed)
    out = []
    for start in rng.integers(0, 2 ** 63, 120, dtype=np.int64).astype(np.uint64):
        x = start
        for _ in range(rng.integers(1, 5)):  # chains of near fingerprints
            out.append(x)
            for k in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= np.uint64(1) << np.uint64(k)
    for _ in range(centre):  # a dense ball
        x = out[0]
        for k in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= np.uint64(1) << np.uint64(k)
        out.append(x)
    return np.unique(np.array(out + [0], np.uint64))


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b", " x\x0b\x1c y z Q ", "Éa b c d", "a b c", "w " * 70_000,
                                  "the cat sat on the mat and the dog ran"])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_forest_finds_all_pairs():
    fp = some_fingerprints(2)
    tree = np.sort(np.arange(len(fp)) % 7)
    code, child = S.build_forest(tree, fp)
    q, node = S.search_forest(code, child, fp, fp, np.searchsorted(tree, tree), 3)
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp))
            if tree[i] == tree[j] and bin(int(fp[i] ^ fp[j])).count("1") <= 3}
    assert set(zip(q.tolist(), node.tolist())) == want


@pytest.mark.parametrize("shard", [100_000, 48, 12])
def test_classes_for_any_shard_size(spark, shard):
    fp = some_fingerprints(5)
    nodes = spark.createDataFrame([(int(v),) for v in fp.view(np.int64)], "fp long")
    scratch = Scratch(spark, "test")
    edges = scratch.write(S.links(nodes, scratch, 3, shard), "links")
    label = {r.node: r.label for r in connected_components(edges, scratch).collect()}
    got, want = {}, {}
    for i, v in enumerate(fp.view(np.int64).tolist()):
        got.setdefault(label.get(v, v), set()).add(i)
    for i, k in enumerate(slow_classes(fp)):
        want.setdefault(k, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    scratch.drop()


def test_long_path_is_one_component(spark):
    edges = spark.range(300).selectExpr("(id * 7919) % 301 as a", "((id + 1) * 7919) % 301 as b")
    labels = connected_components(edges, Scratch(spark, "path")).collect()
    assert {r.label for r in labels} == {min(r.node for r in labels)} and len(labels) == 301


def test_edges_of_the_table(edge_docs, empty_docs):
    rows = S.classes(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[2].component_id == 1 and by[5].component_id == 5
    assert S.classes(empty_docs).collect() == []


def test_one_of_each_class_stays(edge_docs, empty_docs):
    kept = S.drop_copies(edge_docs)
    assert kept.schema == edge_docs.schema
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7]
    assert kept.where("doc_id is null").count() == 1
    assert S.drop_copies(empty_docs).count() == 0


def test_repeated_ids_with_unlike_texts(spark):
    """Ids 3 and 5 share text A, ids 5, 7 and 8 text B; both classes keep a row."""
    texts = {c: " ".join(f"{c}{i * i}" for i in range(60)) for c in "ABCD"}
    rows = [(3, "A"), (5, "A"), (5, "B"), (7, "B"), (8, "B"), (None, "C"), (None, "C"), (9, "D"), (9, "D"), (None, "D")]
    docs = spark.createDataFrame([(i, texts[c], "x") for i, c in rows], "doc_id long, text string, digest string")
    kept = S.drop_copies(docs)
    assert kept.schema == docs.schema
    got = sorted((r.doc_id or 0, r.text[0]) for r in kept.collect())
    assert got == [(0, "C"), (3, "A"), (5, "B"), (9, "D")]


@pytest.mark.parametrize("seed", range(3))
def test_kept_rows_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    pool = ["", *(" ".join(f"w{x}" for x in rng.integers(0, 9000, 40)) for _ in range(8))]
    pool += [t.replace("w1", "v1", 1) for t in pool]
    rows = [(None if rng.random() < .1 else int(rng.integers(0, 12)), pool[rng.integers(len(pool))]) for _ in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label = slow_classes(np.array([slow_fingerprint(t) for _, t in rows], np.uint64))
    kept = [(r.doc_id, r.text) for r in S.drop_copies(docs).collect()]
    least = {}
    for (i, t), k in zip(rows, label):
        least[k] = min(least.get(k, (True, 0)), (i is None, i or 0))
    of = {r: k for r, k in zip(rows, label)}
    assert sorted((of[r], (r[0] is None, r[0] or 0)) for r in kept) == sorted(least.items())
