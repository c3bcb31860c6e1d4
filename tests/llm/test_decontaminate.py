import random

import numpy as np
import pytest

from sessionlens.llm import decontaminate as D


def slow_tiles(doc, item, shortest):
    """Greedy string tiling without hashes."""
    dm, im, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best, found = shortest - 1, []
        for a in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while (a + n < len(doc) and p + n < len(item) and doc[a + n] == item[p + n] and doc[a + n] >= 0
                       and not dm[a + n] and not im[p + n]):
                    n += 1
                if n > best:
                    best, found = n, [(a, p)]
                elif n == best and n >= shortest:
                    found.append((a, p))
        if not found:
            return total
        for a, p in found:
            if not any(dm[a:a + best]) and not any(im[p:p + best]):
                dm[a:a + best] = im[p:p + best] = [True] * best
                total += best


@pytest.mark.parametrize("seed", range(60))
def test_tiles_against_plain_greedy_tiling(seed):
    rng = random.Random(seed)
    doc = np.array([rng.randrange(-1, 4) for _ in range(rng.randrange(0, 40))], np.int64)
    item = np.array([rng.randrange(0, 4) for _ in range(rng.randrange(1, 15))], np.int64)
    got = D.tiles(doc, item, 3)
    for a, p, n in got:
        assert n >= 3 and (doc[a:a + n] == item[p:p + n]).all()
    assert sum(n for _, _, n in got) == slow_tiles(doc.tolist(), item.tolist(), 3)


PASSAGE = "one two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen!"
NOISE = " ".join(f"w{i}" for i in range(200))


@pytest.fixture
def bench(spark):
    rows = [(1, PASSAGE, 9), (2, "too short", 9), (3, None, 9), (4, PASSAGE, 9), (5, "", 9),
            (6, " ".join(f"v{i}" for i in range(30)), 9)]
    return spark.createDataFrame(rows, "item_id long, text string, coverage int")


def test_whole_reordered_and_partial_passages(spark, bench):
    half = len(PASSAGE.split()) // 2
    parts = [" ".join(PASSAGE.split()[half:]), " ".join(PASSAGE.split()[:half])]
    rows = [(1, f"{NOISE} {PASSAGE.upper()} {NOISE}"), (2, f"{parts[0]} {NOISE} {parts[1]}"), (3, parts[0]),
            (4, NOISE), (5, None), (6, ""), (None, PASSAGE), (1, PASSAGE), (7, NOISE + " v0 v1 v2 v3 v4 v5 "),
            (8, " ".join(reversed(PASSAGE.split())))]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item_id int, coverage string")
    got = sorted((str(r.doc_id), r.item_id, r.n_tiles) for r in D.leaks(docs, bench).collect())
    assert got == sorted((d, i, n) for d, n in (("1", 1), ("1", 1), ("2", 2), ("None", 1)) for i in (1, 4))
    kept = D.drop_leaks(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8]


def every_pair(docs, items, coverage=D.COVERAGE):
    """All items that share a run of SEED words (all words of shorter ones) with a text."""
    out = []
    for doc_id, text in docs:
        doc = D.words(text or "")
        for item_id, said in items:
            item = D.words(said or "")
            n = min(D.SEED, len(item))
            runs = {tuple(doc[i:i + n]) for i in range(len(doc) - n + 1)}
            if n and any(tuple(item[i:i + n]) in runs for i in range(len(item) - n + 1)):
                number = {w: k for k, w in enumerate(dict.fromkeys(item))}
                ids = np.array([number[w] for w in item], np.int64)
                got = D.tiles(np.array([number.get(w, -1) for w in doc], np.int64), ids, min(D.TILE, len(item)))
                if sum(x for _, _, x in got) >= coverage * len(item):
                    out.append((doc_id, item_id, len(got)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [27, 3])
def test_seed_joins_find_what_comparing_all_pairs_finds(spark, bits, monkeypatch):
    """Few words, so that many items share seeds; a tiny bitmap lets everything pass."""
    monkeypatch.setattr(D.Bitmap.__init__, "__defaults__", (bits,))
    rng = random.Random(bits)
    say = lambda n, of: " ".join(f"w{rng.randrange(of)}" for _ in range(n))
    items = [(k, say(rng.randrange(0, 20), 6)) for k in range(40)] + [(100, None), (None, say(9, 6)), (3, say(9, 6))]
    docs = [(k, say(rng.randrange(0, 80), 9)) for k in range(30)]
    docs += [(k, f"{say(20, 9)} {items[k][1]} {say(20, 9)}") for k in range(30, 40)] + [(1, None), (None, items[5][1]), (0, docs[0][1])]
    found = D.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                    spark.createDataFrame(items, "item_id long, text string"))
    want = every_pair(docs, items)
    assert sorted(((r.doc_id, r.item_id, r.n_tiles) for r in found.collect()), key=str) == want and len(want) > 20
    table = spark.createDataFrame([(*d, "u", [1]) for d in docs], "doc_id long, text string, uid string, seeds array<int>")
    kept = D.drop_leaks(table, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.schema == table.schema
    bad = {(d, t) for d, t in docs if every_pair([(d, t)], items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((d for d in docs if d not in bad), key=str)


def test_one_common_seed_in_many_items_is_cheap():
    import time
    common = [b"the", b"same", b"five", b"words", b"here"]
    doc = [b"d%d" % i for i in range(2000)] + common
    start = time.process_time()
    assert all(D.held(doc, common + [b"i%d_%d" % (k, j) for j in range(60)], 0.8) is None for k in range(2000))
    assert time.process_time() - start < 2


def test_bitmap_has_every_seed(spark):
    bench = spark.createDataFrame([(k, " ".join(f"x{k}y{j}" for j in range(30))) for k in range(50)], "item_id long, text string")
    items = D.indexed(bench, D.Scratch(spark, "t"))
    bitmap = D.Bitmap(items)
    mine = np.unique(np.array([s for r in items.collect() for s in r.seeds], np.int64)).view(np.uint64)
    assert (bitmap.met(mine) == mine).all() and len(mine) == 50 * 26
    other = D.seeds([b"z%d" % i for i in range(20_000)], (5,))
    assert len(bitmap.met(other)) < 100


def test_edges(spark, bench, edge_docs, empty_docs):
    assert D.leaks(empty_docs, bench).collect() == [] and D.drop_leaks(empty_docs, bench).collect() == []
    assert D.leaks(edge_docs, bench.limit(0)).collect() == []
    assert D.drop_leaks(edge_docs, bench.limit(0)).count() == edge_docs.count()
    assert D.drop_leaks(edge_docs, bench).count() == edge_docs.count()


def test_short_items_match_as_a_whole(spark):
    bench = spark.createDataFrame([(1, "What is it?"), (2, "capital"), (3, "a b c d"), (4, "?!")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{NOISE} what IS it, {NOISE}"), (2, "the Capital."), (3, "a b c x d"), (4, "is it what"),
                                  (5, "a b c d")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.coverage, r.n_tiles) for r in D.leaks(docs, bench).collect())
    assert got == [(1, 1, 1.0, 1), (2, 2, 1.0, 1), (5, 3, 1.0, 1)]
