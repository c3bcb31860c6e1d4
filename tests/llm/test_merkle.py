import hashlib
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import merkle
from sessionlens.llm.common import Scratch, numbered


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    say = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(say, (r.doc_id, r.source, r.lang, r.n_chars, text))))


def tree(nodes):
    """(top, per node: list of (siblings before, siblings after))."""
    proofs, level, owners = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        runs = [range(a, min(a + 3, len(level))) for a in range(0, len(level), 3)]
        for run in runs:
            for i in run:
                for o in owners[i]:
                    proofs[o].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        owners = [[o for i in run for o in owners[i]] for run in runs]
        level = [sha("".join(level[i] for i in run)) for run in runs]
    return level[0], proofs


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append((r, leaf(r, r.text)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        trees[s] = tree([h for _, h in by[s]])
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (r, h), proof in zip(by[s], trees[s][1]):
            proof, f = proof + top, h
            if r.doc_id is not None and crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None:
                f = leaf(r, r.text.replace("\n", ""))
            for a, b in proof:
                f = sha(a + f + b)
            out.append((r.doc_id, h, trees[s][0], root, sha("".join(a + b for a, b in proof)), f, f == root))
    return Counter(out)


def check(docs):
    got = merkle.check(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = got.collect()
    assert Counter(map(tuple, got)) == brute(docs.collect())
    return got


def docs(spark, n, source):
    return spark.range(n).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("en").alias("lang"),
                                 F.col("id").alias("n_chars"),
                                 F.expr("concat('a', if(id % 3 = 0, '\n', ' '), id)").alias("text"))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_one_source(spark, n):
    check(docs(spark, n, F.lit("s")))


@pytest.mark.parametrize("n", [2, 5, 30])
def test_every_document_its_own_source(spark, n):
    check(docs(spark, n, F.concat(F.lit("s"), F.col("id"))))


@pytest.mark.parametrize("limit", [0, merkle.BROADCAST])
def test_hot_source_both_join_ways(spark, limit, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST", limit)
    source = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 50 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("é"), F.col("id") % 11))
    got = check(docs(spark, 1500, source))
    assert {r.verified for r in got} == {True, False}


def test_repeated_and_equal_ids(spark):
    some = docs(spark, 40, F.lit("s"))
    check(some.unionByName(some).unionByName(some.withColumn("text", F.lit("other\n"))))


def test_edges(spark, edge_docs, empty_docs):
    check(edge_docs)
    assert merkle.check(empty_docs).count() == 0
    check(edge_docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")))


def test_numbering_spreads_equal_rows(spark):
    many = spark.range(20000).select((F.col("id") % 2).alias("k"))
    got = numbered(many, ["k"], Scratch(spark, "t"), "n").groupBy("k").agg(
        F.min("at").alias("a"), F.max("at").alias("b"), F.count_distinct("at").alias("n"))
    assert sorted(map(tuple, got.collect())) == [(0, 0, 9999, 10000), (1, 10000, 19999, 10000)]
