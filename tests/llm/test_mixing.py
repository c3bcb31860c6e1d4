import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import mixing
from sessionlens.llm.common import Scratch


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by the words of the task: share out, cut what is too high, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, excess, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while excess > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        excess = 0.0
        for s in names:
            if target[s] >= most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def brute(rows):
    """(doc_id, source, taken) of rows (doc_id, source, digest, size, key)."""
    sizes = defaultdict(int)
    for _, source, _, size, _ in rows:
        sizes[source] += size
    target, out = water_fill(sizes), []
    for s in sizes:
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        left = math.floor(target[s] - epochs * sizes[s] + 0.5)
        for doc_id, _, digest, size, key in sorted((r for r in rows if r[1] == s), key=lambda r: (r[4], r[0] is not None, r[0] or 0, r[2])):
            here = min(left, size)
            left -= here
            out.append((doc_id, s, epochs * size + here))
    return Counter(out), target


def check(docs):
    rows = [tuple(r) for r in mixing.keyed(docs).select("doc_id", "source", "digest", "size", "key").collect()]
    want, target = brute(rows)
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r.taken) for r in got) == want
    for r in got:
        assert r.target == pytest.approx(target[r.source])
        assert r.taken <= 2 * r.size
    return got


def made(spark, n, source, text="w" + " w" * 9, repeat=1):
    return spark.range(n).select(F.col("id").alias("doc_id"), source.alias("source"),
                                 F.expr(f"concat(repeat('word, ', cast(id % 37 as int)), '{text}')").alias("text")).withColumn(
        "again", F.explode(F.sequence(F.lit(1), F.lit(repeat))))


def test_mix_matches_brute_force_with_a_hot_source(spark):
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("s"), F.col("id") % 7))
    got = check(made(spark, 4000, source))
    by = defaultdict(lambda: [0, 0.0])
    for r in got:
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
    assert all(abs(a - b) <= 0.5 + 1e-6 for a, b in by.values())


def test_repeated_rows_at_the_edge(spark):
    """One row a thousand times over several files: the copies share one key and the target falls among them."""
    got = check(made(spark, 3, F.when(F.col("id") < 2, "a").otherwise("b"), repeat=1000).repartition(7))
    taken = Counter(r.taken for r in got if r.doc_id == 0)
    assert len(taken) <= 3


def test_edges(spark, edge_docs, empty_docs):
    check(edge_docs)
    assert mixing.mix(empty_docs).count() == 0
    blank = edge_docs.withColumn("text", F.lit(" "))
    assert {(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


def test_targets_are_shared_again(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, None: 500, "é": 30}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table, Scratch(spark, "t")).collect()}
    assert got == pytest.approx(water_fill(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_and_partitioning_agree(spark):
    docs = made(spark, 500, F.concat(F.lit("s"), F.col("id") % 3))
    a = Counter(map(tuple, mixing.mix(docs).collect()))
    assert a == Counter(map(tuple, mixing.mix(docs.repartition(5)).collect()))


def test_quality_favours_documents(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("ten words " * 5).alias("text"))
    likely = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)
    got = mixing.mix(docs, weight=likely, share=0.25).collect()
    taken = [sum(r.taken for r in got if r.doc_id % 2 == k) for k in (0, 1)]
    assert taken[0] > 5 * taken[1]


def test_materialized_words(spark):
    docs = spark.createDataFrame([(1, "a", "one  two\nthree"), (2, "a", " four five"), (3, "b", "six"), (4, "b", None)],
                                 "doc_id long, source string, text string")
    mixed = mixing.mix(docs)
    rows = mixing.materialize(docs, mixed).collect()
    words, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        words[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text)
    assert words == Counter({r.doc_id: r.taken for r in mixed.collect() if r.taken})


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(made(spark, 20, F.lit("s")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
