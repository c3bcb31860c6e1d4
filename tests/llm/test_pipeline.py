import corpus_pipeline as P

from sessionlens.llm import byte_bpe, decontaminate, secret_scan, simhash, toxicity
from tests.llm.test_simhash import slow_classes, slow_fingerprint


def test_stages_against_brute_force(spark, tmp_dir):
    import numpy as np
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    p = toxicity.scores([t for _, t in rows], model.dense(), model.bias, model.bits)
    rows = [r for r, x in zip(rows, p) if x < 0.5]
    fps = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    first = {}
    for k, label in enumerate(slow_classes(fps)):
        first.setdefault(label, k)
    rows = [rows[k] for k in sorted(first.values())]
    items = [decontaminate.words(r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    runs = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in items]  # no item is shorter

    def leaks(text):
        t = decontaminate.words(text)
        have = {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
        return any(decontaminate.held(t, item, 0.8) for item, run in zip(items, runs) if have & run)
    assert min(map(len, items)) >= 5
    rows = [r for r in rows if not leaks(r[1])]
    enc = byte_bpe.encoding(byte_bpe.public_tokenizers.path(byte_bpe.RANKS))
    want = {i: enc.encode_ordinary(secret_scan.masked(t)) for i, t in rows}
    got = {r.doc_id: list(r.ids) for r in P.run(spark, d).collect()}
    assert got == want


def test_stages_on_edge_tables(spark, edge_docs, empty_docs, tmp_dir):
    spark.createDataFrame([(5, 1, 1), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, "nothing of these words is anywhere")], "item_id long, text string").write.parquet(
        f"{tmp_dir}/benchmark.parquet")
    for docs in (edge_docs, empty_docs):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, tmp_dir)
            assert out.columns == docs.columns
            out.count()
        assert P.STAGES[-1][1](spark, docs, tmp_dir).count() == docs.count()
    assert simhash.drop_copies(edge_docs).count() == 7
