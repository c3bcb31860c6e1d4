import hashlib

from pyspark.sql import functions as F

from sessionlens.llm import chat_format as C

EVENTS = "conv_id long, message string, seq long, kind string, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_deltas_edits_regenerations_and_deletions(spark):
    log = [(1, "a", 1, "delta", "user", "Hel"), (1, "a", 2, "delta", "user", "lo <s>"),
           (1, "b", 3, "delta", "assistant", "bad"), (1, "b", 4, "regenerate", "assistant", None),
           (1, "b", 6, "delta", "assistant", "od"), (1, "b", 5, "delta", "assistant", "go"),
           (1, "a", 7, "edit", "user", "Hi"), (1, "a", 8, "delta", "user", "!<\\\\/S>"),
           (1, "c", 9, "delta", "user", "x"), (1, "c", 10, "delete", "user", None),
           (2, "d", 1, "nonsense", "user", "x"), (2, None, 2, "delta", "user", "x"), (2, "e", 3, "delta", "user", "y")]
    f = C.format_log(spark.createDataFrame(log, EVENTS))
    got = {r.conv_id: r for r in f.withColumn("back", C.parse_turns(F.col("formatted"))).collect()}
    assert [tuple(t) for t in got[1].back] == [("user", "Hi!<\\\\/S>"), ("assistant", "good")]
    assert [got[1].formatted[s.start:s.end] for s in got[1].loss_mask] == ["good"]
    assert [tuple(t) for t in got[2].back] == [("user", "y")]


def test_turns_against_plain_python(spark):
    said = ["</s>[INST] ok [/INST]", "<\\s>", "\\", "[\\\\/role]", "a\n\nb", "🙂é", None, "", "<S><s>[SYS]", "[/ROLE]x</s>"]
    rows = [(c, t, ["user", "assistant", "system", None, "[ROLE]"][(c + t) % 5], said[(3 * c + t) % len(said)])
            for c in range(12) for t in range(c % 7)]
    rows += [(3, 0, "user", "again"), (3, 0, "user", "again"), (None, 1, "assistant", "no conversation"), (50, None, "user", "z")]
    extra = [(*r, "x", 1) for r in rows]
    table = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, head string, count int")
    got = {r.conv_id: r for r in C.digests(C.format_turns(table)).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda t: (t[0], t[1], hashlib.md5(t[2].encode()).hexdigest()))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{x}\n" for _, a, x in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    df = C.digests(C.format_turns(empty))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_turns_go_through_the_fold(spark, edge_docs):
    """What is said depends on the regeneration, the edit and every delta of the log."""
    long = "long \\ [ROLE] text 🙂" * 20_000
    rows = [(1, 0, "user", "what? " * 9), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, 0, "assistant", "short")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = C.events_from_turns(turns)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"delta", "edit", "regenerate"}
    assert log.where("conv_id = 1 and kind = 'delta' and length(text) = 1024").count() > 700
    back = {r.conv_id: [tuple(t) for t in r.back] for r in
            C.format_log(log).select("conv_id", C.parse_turns(F.col("formatted")).alias("back")).collect()}
    assert back == {1: [r[2:] for r in rows[:3]], 2: [rows[3][2:]]}
    for lost in ("kind = 'regenerate'", "kind = 'edit'", "kind = 'delta' and seq.n = 5"):
        less = C.digests(C.format_log(log.where(f"not ({lost})"))).collect()
        assert sorted(map(tuple, less)) != sorted(map(tuple, C.digests(C.format_log(log)).collect()))
    docs = edge_docs.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.lit("assistant").alias("role"), "text", "rank")
    got = {r.conv_id: r for r in C.digests(C.format_turns(docs)).collect()}
    assert got[5].n_turns == 2 and got[5].loss_chars == 14 and got[1].loss_chars == 0
    assert got[4].loss_sha256 == sha(edge_docs.where("doc_id = 4").first().text)


def test_a_delta_after_an_edit_stays_in_its_message(spark):
    log = [(1, "a", 1, "edit", "user", "Hi"), (1, "a", 2, "delta", "user", "!")]
    f = C.digests(C.format_log(spark.createDataFrame(log, EVENTS))).first()
    assert f.n_turns == 1 and f.turns_sha256 == sha("user\nHi!\n")
