"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in
DataFrame functions only.

Sources get weights in turn, a share of all words is dealt to them by weight,
and no source is asked for more than ``most`` times what it has: what is over
is dealt again by weight to the others until no target is too high. A source is
first taken in complete epochs, every document once each. What is left of its
target is sampled without replacement: a document of quality w and uniform
number u has the exponential key -ln(u) / w, documents are taken by ascending
key while their sizes, added up, stay within what is left, and of the document
that crosses it only the first words that still fit are taken. So a source's
words meet its target to the word.

u comes from a digest of the id and the whole text, so reruns agree. Quality is
the share of characters that are no ASCII digits or punctuation, times the share of
distinct lines, 0.05 at least; any positive column can take its place.

No source is gathered: the place where the target is crossed is found by sums
per bucket of keys (some hundreds a source, each about 1/200 of it at most), then
per part of the one bucket it falls into, then per key in that part. Rows equal
in id and text have one key and are counted together; where they cross a target
they are numbered by ranges.

Cases: a null or empty text, or one without words, has size 0 and is taken 0
times. A null id is an id like any other (``-``). A null source is a source, the
last one. Rows equal in source, id and text share a key; any of them may be
the one that is cut. A source without words has target 0. Keys that tie are
ordered by id, then digest. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered

WEIGHTS = (3, 1, 2)
SHARE = 1.5   # of all words
MOST = 2      # epochs of a source
LEAST_QUALITY = 0.05
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
AFTER_WORD = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
NO_LETTER = r"[0-9!-/:-@\[-`{-~]"
PARTS = 1024  # of a bucket


def size(text: Column) -> Column:
    """Words of the whole text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    whole, lines = F.coalesce(text, F.lit("")), F.split(F.coalesce(text, F.lit("")), "\n")
    letters = F.length(F.regexp_replace(whole, NO_LETTER, "")) / F.greatest(F.length(whole), F.lit(1))
    return F.greatest(letters * (F.size(F.array_distinct(lines)) / F.size(lines)), F.lit(LEAST_QUALITY))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """In (0, 1), 52 bits of a digest."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"),
                    F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << 52)


def keyed(docs: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, digest (of the text), key."""
    text = F.col("text")
    weight = quality(text) if weight is None else weight
    return docs.select(
        "doc_id", "source", size(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
        (-F.log(uniform(F.col("doc_id"), text, seed)) / weight).alias("key"))


def targets(sizes: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """(source, source_size) -> those and ``target``. Each round asks every source
    for its weight's part of what the full ones leave over; the full ones only
    become more, so it ends."""
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], scratch, "ranked", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    dealt = scratch.write(ranked.select("source", "source_size", weight.alias("weight"),
                                        (F.col("source_size") * float(most)).alias("top")), "weights")
    total = (dealt.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * share
    rate, full = 0.0, -1
    while True:
        asked = F.col("weight") * rate
        here = dealt.agg(F.sum(F.when(F.col("top") <= asked, F.col("top")).otherwise(0.0)).alias("topped"),
                         F.sum(F.when(F.col("top") <= asked, 0.0).otherwise(F.col("weight"))).alias("open"),
                         F.count(F.when(F.col("top") <= asked, 1)).alias("full")).first()
        if here["full"] == full or not here["open"]:
            return dealt.select("source", "source_size", F.least(F.col("top"), asked).alias("target"))
        rate, full = (total - here["topped"]) / here["open"], here["full"]


def _crossed(sums: DataFrame, by: Sequence[str], left: str) -> DataFrame:
    """Of rows (source, ``by``, words, ``left``) the one per source where the
    words, added up in the order of ``by``, reach ``left``; ``left`` then says what
    the rows before do not cover."""
    order = Window.partitionBy("source").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("words").over(order)
    return (sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
            .where((F.col("before") < F.col(left)) & (F.col(left) <= F.col("upto")))
            .withColumn(left, F.col(left) - F.col("before")).drop("upto", "before", "words"))


def _same(a: DataFrame, b: DataFrame, *names: str):
    found = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        found &= a[n].eqNullSafe(b[n])
    return found


def mix(docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, digest, size, source_size, target
    (of its source), taken (words, repeats counted)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    place = F.log("key") * 64
    rows = (keyed(docs, weight, seed).withColumn("bucket", F.floor(place).cast("int"))
            .withColumn("part", F.floor((place - F.floor(place)) * PARTS).cast("int")))
    rows = scratch.write(rows, "keyed")
    sums = scratch.write(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "sums")
    asked = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), scratch, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    asked = scratch.write(asked.withColumn("epochs", epochs.cast("long")).withColumn(
        "left", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "asked")

    def per_source(table: DataFrame, left: DataFrame) -> DataFrame:
        of = left.select(F.col("source").alias("_s"), "left")
        return table.join(of, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    bucket = _crossed(per_source(sums, asked), ["bucket"], "left")
    near = rows.join(bucket, _same(rows, bucket, "source", "bucket"), "left_semi")
    near = scratch.write(near.withColumn("at", F.monotonically_increasing_id()), "near")
    part = _crossed(per_source(near.groupBy("source", "part").agg(F.sum("size").alias("words")), bucket),
                    ["part"], "left")
    part = scratch.write(part, "part")
    tie = ["key", "doc_id", "digest"]
    inside = near.join(part, _same(near, part, "source", "part"), "left_semi")
    groups = inside.groupBy("source", *tie, "size").agg(F.sum("size").alias("words"))
    edge = scratch.write(_crossed(per_source(groups, part), tie, "left"), "edge")

    # the rows at the edge, numbered by ranges of those written
    at_edge = near.join(edge, _same(near, edge, "source", *tie), "left_semi").withColumn("range", F.shiftright("at", 33))
    counts = at_edge.groupBy("source", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = counts.select(F.col("source").alias("_s"), F.col("range").alias("_r"), (F.sum("n").over(
        Window.partitionBy("source").orderBy("range")) - F.col("n")).alias("earlier"))
    within = F.row_number().over(Window.partitionBy("source", "range").orderBy("at")) - 1
    number = (at_edge.withColumn("within", within)
              .join(earlier, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
              .select("doc_id", "source", "digest", "size", (F.col("within") + F.col("earlier")).alias("number")))
    bounds = asked.join(edge.select(F.col("source").alias("_s"), F.struct(*tie).alias("edge"), F.col("left").alias("rest")),
                        F.col("source").eqNullSafe(F.col("_s")), "left")
    bounds = bounds.select(F.col("source").alias("_s"), "source_size", "target", "epochs", "edge", "rest")

    def taken(table: DataFrame, extra: Column) -> DataFrame:
        return (table.join(bounds, F.col("source").eqNullSafe(F.col("_s")))
                .select("doc_id", "source", "digest", "size", "source_size", "target",
                        (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken")))

    mine = F.struct(*tie)
    sure = rows.join(edge, _same(rows, edge, "source", *tie), "left_anti")
    whole = F.when(F.col("edge").isNotNull() & (mine < F.col("edge")), F.col("size")).otherwise(0)
    some = F.greatest(F.least(F.col("rest") - F.col("number") * F.col("size"), F.col("size")), F.lit(0))
    return taken(sure, whole).unionByName(taken(number, some))


def materialize(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The words the mix takes, as rows (source, doc_id, epoch, text): whole texts,
    and of the last copy the words that are taken, as they stand in the text.
    Rows equal in source, id and text are one document here."""
    key = ["source", "doc_id", "digest"]
    texts = (docs.select("source", "doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
             .groupBy(*key).agg(F.first("text").alias("text")))
    wanted = (mixed.where("taken > 0").groupBy(*key)
              .agg(F.sum("taken").alias("taken"), F.max("size").alias("size")))
    copies = texts.join(wanted, _same(texts, wanted, *key)).select(
        texts.source, texts.doc_id, "text", "size", "taken",
        F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("taken") / F.col("size")) - 1)).alias("epoch"))
    words = F.least(F.col("taken") - F.col("epoch") * F.col("size"), F.col("size"))
    head = F.array_join(F.slice(F.split("text", AFTER_WORD), F.lit(1), words.cast("int")), "")
    return copies.select("source", "doc_id", "epoch",
                         F.when(words == F.col("size"), F.col("text")).otherwise(head).alias("text"))
