"""Merkle manifest of a dataset, with proofs by pointer jumping.

A leaf is the SHA-256 of a row's fields. Per source the leaves, in id order, are
hashed by runs of three, level by level, to one subroot; the subroots, in source
order, likewise to the root. A node holds the segment towards its parent: the
digests of its run, joined, with ``x`` in its own place. In each round the
nodes join the nodes they point at, append that segment (``;`` between levels)
and take over the pointer, so the distance doubles until every leaf has reached
the root; a tree of n leaves takes about log2(log3(n)) rounds. Without ``x`` and
``;`` a segment is the proof's siblings from left to right; with ``x`` replaced
by a digest it is what the next level hashes.

Leaves are numbered by ranges of (source, id), so a source of any size is spread.
A run has three nodes, and a node is pointed at from 3, 9, 81, ... leaves by
round; the nodes pointed at are as many times fewer, and are broadcast once
their number times the length of their segments is within ``BROADCAST`` bytes.
Each level and each round is written to the shared scratch folder.

Cases: null fields are ``-`` (an empty text is ``0:``). A null source is a source,
the first; null ids come first. Equal ids are ordered by their leaves; equal rows
have equal leaves and proofs by their places. A lone leaf is its subroot, a lone
subroot the root; a document that is both has an empty proof. An empty table
gives no rows. Whole texts are hashed. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_crc, numbered

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST = 8 << 20
TOP = -1     # the tree over the subroots
NOWHERE = -2


def field(value: Column) -> Column:
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(values[f]) for f in FIELDS]), 256)


def tampered(text: Column) -> Column:
    """What the check does to some texts: the line breaks go."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def leaves(docs: DataFrame, changed: Column, becomes: Column) -> DataFrame:
    """doc_id, source, leaf, and ``altered``: the leaf of the text ``becomes`` where
    ``changed`` holds."""
    values = {f: F.col(f) for f in FIELDS}
    return docs.select("doc_id", "source", leaf(values).alias("leaf"),
                       F.when(changed, leaf(values | {"text": becomes})).alias("altered"))


def _families(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, level, at, n, of, digest, doc_id, altered) -> runs with their
    parents: up (the parent's number), n (nodes of the parent's level), digest."""
    kid = F.struct("at", "digest", "of", "level", "doc_id", "altered")
    runs = nodes.groupBy("tree", F.floor(F.col("at") / ARITY).cast("long").alias("up")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"), F.max("n").alias("below"))
    return runs.select("tree", "up", "kids", F.ceil(F.col("below") / ARITY).cast("long").alias("n"),
                       F.sha2(F.array_join("kids.digest", ""), 256).alias("digest"))


def _steps(families: DataFrame, level: int) -> DataFrame:
    """Every node of a level with its pointer to the parent and the segment there."""
    kids = families.select("tree", "up", "kids", F.posexplode("kids").alias("place", "kid"))
    segment = F.array_join(F.transform("kids", lambda k, i: F.when(i == F.col("place"), "x").otherwise(k["digest"])), "")
    own = F.col("tree") == TOP
    return kids.select(
        F.col("kid.of").alias("tree"), F.col("kid.level").alias("level"),
        F.when(own & (F.col("kid.of") != TOP), F.lit(0)).otherwise(F.col("kid.at")).cast("long").alias("at"),
        "kid.digest", "kid.doc_id", "kid.altered",
        F.col("tree").alias("up_tree"), F.lit(level + 1).alias("up_level"), F.col("up").alias("up_at"),
        segment.alias("path"))


def _grow(nodes: DataFrame, widest: int, scratch: Scratch, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels over ``nodes`` until every tree has one node: the steps of each
    level, and the nodes where trees end."""
    steps, ends, level = [], [], 0
    while widest > 1:
        ends.append(nodes.where("n = 1"))
        families = scratch.write(_families(nodes.where("n > 1")), f"{name}-{level}")
        steps.append(_steps(families, level))
        level, widest = level + 1, -(-widest // ARITY)
        nodes = families.select("tree", F.lit(level).alias("level"), F.col("up").alias("at"), "n",
                                F.col("tree").alias("of"), "digest",
                                *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in ("doc_id", "altered")])
    return steps, [*ends, nodes]


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _jump(paths: DataFrame, distance: int, most: int) -> DataFrame:
    """Every node takes over the pointer and appends the segment of the node it
    points at; a node that points at the root is done."""
    ahead = paths.where((F.col("tree") == TOP) | (F.col("level") >= distance)).select(
        F.col("tree").alias("t"), F.col("level").alias("l"), F.col("at").alias("a"),
        *[F.col(c).alias(f"next_{c}") for c in ("up_tree", "up_level", "up_at", "path")])
    if most * (130 * distance + 64) <= BROADCAST:
        ahead = F.broadcast(ahead)
    met = paths.join(ahead, (F.col("up_tree") == F.col("t")) & (F.col("up_level") == F.col("l"))
                     & (F.col("up_at") == F.col("a")), "left")
    on = F.col("t").isNotNull()
    # what is done points at a place of its own, where nothing is
    return met.select(
        "tree", "level", "at", "digest", "doc_id", "altered",
        F.when(on, F.col("next_up_tree")).otherwise(NOWHERE).cast("long").alias("up_tree"),
        F.when(on, F.col("next_up_level")).otherwise(F.col("level")).alias("up_level"),
        F.when(on, F.col("next_up_at")).otherwise(F.col("at")).alias("up_at"),
        F.when(on, F.concat("path", F.lit(";"), "next_path")).otherwise(F.col("path")).alias("path"))


def prove(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``leaves()`` -> per leaf: doc_id, source, leaf, altered, subroot, root, path
    (segments up to the root, empty where there are none)."""
    scratch = scratch or Scratch(rows.sparkSession, "merkle")
    rows = scratch.write(rows, "leaves")
    placed = numbered(rows, ["source", "doc_id", "leaf"], scratch, "placed", "place")
    sizes = scratch.write(placed.groupBy("source").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")),
                          "sizes")
    sources = numbered(sizes, ["source"], scratch, "sources", "tree")
    trees = sources.select(F.col("source").alias("_s"), "first", "n", "tree")
    nodes = placed.join(trees, F.col("source").eqNullSafe(F.col("_s"))).select(
        "tree", F.lit(0).alias("level"), (F.col("place") - F.col("first")).alias("at"), "n",
        F.col("tree").alias("of"), F.col("leaf").alias("digest"), "doc_id", "altered")
    many = sizes.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("widest"), F.sum("n").alias("all")).first()
    steps, ends = _grow(nodes, many["widest"] or 0, scratch, "level")
    subroots = scratch.write(_all(ends).where("n = 1"), "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), "level", F.col("tree").alias("at"),
                          F.lit(many["trees"]).cast("long").alias("n"), "of", "digest", "doc_id", "altered")
    over, last = _grow(top, many["trees"], scratch, "top")
    root = _all(last).where("n = 1").select(F.col("digest").alias("root"))  # one row
    if steps or over:
        paths, depth, distance = _all(steps + over), len(steps) + len(over), 1
        paths = scratch.write(paths, "paths-1")
        while distance < depth:
            # nodes from that level up, and the top tree
            most = 2 * many["all"] // ARITY ** distance + 2 * many["trees"]
            jumped = _jump(paths, distance, most)
            jumped = jumped.where((F.col("tree") == TOP) | (F.col("level") == 0) | (F.col("level") >= 2 * distance))
            paths = scratch.write(jumped, f"paths-{2 * distance}")
            scratch.drop(f"paths-{distance}")
            distance *= 2
        proofs = paths.where((F.col("level") == 0) & (F.col("tree") != TOP))
    else:
        proofs = nodes.withColumn("path", F.lit(""))
    found = proofs.select("tree", "at", F.col("digest").alias("leaf"), "doc_id", "altered", "path")
    ends = sources.select("tree", "source").join(
        subroots.select(F.col("tree").alias("_t"), F.col("digest").alias("subroot")), F.col("tree") == F.col("_t"))
    return (found.join(ends.drop("_t"), "tree").crossJoin(F.broadcast(root))
            .select("doc_id", "source", "leaf", "altered", "subroot", "root", "path"))


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    up = F.aggregate(F.split(path, ";"), digest, lambda h, s: F.sha2(F.replace(s, F.lit("x"), h), 256))
    return F.when(path == "", digest).otherwise(up)


def siblings(path: Column) -> Column:
    """The proof's digests, level by level, left to right, joined."""
    return F.translate(path, "x;", "")


def check(docs: DataFrame) -> DataFrame:
    """The manifest row of every document, and whether a copy of it that may have
    been tampered with still leads to the root."""
    altered = (F.pmod(id_crc(), F.lit(2)) == 0) & F.contains("text", F.lit("\n"))
    proofs = prove(leaves(docs, altered, tampered(F.col("text"))))
    folded = proofs.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
