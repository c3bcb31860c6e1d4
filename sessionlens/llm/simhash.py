"""SimHash near-duplicates, linked through BK-trees.

A fingerprint has bit b set when over half of the text's shingle hashes (XXH64,
seed 42) have it. Equal fingerprints are one node. Two fingerprints at a
distance of at most ``radius`` agree on at least one of ``radius + 1`` blocks
of bits, so each node goes to one shard per block (block number and value) and
links are looked up within shards. A shard's BK-tree keys each child by its
integer Hamming distance to the parent; a lookup at distance d follows only
the edges from d - radius to d + radius. Trees of many shards are built and
searched together, level by level, in array operations.

A shard of more than ``SHARD`` nodes is split: first by blocks of its
remaining bits (lossless for the same reason), then into chunks of at most
about ``SHARD`` nodes, where the tree of every chunk is sent to, and searched
by, each chunk. So no task holds more than a bounded tree, no link is lost,
and what leaves a shard is a spanning forest, not its pairs. Components over
these links give the classes.

Cases: a null or empty text, or one without words, has fingerprint zero and
is linked like any other. Rows with a null id get the class of their
fingerprint (null when no row of the class has an id). Repeated rows and
equal ids fall into one class through their equal fingerprints. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Scratch, free_name, map_arrow, per_text
from .components import connected_components

SHINGLE = 3
RADIUS = 3
SHARD = 1024             # nodes in one tree, about
ROWS_AT_ONCE = 1 << 16   # rows whose trees are built together
QUERIES_AT_ONCE = 512

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the whole text; bytes.split cuts at 0x20 and 0x09-0x0D."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    h = np.fromiter((xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns plus ``fp``, the fingerprint as a signed long."""
    def kernel():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]
    return per_text(docs, kernel, [("fp", "long")], keep=keep, text=text)


# --- BK-trees ----------------------------------------------------------------

WIDTH = 65  # distances 0 to 64


def build_forest(tree: np.ndarray, fp: np.ndarray):
    """BK-trees of distinct fingerprints, one per value of ``tree`` (sorted).

    Returns the edges sorted by (parent, distance) as one code, and their
    children. Built level by level: the rows below a node are grouped by their
    distance to it, the first of each group becomes the child at that distance,
    the others go on below it."""
    first = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if len(tree) else np.zeros(0, int)
    at = np.repeat(first, np.diff(np.append(first, len(tree))))
    rows = np.arange(len(tree))
    rows, at = rows[rows != at], at[rows != at]
    codes, children = [], []
    while len(rows):
        code = at * WIDTH + np.bitwise_count(fp[rows] ^ fp[at])
        edge, lead, below = np.unique(code, return_index=True, return_inverse=True)
        codes.append(edge)
        children.append(rows[lead])
        new = rows[lead][below]
        rows, at = rows[new != rows], new[new != rows]
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, child = np.concatenate(codes), np.concatenate(children)
    order = np.argsort(code, kind="stable")
    return code[order], child[order]


def search_forest(code, child, fp, query_fp, root, radius):
    """(query, node) pairs within the radius, following only possible edges."""
    found = [(np.zeros(0, np.int64),) * 2]
    q, node = np.arange(len(query_fp)), root
    while len(q):
        d = np.bitwise_count(query_fp[q] ^ fp[node]).astype(np.int64)
        hit = d <= radius
        found.append((q[hit], node[hit]))
        low = np.searchsorted(code, node * WIDTH + np.maximum(d - radius, 0), "left")
        high = np.searchsorted(code, node * WIDTH + np.minimum(d + radius, WIDTH - 1), "right")
        n = high - low
        q, skip = np.repeat(q, n), np.repeat(np.cumsum(n) - n - low, n)
        node = child[np.arange(len(q)) - skip]
    return tuple(np.concatenate(x) for x in zip(*found))


def spanning(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> None:
    """Merge pairs into ``label`` (the smallest row reached so far), in place."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def shard_links(key: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int):
    """Links of a sorted run of whole shards as pairs (fingerprint, class leader).

    side 0: in the tree and looked up; 1: only in the tree; 2: only looked up."""
    label = np.arange(len(key))
    in_tree = np.flatnonzero(side != 2)
    looked = np.flatnonzero(side != 1)
    tree_key, tree_fp = key[in_tree], fp[in_tree]
    code, child = build_forest(tree_key, tree_fp)
    root = np.searchsorted(tree_key, key[looked], "left")
    there = (root < len(tree_key)) & (tree_key[np.minimum(root, len(tree_key) - 1)] == key[looked])
    looked, root = looked[there], root[there]
    for at in range(0, len(looked), QUERIES_AT_ONCE):
        some = looked[at:at + QUERIES_AT_ONCE]
        q, node = search_forest(code, child, tree_fp, fp[some], root[at:at + QUERIES_AT_ONCE], radius)
        a, b = some[q], in_tree[node]
        spanning(a[a != b], b[a != b], label)
    child_rows = np.flatnonzero(label != np.arange(len(label)))
    return fp[child_rows], fp[label[child_rows]]


def _link(shards: DataFrame, radius: int) -> DataFrame:
    """Rows (key, side, fp) -> links (a, b), shard by shard."""
    dealt = shards.repartition("key").sortWithinPartitions("key")

    def links(parts):
        got = pa.Table.from_batches(parts)
        key, side, fp = (got.column(c).to_numpy() for c in ("key", "side", "fp"))
        a, b = shard_links(key, side, fp.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                          names=["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                # the last shard may go on in the next batch
                key = batch.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1], "left")) if key[0] != key[-1] else 0
                if cut:
                    held[-1] = batch.slice(0, cut)
                    yield links(held)
                    held, rows = [batch.slice(cut)], batch.num_rows - cut
        if held:
            yield links(held)

    return map_arrow(dealt.select("key", "side", "fp"), run, "a long, b long")


def _blocks(fp: Column, widths: list[int], low: int = 0) -> list[Column]:
    out = []
    for width in widths:
        out.append(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)))
        low += width
    return out


def _widths(bits: int, parts: int) -> list[int]:
    return [bits // parts + (i < bits % parts) for i in range(parts)]


def links(nodes: DataFrame, scratch: Scratch, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links between distinct fingerprints (``fp``), enough to connect all that
    are within the radius of each other."""
    parts, fp = radius + 1, F.col("fp")
    widths = _widths(64, parts)
    ends = [sum(widths[:k + 1]) for k in range(parts)]
    # rest: the bits outside the block, in one number
    entries = [F.struct(F.lit(k).alias("block"), value.alias("value"),
                        (F.when(F.lit(ends[k] < 64), F.shiftleft(F.shiftrightunsigned(fp, min(ends[k], 63)),
                                                                 ends[k] - widths[k])).otherwise(F.lit(0))
                         .bitwiseOR(fp.bitwiseAND(F.lit((1 << (ends[k] - widths[k])) - 1)))).alias("rest"))
               for k, value in enumerate(_blocks(fp, widths))]
    first = (nodes.select("fp", F.explode(F.array(*entries)).alias("e"))
             .select("fp", "e.rest", F.xxhash64("e.block", "e.value").alias("key")))
    hot = scratch.write(first.groupBy("key").count().where(F.col("count") > shard), "hot")
    if hot.isEmpty():
        return _link(first.withColumn("side", F.lit(0)), radius)

    hot_keys = hot.select("key")
    cool = first.join(hot_keys, "key", "left_anti")
    rest_widths = _widths(64 - min(widths), parts)
    refined = (first.join(hot_keys, "key")
               .select("fp", F.posexplode(F.array(*_blocks(F.col("rest"), rest_widths))).alias("sub", "part"),
                       F.col("key").alias("above"))
               .select("fp", F.xxhash64("above", "sub", "part").alias("key")))
    refined = scratch.write(refined, "refined")
    dense = scratch.write(refined.groupBy("key").count().where(F.col("count") > shard), "dense")
    sparse = refined.join(dense.select("key"), "key", "left_anti")
    # a dense shard: every chunk's tree meets every chunk of lookups once
    chunks = F.ceil(F.col("count") / shard).cast("long")
    member = (refined.join(dense, "key")
              .withColumn("chunk", F.pmod(F.xxhash64("fp"), chunks)).withColumn("chunks", chunks))
    meets = member.select("fp", "key", "chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                     F.col("chunks") - 1)).alias("other"))
    pairs = meets.select(
        F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("key"),
        F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1)
        .otherwise(2).alias("side"), "fp")
    rows = [d.select("key", F.lit(0).alias("side"), "fp") for d in (cool, sparse)] + [pairs]
    return _link(rows[0].unionByName(rows[1]).unionByName(rows[2].select("key", "side", "fp")), radius)


def _classes(docs: DataFrame, keep, shingle: int, radius: int, shard: int, text: str):
    """The marked rows (``keep`` and fp), and per fingerprint: fp, label (of its
    class), component_id (the least id of the class)."""
    result, work = Scratch(docs.sparkSession, "simhash"), Scratch(docs.sparkSession, "simhash-work")
    marked = result.write(fingerprints(docs, shingle=shingle, text=text, keep=keep), "fingerprints")
    nodes = work.write(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    edges = work.write(links(nodes.select("fp"), work, radius, shard), "links")
    labels = connected_components(edges, work)
    labelled = (nodes.join(labels, nodes.fp == labels.node, "left")
                .select("fp", "least_id", F.coalesce("label", "fp").alias("label")))
    leaders = labelled.groupBy(F.col("label").alias("of")).agg(F.min("least_id").alias("component_id"))
    found = result.write(labelled.join(leaders, F.col("label") == F.col("of")).select("fp", "label", "component_id"),
                         "classes")
    work.drop()
    return marked, found


def classes(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD,
            text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest id reachable)."""
    marked, found = _classes(docs, ("doc_id",), shingle, radius, shard, text)
    return marked.join(found, "fp").select("doc_id", "fp", "component_id")


def drop_copies(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One row of each class stays: the one with the smallest id (null ids come
    last), of several texts of that id the one with the smallest digest, of rows
    equal in id and text one."""
    digest, fp = free_name(docs, "row_digest"), "fp"
    of_id, of_digest = free_name(docs, "copy_id"), free_name(docs, "copy_digest")
    named = docs.withColumn(digest, F.xxhash64("text"))
    ids = named.select("doc_id", F.col(digest).alias("digest"), "text")
    marked, labelled = _classes(ids, ("doc_id", "digest"), shingle, radius, shard, "text")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest")
    first = marked.groupBy(fp).agg(F.min(rank).alias("first"))  # of a fingerprint, then of its class
    least = (labelled.select(fp, "label").join(first, fp))
    kept = least.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("kept"))
    kept = least.join(kept, F.col("label") == F.col("of")).select(fp, "kept")
    found = marked.groupBy("doc_id", "digest", fp).agg(F.count(F.lit(1)).alias("rows")).join(kept, fp)
    stays = (F.col("kept.digest") == F.col("digest")) & F.col("kept.doc_id").eqNullSafe(F.col("doc_id"))
    # an id and a digest are one text, so one fingerprint and one class
    found = Scratch(docs.sparkSession, "simhash-kept").write(
        found.select(F.col("doc_id").alias(of_id), F.col("digest").alias(of_digest), stays.alias("stays"), "rows"), "rows")
    same = (F.col(digest) == F.col(of_digest)) & F.col("doc_id").eqNullSafe(F.col(of_id))
    gone = found.where("not stays")
    out = named.join(gone, same, "left_anti")
    again = found.where("stays and rows > 1").select(of_id, of_digest)
    if again.isEmpty():
        return out.select(*docs.columns)
    once = out.join(again, same, "left_anti").select(*docs.columns)
    one = out.join(again, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)
    return once.unionByName(one)
