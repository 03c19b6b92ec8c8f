"""SimHash near-duplicates with BK-trees (operator 9).

A fingerprint has a bit set where more than half of a text's shingles have it set in their hash. Two fingerprints
link if they differ in at most `radius` bits; documents are one group if links connect them.

1.  Equal fingerprints are one row from here on, with the smallest doc_id.
2.  Each fingerprint goes to one shard per table, by the value of some of its bits. `bands(radius)` is exact: of
    radius + 1 disjoint bands, two that link agree on one (so few differences can't touch them all), so some shard
    holds both.
3.  A shard with many fingerprints is split into blocks of bounded size; every block meets itself and every later
    block. Of such a pair, one block is built into a BK-tree (children keyed by their Hamming distance to the parent)
    and the other is looked up in it, following only the edges within the radius. The trees of many small shards
    grow and are searched together, a level at a time.
4.  What a pair of blocks finds is joined at once, and leaves as one edge per fingerprint to the first one of its
    group there, so that a group of n never gives n * n links.
5.  Connected components over those edges, by rounds of joins; each round is written to the shared folder.

No task holds more than two blocks of a shard, and nothing about single documents reaches the driver.

`keep_first` is the stage for pipelines: the same shingles, fingerprints and radius, one document of each group.

Null text: no words, fingerprint zero, linked like any other. A null doc_id is larger than any other: its component is
the smallest known id of its group, or null. Repeated rows are documents of their own with the same doc_id (of which
`keep_first` keeps one). Texts may be of any length. No documents: no rows. Other columns of the input are not read
(`groups`) or passed on (`keep_first`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.llm.common import slices, stored, table, texts

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Most fingerprints of a block, on average.
BLOCK = 1024
#: Most (fingerprint, tree node) pairs that are looked at together.
FRONTIER = 1 << 21
BATCH_BYTES = 4 << 20

_BYTES_SET = np.array([[b >> (7 - i) & 1 for i in range(8)] for b in range(256)], np.int64)


def shingles(text: str, size: int) -> list[bytes]:
    """The runs of `size` words, repeats included; a shorter text is one shingle, one without words has none."""
    words = text.encode().lower().split()  # bytes: only A-Z, and only ASCII white space
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()][: max(1, len(words) - size + 1)]
    stops = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    return [joined[a:b] for a, b in zip(starts, stops)]


def fingerprint(text: str, size: int = SHINGLE, bits: int = BITS) -> bytes:
    """`bits` / 8 bytes, the highest bit first. Beyond 64 bits, each hash is mixed into further ones."""
    found = shingles(text, size)
    if not found:
        return bytes(bits // 8)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found))
    votes = []
    for word in range(bits // 64):
        if word:
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(word)
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(29)
        per_byte = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += [np.bincount(per_byte[:, i], minlength=256) @ _BYTES_SET for i in range(8)]
    return np.packbits(2 * np.concatenate(votes) > len(found)).tobytes()


def fingerprints(docs: DataFrame, size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows with a binary column `fp`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.names.index("text")
            for batch in slices(whole, at, BATCH_BYTES):
                found = pa.array([fingerprint(t, size, bits) for t in texts(batch.column(at))], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "fp"])

    rows = docs.withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fp", T.BinaryType())]))


# Links ---------------------------------------------------------------------------------------------------


def bands(radius: int = RADIUS, bits: int = BITS) -> list[np.ndarray]:
    """radius + 1 disjoint sets of bits: fingerprints that link agree on one of them."""
    return np.array_split(np.arange(bits), radius + 1)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class BkTrees:
    """BK-trees, one for each shard of `shard` (ascending): a node's child under d differs from it in exactly d bits."""

    def __init__(self, values: np.ndarray, shard: np.ndarray) -> None:
        self.values, self.width = values, 64 * values.shape[1] + 1
        new = np.r_[True, shard[1:] != shard[:-1]]
        self.roots = np.flatnonzero(new)
        at, todo = self.roots[np.cumsum(new) - 1], np.flatnonzero(~new)
        keys, children = [], []
        while len(todo):
            edge = at[todo] * self.width + distance(values[todo], values[at[todo]])
            taken, first, which = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(taken)
            children.append(todo[first])
            at[todo] = todo[first][which]
            todo = np.delete(todo, first)
        keys, children = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, children))
        order = np.argsort(keys)
        #: Edges by node and distance, in one key, and the child at the end of each.
        self.edges, self.children = keys[order], children[order]

    def within(self, wanted: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(which of `wanted`, node) of all nodes within the radius of a wanted value, in the tree below its root."""
        query, node, found = np.arange(len(wanted)), root, []
        while len(query):
            d = distance(wanted[query], self.values[node])
            near = d <= radius
            found.append((query[near], node[near]))
            low = np.searchsorted(self.edges, node * self.width + np.maximum(d - radius, 0))
            high = np.searchsorted(self.edges, node * self.width + np.minimum(d + radius, self.width - 1), "right")
            n = high - low
            query = np.repeat(query, n)
            node = self.children[np.arange(len(query)) + np.repeat(low - np.cumsum(n) + n, n)]
        return tuple(np.concatenate(x) for x in zip(*found))


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n, the first one that pairs (a, b) connect it to."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    return root


def stars(pairs: list[tuple[list[bytes], list[bytes], bool]], radius: int) -> list[tuple[bytes, bytes]]:
    """(fingerprint, first one that links connect it to) in each pair of blocks (left, right, whether it is one block)."""
    left = [v for one, _, _ in pairs for v in one]
    right = [v for _, other, same in pairs if not same for v in other]
    sizes = np.array([len(one) for one, _, _ in pairs])
    tree_of = np.repeat(np.arange(len(pairs)), sizes)
    values = left + right
    words = np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)
    trees = BkTrees(words[: len(left)], tree_of)
    asked = np.concatenate([np.repeat(i, len(one) if same else len(other)) for i, (one, other, same) in enumerate(pairs)])
    starts = np.cumsum([0, *sizes[:-1]])
    place = np.concatenate(
        [starts[i] + np.arange(len(one)) for i, (one, _, same) in enumerate(pairs) if same]
        + [np.zeros(0, np.int64)]
    )
    others = np.arange(len(left), len(values))
    same_of = np.array([same for *_, same in pairs])
    wanted = np.empty(len(asked), np.int64)
    wanted[same_of[asked]], wanted[~same_of[asked]] = place, others
    found = []
    cost = np.cumsum(sizes[asked])
    cuts = np.searchsorted(cost, np.arange(FRONTIER, cost[-1] + FRONTIER, FRONTIER), "right")
    for low, high in zip([0, *cuts], [*cuts, len(asked)]):
        if low < high:
            which, node = trees.within(words[wanted[low:high]], trees.roots[asked[low:high]], radius)
            found.append((wanted[low:high][which], node))
    a, b = (np.concatenate(x) for x in zip(*found))
    root = joined(len(values), a, b)
    return [(values[i], values[root[i]]) for i in np.flatnonzero(root != np.arange(len(values))).tolist()]


def links(fps: DataFrame, tables: list[np.ndarray], radius: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp` that connect just those which links connect."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0)
            bits = np.unpackbits(np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(len(values), -1), axis=1)
            for i, chosen in enumerate(tables):
                key = bits[:, chosen].astype(np.int64) @ (1 << np.arange(len(chosen), dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [values, pa.array(np.full(len(values), i, np.int32)), pa.array(key)], ["fp", "table", "bits"]
                )

    shards = fps.select("fp").mapInArrow(deal, "fp binary, table int, bits bigint")
    sized = shards.groupBy("table", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = shards.join(sized, ["table", "bits"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    mine = held.withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    # A fingerprint of block b is in the pairs (b, b), (b, later) and (earlier, b).
    one = F.col("block")
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(one, other).alias("first"), F.greatest(one, other).alias("second")),
    )
    rows = mine.select("table", "bits", "block", "fp", F.explode(met).alias("pair"))
    first = F.col("block") == F.col("pair.first")
    pairs = rows.groupBy("table", "bits", "pair").agg(
        F.collect_list(F.when(first, F.col("fp"))).alias("left"), F.collect_list(F.when(~first, F.col("fp"))).alias("right")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for r in zip(*(c.to_pylist() for c in batch.columns)) if r[0] and (len(r[0]) > 1 if r[2] else r[1])]
            edges = stars(rows, radius) if rows else []
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])

    same = F.col("pair.first") == F.col("pair.second")
    return pairs.select("left", "right", same.alias("same")).mapInArrow(meet, "a binary, b binary").distinct()


# Components ----------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that edges connect it to. Nodes without an edge are not among them.

    Rounds of two steps: every node tells its larger neighbours of its smallest one, then its
    smaller ones likewise, until each hangs on its root. Only a count of what changed reaches the driver.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while True:
        large = _star(now.union(now.select("b", "a")), keep="other > node")
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), keep=None)
        after = stored(small.distinct(), "edges")
        # Done when every edge leads to the one root of its upper end, which is nobody's upper end.
        inner = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        torn = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
        if inner.union(torn).isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def _star(edges: DataFrame, keep: str | None) -> DataFrame:
    """Each node's neighbours (those in `keep`, or all) and itself, linked to the smallest of them all."""
    pairs = edges.toDF("node", "other")
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    others = pairs if keep is None else pairs.filter(keep)
    linked = others.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    if keep is None:
        linked = linked.union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return linked.filter("a <> b")


def rooted(firsts: DataFrame, tables: list[np.ndarray], radius: int) -> DataFrame:
    """(fp, kept): for each distinct fingerprint, the least `first` of all that links connect it to."""
    roots = components(links(firsts, tables, radius)).select(F.col("node").alias("fp"), "root")
    hung = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = hung.groupBy("root").agg(F.min("first").alias("kept"))
    return hung.join(least, "root").select("fp", "kept")


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of each document: the smallest doc_id that links connect it to."""
    marked = fingerprints(docs.select(F.col("doc_id").cast("bigint"), "text"), size).select("doc_id", "fp")
    marked = stored(marked, "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    named = rooted(firsts, bands(radius), radius).withColumnRenamed("kept", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row with the smallest doc_id of each group of near-duplicates, with the columns of the input."""
    columns = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), "text")
    doc = F.col("row.doc_id")
    at = F.struct(doc.isNull().alias("unknown"), doc.alias("doc"), F.monotonically_increasing_id().alias("line"))
    rows = rows.withColumn("at", at)
    marked = stored(fingerprints(rows.select("row", "text", "at"), size).drop("text"), "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min("at").alias("first")), "distinct")
    kept = rooted(firsts, bands(radius), radius).select(F.col("kept").alias("at")).distinct()
    return marked.join(kept, "at", "left_semi").select(*(F.col("row")[c].alias(c) for c in columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
