"""Approximate nearest neighbours by a permutation index (operator 6).

Nearness is the inner product. A vector is represented by its pivots in order of nearness: two vectors that are close
see the pivots in nearly the same order.

1.  `PIVOTS` vectors are drawn by a hash of their ids (the bounded sample that the index is fitted on). So that nearness
    by inner product is one by distance too, vectors get one more component that makes all of them as long as the
    longest one; for a query it is zero.
2.  Every vector is posted under each of its `PREFIX` nearest pivots, with the pivot's place in its order. The posts of
    a shard of vectors make one inverted file per pivot.
3.  A query goes through the files of its own nearest pivots and adds up, per vector, by how much less than the most
    possible the places differ (Spearman's footrule over the prefixes, a pivot outside a prefix counting as at its end).
4.  The `CANDIDATES` share of a shard with the smallest footrule is ranked again by the exact inner product in double
    precision. The nearest of all shards are the answer.

Equal vectors are indexed once, with the `most` + 1 smallest of their ids: no answer can hold a larger one. A shard's
vectors that tie with the last candidate are candidates as well, so nothing depends on the order of rows.

The query set goes against all shards in blocks of bounded size; a task holds one shard and one block. Every vector is
indexed. A share of each shard, not a fixed number, is ranked again, so recall doesn't fall as the table grows.

Vectors that are null, zero or hold a null or a component that isn't finite take no part, nor do rows with a null id
or another dimension than most rows. An id that repeats counts once, with its least vector. Ties go to the smaller
id. Fewer candidates than asked for: all of them. No vectors: no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import stored, table

PIVOTS, PREFIX = 256, 96
CANDIDATES, LEAST_CANDIDATES = 0.1, 200
NEAREST = 20
SHARD, QUERIES = 8192, 512
FOUND = "query_id bigint, vec_id bigint, score double"


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one finite vector that isn't zero per id, all of the most frequent dimension."""
    v = F.col("embedding").cast("array<double>")
    ordinary = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint"), v.alias("v")).filter("vec_id IS NOT NULL").filter(ordinary)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").head()
    if sizes is None:
        return rows
    return rows.filter(F.size("v") == sizes["n"]).groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct(vectors: DataFrame, most: int) -> DataFrame:
    """(v, ids): each vector once, with the `most` smallest of its ids in order.

    A batch sends a vector once with so many ids at most, so a vector that a third of all rows share is no hot spot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            data = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) + 0.0  # no -0.0
            _, first, of = np.unique(data.view(f"V{8 * data.shape[1]}").ravel(), return_index=True, return_inverse=True)
            order = np.lexsort((ids, of))
            starts = np.searchsorted(of[order], np.arange(len(first)))
            kept = order[np.arange(len(ids)) - starts[of[order]] < most]
            ends = np.r_[0, np.cumsum(np.bincount(of[kept]))].astype(np.int32)
            one = pa.ListArray.from_arrays(np.arange(0, data.size + 1, data.shape[1], np.int32)[: len(first) + 1], data[first].ravel())
            yield pa.RecordBatch.from_arrays([one, pa.ListArray.from_arrays(ends, ids[kept])], ["v", "ids"])

    found = vectors.select("vec_id", "v").mapInArrow(run, "v array<double>, ids array<bigint>")
    ids = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, most)
    return found.groupBy("v").agg(ids.alias("ids"))


def norm2(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)


def lengthened(v: np.ndarray, longest: float) -> np.ndarray:
    """One more component, that makes all rows as long as the longest one."""
    rest = np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0.0))
    return np.column_stack([v, rest])


def orders(v: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    return np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Per pivot the vectors of a shard that have it among their nearest, and how far before the end of their prefix."""

    def __init__(self, seen: np.ndarray, pivots: int) -> None:
        self.n, self.prefix = seen.shape
        flat = seen.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
        rows, gains = by_pivot // self.prefix, (self.prefix - by_pivot % self.prefix).astype(np.int32)
        self.files = [(rows[a:b], gains[a:b]) for a, b in zip(ends, ends[1:])]

    def footrule(self, seen: np.ndarray) -> np.ndarray:
        """The footrule distance between each vector's prefix and this one."""
        shared = np.zeros(self.n, np.int32)
        for place, pivot in enumerate(seen.tolist()):
            rows, gains = self.files[pivot]
            shared[rows] += np.minimum(gains, self.prefix - place)
        # Apart, two prefixes differ by all of their places; a shared pivot takes off twice what both have of it.
        return self.prefix * (self.prefix + 1) - 2 * shared


def nearest(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:most]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    most: int = NEAREST,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    candidates: float = CANDIDATES,
    shard: int = SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest vectors of each query (both inputs: vec_id, v)."""
    known = stored(distinct(vectors, most + 1), "distinct")
    count, longest = known.agg(F.count(F.lit(1)), F.max(norm2(F.col("v")))).first()
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    first = F.col("ids")[0]
    drawn = known.orderBy(F.xxhash64(first), first).limit(pivots).toPandas()
    sight = lengthened(np.array(drawn["v"].tolist()), longest)
    sight /= np.sqrt((sight * sight).sum(axis=1))[:, None]
    prefix = min(prefix, len(sight))

    shards = -(-count // shard)
    rows = known.groupBy(F.pmod(F.xxhash64(first), F.lit(shards)).cast("int").alias("shard")).agg(
        F.collect_list(F.struct("ids", "v")).alias("vectors")
    )
    asked = queries.groupBy(F.pmod(F.xxhash64(F.col("vec_id") + 1), F.lit(-(-queries.count() // QUERIES) or 1)).alias("block"))
    blocks = asked.agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    blocks = blocks.select("queries", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    met = stored(rows, "shards").join(blocks, "shard").select("shard", "vectors", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, files, ids, of, data = None, None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                if name != known:
                    lists, data = _arrays(batch.column(1)[i].values, "ids")
                    ids, of = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
                    files = InvertedFiles(orders(lengthened(data, longest), sight, prefix), len(sight))
                    known = name
                asking, wanted = _arrays(batch.column(2)[i].values, "vec_id")
                seen = orders(np.column_stack([wanted, np.zeros(len(wanted))]), sight, prefix)
                again = min(len(data), max(LEAST_CANDIDATES, round(candidates * len(data))))
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for query, v, order in zip(asking.to_numpy(), wanted, seen):
                    apart = files.footrule(order)
                    near = np.flatnonzero(apart <= np.partition(apart, again - 1)[again - 1])
                    scores = (data[near] * v).sum(axis=1)
                    # One more than asked for, as the query itself may be the first id of one of them.
                    best = nearest(scores, ids[of[near]], most + 1)
                    spans = [ids[of[k] : of[k + 1]] for k in near[best]]
                    scores, found = np.repeat(scores[best], [len(x) for x in spans]), np.concatenate(spans)
                    scores, found = scores[found != query], found[found != query]
                    best = nearest(scores, found, most)
                    out.append((np.full(len(best), query), found[best], scores[best]))
                columns = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _arrays(structs: pa.StructArray, name: str) -> tuple[pa.Array, np.ndarray]:
    """A field of structs, and their vectors as rows."""
    return structs.field(name), structs.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(structs), -1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(valid(table(spark, sf_dir, "embeddings")), "vectors")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))
