"""Hard-negative mining by a secondary-sort shuffle (operator 12).

Components become integers, floor(256 * x), and a row's score for an anchor is the inner product of the integers. The
positives of an anchor are the first rows of its label; each opens a window of scores between two shares of its own, and
the first rows of other labels inside the window are its hard negatives. Higher scores come first, then smaller ids.

1.  Rows lie in groups by a hash of their id, a group's vectors take about 64 MB. One task holds a group and streams all anchors
    past it, in blocks; it scores a block against a shard of rows at a time, so all rows meet all anchors and no pair outlives
    its shard. For each anchor it keeps the first rows of the same label, and only what beats these is looked at. The first
    of all groups are the positives.
2.  With the positives known, a task keeps for each anchor the first rows of each window in the same way: all that can be
    among the negatives. What leaves a task is a few rows for each anchor, so it grows with anchors times groups.
3.  Positives and these rows become keys of 25 bytes, (anchor, descending score, kind, id), whose order as bytes is the
    order of the stream. A shuffle brings them together by anchor and sorts them as bytes.
4.  An iterator runs through the keys. A positive opens its window, a negative goes to the windows that hold its
    score and aren't full. It holds an anchor's open windows, never its rows.

Scores of all rows with all anchors are the job: its time grows with the square of the table. Vectors are shuffled twice, as
whole numbers in as few bytes as hold them; anchors go to each group and their best rows come from each, which is a square too, if a small one.

At one score positives come before negatives, so a window holds whatever ties with the row that opened it. A window of
a negative score is empty. Scores are exact integers: sums that a double can't hold are formed by Python's own, and a
score beyond 64 bits shows as the end of their range.

Rows with a null id, label or vector, or a null or non-finite component take no part, nor do rows of another
dimension than most rows have. An id that repeats counts once, with its least label and vector. Fewer positives or
negatives than asked for: all there are; a positive without negatives, or an anchor without positives, has no row. No
rows: none. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from shelfline.llm.common import stored, table

POSITIVES, NEGATIVES = 5, 10
LEAST_SHARE, MOST_SHARE = 30, 90  # hundredths of the positive's score
SCALE = 256.0
SHARD, ANCHORS = 4096, 512
GROUP, CELLS = 64 << 20, 1 << 19  # bytes of the vectors that a task holds; scores that it holds at once
GOLDEN = 0x9E3779B97F4A7C15
PARCEL = "part int, kind int, type string, ids binary, labels binary, v binary, low binary, high binary"
FOUND = "anchor_id bigint, score bigint, vec_id bigint"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_SIGN, _MOST = 1 << 63, (1 << 63) - 1


def valid(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(vec_id, label, v): one vector per id, all of the most frequent dimension."""
    v = F.col(embedding)
    if vectors.schema[embedding].dataType != ArrayType(FloatType()):
        v = v.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), v.alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(finite(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").head()
    if sizes is None:
        return rows
    least = rows.filter(F.size("v") == sizes["n"]).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return least.select("vec_id", "row.label", "row.v")


def finite(v: Column) -> Column:
    """No component is null, NaN or infinite. Nothing runs per component: NaN is above all numbers, and whether an array
    with a null contains what it hasn't is unknown."""
    most = F.lit(float("inf"))
    return (F.size(v) == 0) | ((F.array_max(v) < most) & (F.array_min(v) > -most) & ~F.array_contains(v, most.cast("float")))


def whole(v: np.ndarray) -> np.ndarray:
    """Whole numbers, held at the largest double where the product is beyond it."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(SCALE * v))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond 64 bits are held at the ends of their range."""
    with np.errstate(over="ignore"):
        largest = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(anchors.shape[1], 1)
    return products(anchors, rows, float(largest))


def products(anchors: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """The scores, of a type that holds all of them; `largest`: what no sum of absolute products passes."""
    for kind, most in ((np.float32, 1 << 24), (np.float64, 1 << 53)):
        if largest < most:
            return anchors.astype(kind, copy=False) @ rows.astype(kind, copy=False).T
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in rows] for x in anchors], object)
    return np.clip(exact, -_MOST, _MOST).astype(np.int64).reshape(len(anchors), len(rows))


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest score of a negative to this positive."""
    return -(-LEAST_SHARE * positive // 100), MOST_SHARE * positive // 100


class Rows:
    """A group's rows as a task holds them, in order of id; those of a label are found by it."""

    def __init__(self, ids: list[np.ndarray], labels: list[np.ndarray], vectors: list[np.ndarray]) -> None:
        every = np.concatenate(ids)
        order = np.argsort(every, kind="stable")
        self.ids, self.labels = every[order], np.concatenate(labels)[order]
        self.largest = max(float(np.abs(v).max(initial=0)) for v in (x.astype(np.float64) for x in vectors))
        self.v = np.empty((len(every), vectors[0].shape[1]), np.float32 if self.largest <= 1 << 24 else np.float64)
        to, start = np.argsort(order, kind="stable"), 0
        while vectors:
            v = vectors.pop(0)
            self.v[to[start : start + len(v)]] = v
            start += len(v)
        self.by_label = np.argsort(self.labels, kind="stable")
        self.sorted_labels = self.labels[self.by_label]

    def of_label(self, label: int) -> np.ndarray:
        start, end = (np.searchsorted(self.sorted_labels, label, side) for side in ("left", "right"))
        return self.by_label[start:end]


def in_order(place: np.ndarray, score: np.ndarray, row: np.ndarray) -> np.ndarray:
    """By place, falling score and row: by one number where it fits, which is faster."""
    rows, most, least = int(row.max()) + 1, int(score.max()), int(score.min())
    if (int(place.max()) + 1) * (most - least + 1) * rows <= _MOST:
        return np.argsort((place * (most - least + 1) + (most - score)) * rows + row)
    return np.lexsort((row, -score, place))


def set_places(flags: np.ndarray) -> np.ndarray:
    """Where flags are set, few of many: eight are looked at together."""
    flat = flags.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    near = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).reshape(-1)
    return near[flat[near]]


class Best:
    """The first `most` rows of each anchor's windows, by falling score and then by id, from rows that come in order of id.

    `bar` is the score that a row has to pass: that of a full window's last row, as a later row of the same score has the
    greater id; else what lies just below the window.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int) -> None:
        self.bar, self.high, self.most = low - 1, high, most
        self.score = np.zeros((low.size, most), np.int64)
        self.row = np.full((low.size, most), -1)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.number = 0
        self._bounds()

    def _bounds(self) -> None:
        self.least, self.top = self.bar.min(axis=1, initial=_MOST), self.high.max(axis=1, initial=-_MOST - 1)

    def look(self, found: np.ndarray, rows: np.ndarray, barred) -> None:
        """Scores of all anchors with some rows; `barred` tells the pairs that don't count from an anchor's place and a row's."""
        inside = found > self.least.astype(found.dtype)[:, None]
        places = set_places(inside)
        if 50 * len(places) > inside.size:
            inside &= found <= self.top.astype(found.dtype)[:, None]
            places = set_places(inside)
        at, column = np.divmod(places, max(found.shape[1], 1))
        if not len(at):
            return
        score, row = found[at, column].astype(np.int64), rows[column]
        counts = ~barred(at, row)
        at, score, row = at[counts], score[counts], row[counts]
        windows = self.bar.shape[1]
        for k in range(windows):
            held = np.flatnonzero((score > self.bar[at, k]) & (score <= self.high[at, k]))
            if len(held):
                self.waiting.append((at[held] * windows + k, score[held], row[held]))
                self.number += len(held)
        if self.number > len(self.score):
            self.settle()

    def settle(self) -> None:
        """Rows that wait join their windows, and the bars rise."""
        if not self.waiting:
            return
        place, score, row = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.number = [], 0
        touched = np.unique(place)
        held = self.row[touched] >= 0
        place = np.concatenate([np.repeat(touched, held.sum(axis=1)), place])
        score, row = np.concatenate([self.score[touched][held], score]), np.concatenate([self.row[touched][held], row])
        order = in_order(place, score, row)
        place, score, row = place[order], score[order], row[order]
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        rank = np.arange(len(place)) - np.repeat(starts, np.diff(starts, append=len(place)))
        first = rank < self.most
        place, score, row, rank = place[first], score[first], row[first], rank[first]
        self.score[place, rank], self.row[place, rank] = score, row
        full = touched[self.row[touched, -1] >= 0]
        self.bar.reshape(-1)[full] = self.score[full, -1]
        self._bounds()

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the anchor, score and row, once for each pair."""
        self.settle()
        place, rank = np.nonzero(self.row >= 0)
        score, row = self.score[place, rank], self.row[place, rank]
        at = place // self.bar.shape[1] if len(place) else place
        _, once = np.unique(at * (row.max(initial=0) + 1) + row, return_index=True)
        return at[once], score[once], row[once]


def tiles(count: int, most: int) -> Iterator[slice]:
    """Parts of so many rows: few at first, while no bar has risen, then up to `most`."""
    start, size = 0, max(1, min(most, 256))
    while start < count:
        yield slice(start, min(start + size, count))
        start, size = start + size, min(most, 2 * size)


def first_of_label(a: dict, rows: Rows, most: int, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, scores and ids: for each anchor the first other rows of its label."""
    out = []
    for label in np.unique(a["labels"]):
        asking, same = np.flatnonzero(a["labels"] == label), rows.of_label(label)
        ids, vectors = a["ids"][asking], a["v"][asking]
        largest = float(np.abs(vectors).max(initial=0)) * rows.largest * max(vectors.shape[1], 1)
        best = Best(np.full((len(asking), 1), -_MOST), np.full((len(asking), 1), _MOST), most)
        for part in tiles(len(same), shard):
            best.look(products(vectors, rows.v[same[part]], largest), same[part], lambda at, row: ids[at] == rows.ids[row])
        at, score, row = best.found()
        out.append((ids[at], score, rows.ids[row]))
    return tuple(np.concatenate(x) for x in zip(*out))


def first_of_windows(a: dict, rows: Rows, most: int, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, scores and ids: for each anchor the first rows of other labels in the windows of its positives."""
    largest = float(np.abs(a["v"]).max(initial=0)) * rows.largest * max(a["v"].shape[1], 1)
    best, every = Best(a["low"], a["high"], most), np.arange(len(rows.ids))
    for part in tiles(len(every), max(1, min(shard, CELLS // len(a["ids"])))):
        same = lambda at, row: a["labels"][at] == rows.labels[row]
        best.look(products(a["v"], rows.v[part], largest), every[part], same)
    at, score, row = best.found()
    return a["ids"][at], score, rows.ids[row]


def matrix(rows: pa.Array, count: int) -> np.ndarray:
    """Vectors as whole numbers, of the least type that holds them."""
    v = whole(rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    largest = np.abs(v).max(initial=0)
    kind = next((t for t, most in (("<i2", 1 << 15), ("<f4", 1 << 24)) if largest < most), "<f8")
    return v.reshape(count, len(v) // count).astype(kind)


def bounds(positives: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of each anchor's positives, a column for each; empty ones hold no score."""
    most = max(map(len, positives), default=0)
    low, high = np.full((len(positives), most), _MOST), np.full((len(positives), most), -_MOST - 1)
    for i, of in enumerate(positives):
        for k, (least, greatest) in enumerate(map(window, of)):
            if least <= greatest:
                low[i, k], high[i, k] = least, greatest
    return low, high


def parcels(df: DataFrame, groups: int, most: int, kind: int) -> DataFrame:
    """Rows in binary parcels, of their group (`kind` 0), or anchors in blocks for all groups (1)."""

    names, types = zip(*(c.split() for c in PARCEL.split(", ")))
    schema = pa.schema([(n, {"int": pa.int32(), "string": pa.string()}.get(t, pa.binary())) for n, t in zip(names, types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = (batch.column(i).to_numpy().astype("<i8") for i in (0, 1))
            v, low, high = matrix(batch.column(2), len(ids)), np.zeros((len(ids), 0), "<i8"), np.zeros((len(ids), 0), "<i8")
            part = np.zeros(len(ids), np.int64)
            if kind:
                low, high = bounds(batch.column(3).to_pylist()) if batch.num_columns > 3 else (low, high)
            else:  # a task that runs again puts a row into the same group
                part = ((ids.astype(np.uint64) * np.uint64(GOLDEN) >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            starts = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist() + [len(ids)]
            lots = [order[at : min(at + most, end)] for start, end in zip(starts, starts[1:]) for at in range(start, end, most)]
            rows = ([int(part[x[0]]), kind, v.dtype.str, *(c[x].tobytes() for c in (ids, labels, v, low, high))] for x in lots)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    packed_rows = df.mapInArrow(run, PARCEL)
    if not kind:
        return packed_rows
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    return packed_rows.select(every.alias("part"), *names[1:])


def opened(row: dict) -> dict[str, np.ndarray]:
    """A parcel's arrays."""
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    v = np.frombuffer(row["v"], row["type"]).reshape(len(ids), -1) if row["v"] else np.zeros((len(ids), 0), row["type"])
    low, high = (np.frombuffer(row[c], "<i8") for c in ("low", "high"))
    windows = len(low) // len(ids)
    return {"ids": ids, "labels": labels, "v": v, "low": low.reshape(len(ids), windows), "high": high.reshape(len(ids), windows)}


def met(rows: DataFrame, anchors: DataFrame, first, most: int, shard: int, block: int, keyed: bool = False) -> DataFrame:
    """What `first` finds for each block of anchors in each group of rows: columns, or else keys of negatives."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d")).first()
    shards = -(-size["n"] // shard)
    groups = max(1, -(-size["n"] * size["d"] * 4 // GROUP), min(shards, 2 * rows.sparkSession.sparkContext.defaultParallelism))
    fields = [c for c in ("vec_id", "label", "v", "positives") if c in anchors.columns]
    held = parcels(rows.select("vec_id", "label", "v"), groups, shard, 0)
    lots = anchors.repartition(max(1, -(-anchors.count() // (8 * block)))).select(*fields)
    both = held.unionByName(parcels(lots, groups, block, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, parts, table = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["part"] != part:
                    part, parts, table = row["part"], [], None
                if row["kind"] == 0:
                    parts.append(opened(row))
                    continue
                if parts:
                    table, parts = Rows(*([p[c] for p in parts] for c in ("ids", "labels", "v"))), []
                if table is None:
                    continue
                a = opened(row)
                a["v"] = a["v"].astype(table.v.dtype if a["v"].dtype != np.dtype("<f8") else np.float64)
                at, score, ids = first(a, table, most, shard)
                if keyed:
                    yield pa.RecordBatch.from_arrays([packed_all(at, score, True, ids)], ["key"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (at, score, ids)], ["anchor_id", "score", "vec_id"])

    return both.repartitionById(groups, "part").sortWithinPartitions("part", "kind").mapInArrow(run, "key binary" if keyed else FOUND)


def packed(anchor: int, score: int, negative: bool, vec_id: int) -> bytes:
    """A key whose order as bytes is: anchor, falling score, positives first, id."""
    return struct.pack(">QQBQ", anchor + _SIGN, _MOST - score, negative, vec_id + _SIGN)


def packed_all(anchors: np.ndarray, scores: np.ndarray, negative: bool, ids: np.ndarray) -> pa.Array:
    """The same keys, of arrays."""
    keys = np.empty(len(anchors), [("anchor", ">u8"), ("fallen", ">u8"), ("negative", "u1"), ("id", ">u8")])
    keys["anchor"], keys["id"] = (x.astype(np.int64).view(np.uint64) + np.uint64(_SIGN) for x in (anchors, ids))
    keys["fallen"] = np.uint64(_MOST) - scores.astype(np.int64).view(np.uint64)
    keys["negative"] = negative
    ends = np.arange(len(keys) + 1, dtype=np.int32) * keys.itemsize
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())])


def unpacked(key: bytes) -> tuple[int, int, bool, int]:
    anchor, fallen, negative, vec_id = struct.unpack(">QQBQ", key)
    return anchor - _SIGN, _MOST - fallen, bool(negative), vec_id - _SIGN


def mined(keys: Iterator[bytes], most: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of the result from keys in order; at any moment only the open windows of one anchor are held."""
    current, windows = None, []
    for anchor, score, negative, vec_id in map(unpacked, keys):
        if anchor != current:
            current, windows = anchor, []
        if not negative:
            windows.append([vec_id, score, *window(score), 0])
            continue
        windows = [w for w in windows if w[2] <= score and w[4] < most]
        for w in windows:
            if score <= w[3]:
                w[4] += 1
                yield anchor, w[0], w[4], vec_id, w[1], score


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shard: int = SHARD,
    block: int = ANCHORS,
) -> DataFrame:
    """The hard negatives of each anchor's positives (both inputs: vec_id, label, v; unique ids)."""
    spark = rows.sparkSession
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = met(rows, anchors, first_of_label, positives, shard, block).withColumn("_rank", F.row_number().over(order))
    near = stored(near.filter(F.col("_rank") <= positives).drop("_rank"), "positives")
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("positives"))
    far = met(rows, stored(anchors.join(windows, "vec_id"), "windows"), first_of_windows, negatives, shard, block, keyed=True)

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([packed_all(*(batch.column(i).to_numpy() for i in (0, 1)), False, batch.column(2).to_numpy())], ["key"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        found = mined((key for batch in batches for key in batch.column(0).to_pylist()), negatives)
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds)], [c.split()[0] for c in MINED.split(", ")])

    keys = near.select("anchor_id", "score", "vec_id").mapInArrow(keys_of, "key binary").unionByName(far)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(tasks, F.substring("key", 1, 8)).sortWithinPartitions("key").mapInArrow(stream, MINED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = valid(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))
    rows = stored(rows, "vectors")
    return hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM whole AS a JOIN whole AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER hard AS INTEGER) AS rank, n.vec_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW hard AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER hard <= 10"""
