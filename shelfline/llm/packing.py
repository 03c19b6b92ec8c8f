"""Packing of token sequences by non-negative least squares (operator 3).

Every document is its ids and one id that ends it. It is cut at multiples of the window; full windows are sequences
by themselves, and what is left over (1 to window - 1 ids) is packed with others:

1.  The left-over lengths of all documents are counted: a histogram of at most window - 1 bins.
2.  Shallow combinations that fill a window exactly (at most `DEPTH` pieces of at most two lengths) are enumerated.
3.  Non-negative least squares finds how often to repeat each, so that together they use up the histogram.
4.  The counts are rounded and held to what the histogram has.
5.  The residual pieces are laid end to end, longest first, each greedily filling the open sequence; one that doesn't
    fit is cut there. So only the very last sequence can be padded.

The plan depends on the histogram alone, and is all that the driver sees. Which piece goes where follows from its rank
among the pieces of its length: ranks are counted inside each input task and shifted by the counts of the tasks
before it, so a length that a third of all documents have is ranked without gathering its rows.

Sequences are numbered: full windows, combinations, residuals. Null text is empty and has the end id alone. Repeated
rows are documents of their own. A document of any length is one row while it is cut. No documents: no pieces. Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.llm import tokens
from shelfline.llm.common import slices, stored, table, texts

WINDOW = 2048
END_ID = 1
DEPTH = 4
SWEEPS = 60
BATCH_BYTES = 4 << 20

TOKENISED = "doc_id bigint, task int, rest int, place bigint, full int, full_before bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def tokenised(docs: DataFrame, vocabulary: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Per document: its ids, the number of full windows and left-over ids, and its place among its task's documents.

    `place` counts the task's documents with the same left-over length before this one, `full_before` the full windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = tokens.codec(vocabulary), TaskContext.get().partitionId()
        places, full_before = [0] * window, 0
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                rows = []
                for doc, ids in zip(batch.column(0).to_pylist(), own.encode_batch(texts(batch.column(1)))):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    full, rest = divmod(len(ids), window)
                    rows.append((doc, task, rest, places[rest], full, full_before, ids.tobytes()))
                    places[rest] += 1
                    full_before += full
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), _arrow(TOKENISED))], _names(TOKENISED)
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, TOKENISED)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _arrow(schema: str) -> list[pa.DataType]:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return [kinds[f.split()[1]] for f in schema.split(", ")]


# The plan ------------------------------------------------------------------------------------------------


def combinations(window: int, depth: int = DEPTH) -> list[tuple[tuple[int, int], ...]]:
    """All ways to fill a window with at most `depth` pieces of one or two lengths: ((length, pieces), ...)."""
    found = [((window // n, n),) for n in range(2, depth + 1) if window % n == 0]
    for m in range(1, depth):
        for n in range(1, depth - m + 1):
            for a in range(1, window // m + 1):
                b, off = divmod(window - m * a, n)
                if not off and b >= 1 and (a < b if m == n else a != b):
                    found.append(((a, m), (b, n)))
    return found


def least_squares(histogram: np.ndarray, combos: list[tuple[tuple[int, int], ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """How often to repeat each combination: x >= 0 that makes the pieces used come closest to the histogram.

    Coordinate descent: one count after the other takes its best value, given the others, and stops at zero.
    """
    left, x = histogram.astype(float).tolist(), [0.0] * len(combos)
    norms = [sum(m * m for _, m in c) for c in combos]
    scale = max(1.0, float(histogram.sum()))
    for _ in range(sweeps):
        moved = 0.0
        for j, combo in enumerate(combos):
            step = sum(m * left[a] for a, m in combo) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved += abs(step)
                for a, m in combo:
                    left[a] -= m * step
        if moved < 1e-4 * scale:
            break
    return np.array(x)


@dataclass(frozen=True)
class Plan:
    """Where the piece of each length and rank goes.

    runs: for each length the runs (first rank, sequence of the first, pieces of this length per sequence, offset of
    the first of them), by rank. used: how many ranks the runs of a length take; the residual ones of a length start
    at `line` on the line of all residual pieces, whose first sequence is `residual`.
    """

    window: int
    runs: dict[int, np.ndarray]
    used: np.ndarray
    line: np.ndarray
    residual: int
    sequences: int

    def places(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of the parts of a piece."""
        if rank < self.used[length]:
            runs = self.runs[length]
            first, sequence, each, offset = runs[np.searchsorted(runs[:, 0], rank, "right") - 1].tolist()
            row, at = divmod(rank - first, each)
            return [(0, length, sequence + row, offset + at * length)]
        at = int(self.line[length]) + (rank - int(self.used[length])) * length
        sequence, offset = divmod(at, self.window)
        fits = min(length, self.window - offset)
        parts = [(0, fits, self.residual + sequence, offset)]
        if fits < length:
            parts.append((fits, length - fits, self.residual + sequence + 1, 0))
        return parts


def plan(histogram: np.ndarray, first_sequence: int, window: int = WINDOW) -> Plan:
    """The plan for so many pieces of each length (index), with sequences numbered from `first_sequence`."""
    combos = combinations(window)
    wanted = least_squares(histogram, combos)
    left, used = histogram.astype(np.int64).copy(), np.zeros(window, np.int64)
    runs: dict[int, list] = {}
    sequence = first_sequence
    for j in np.argsort(-wanted, kind="stable").tolist():
        repeat = min(round(float(wanted[j])), *(int(left[a]) // m for a, m in combos[j]))
        if repeat <= 0:
            continue
        offset = 0
        for a, m in combos[j]:
            runs.setdefault(a, []).append((int(used[a]), sequence, m, offset))
            used[a] += m * repeat
            left[a] -= m * repeat
            offset += m * a
        sequence += repeat
    sizes = np.arange(window) * left
    line = np.zeros(window, np.int64)
    line[:-1] = sizes[::-1].cumsum()[::-1][1:]  # longer ones come first
    total = int(sizes.sum())
    return Plan(
        window, {a: np.array(r, np.int64) for a, r in runs.items()}, used, line, sequence, sequence + -(-total // window)
    )


# Packing -------------------------------------------------------------------------------------------------


def pack(ids: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces of stored `tokenised` rows, with the sequence and offset of each."""
    counted = ids.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("n"))
    before = counted.select(
        "task", "rest", (F.sum("n").over(Window.partitionBy("rest").orderBy("task")) - F.col("n")).alias("ranked_before")
    )
    windows = ids.groupBy("task").agg(F.sum("full").cast("bigint").alias("n"))
    histogram = np.zeros(window, np.int64)
    for row in counted.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[row["rest"]] = row["n"]
    total = windows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    made = plan(histogram, total, window)
    shifts = before.join(_windows_before(windows), "task")
    ranked = ids.join(shifts, ["task", "rest"]).select(
        "doc_id",
        "rest",
        (F.col("ranked_before") + F.col("place")).alias("rank"),
        "full",
        (F.col("windows_before") + F.col("full_before")).alias("first"),
        "ids",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, rest, rank, full, first, own in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(own) // 4
                parts = [(i * window, window, first + i, 0) for i in range(full)]
                if rest:
                    parts += [(full * window + s, k, q, o) for s, k, q, o in made.places(rest, rank)]
                rows += [(doc, s, k, own[4 * s : 4 * (s + k)], n, q, o) for s, k, q, o in parts]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _arrow(PIECES))], _names(PIECES))

    return ranked.mapInArrow(run, PIECES)


def _windows_before(windows: DataFrame) -> DataFrame:
    """How many full windows the tasks before each one have: sums within blocks of tasks, then over the blocks."""
    block = F.floor(F.col("task") / 1024)
    inside = F.sum("n").over(Window.partitionBy(block).orderBy("task")) - F.col("n")
    blocks = windows.groupBy(block.alias("block")).agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("blocks_before"))
    return (
        windows.select("task", block.alias("block"), inside.alias("inside"))
        .join(blocks, "block")
        .select("task", (F.col("inside") + F.col("blocks_before")).alias("windows_before"))
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence: its ids, padded to the window unless there are a power of two of them."""
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    n = F.col("n_tokens")
    full = F.when((n == window) | (F.bit_count(n) == 1), n).otherwise(window)
    hexes = F.array_join(F.transform("listed", lambda x: F.hex(x["ids"])), "")
    pad = F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (full - n).cast("int"))
    return (
        pieces.groupBy("sequence_id")
        .agg(listed.alias("listed"), F.sum("length").alias("n_tokens"))
        .select("sequence_id", "n_tokens", F.unhex(F.concat(hexes, pad)).alias("ids"))
    )


def packed(docs: DataFrame, vocabulary: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    return pack(stored(tokenised(docs, vocabulary, end_id, window), "tokenised"), window)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
