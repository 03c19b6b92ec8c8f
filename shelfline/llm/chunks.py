"""Substring deduplication by content-defined chunks (operator 10).

A gear rolling hash runs over the bytes of a text; a chunk ends where some bits of the hash are zero. The hash at a
byte depends on the `REACH` bytes up to it and on nothing else, so the same passage is cut at the same places wherever
it stands, and an insertion moves only the cuts next to it. A stretch without a cut is cut every `LONGEST` bytes from
its start. The bytes before a passage change its first cut, those after it its last one: about a chunk on either side
of a repeated passage isn't seen as repeated.

The first chunk of each digest (by doc_id, then place) stays, the others are copies. Copies that follow each other in a
text make a run, as long as each stood behind the one before it in an earlier place too: a chunk carries 32 bits of the
digest before it, so where that pair is new the run breaks, and snippets from unrelated documents don't join. A run of at least `LEAST_BYTES` is removed, shorter ones are common phrases and stay. Runs are cut back
to whole words, so what is left isn't torn.

A digest has 64 bits; a chunk that is wrongly taken for a copy matters only if its neighbours are as well. Of equal
chunks behind equal ones, only the first one of a batch of texts is shuffled by its digest; the others are copies in any
case and travel as one list per text: so a passage that a third of all documents share sends a row per batch. Then only
the numbers of copied chunks go back to their texts, where the cuts are found again.

Null text stays null and has no chunks; an empty text likewise. A text that is removed entirely becomes empty
(`deduplicated`) or its row goes (`drop_repeats`). Repeated rows are documents of their own, of which one keeps its text. A
null doc_id comes after all others. Texts may be of any length: a row's bytes and hashes are in memory together. No
documents: no rows. Other columns of the input are passed on, but for one of the name that the spans are given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import slices, stored, table

BITS = 5
REACH = 16
LONGEST = 256
#: About 15 words: a passage of 50 words keeps far more than that between the cuts around its ends.
LEAST_BYTES = 80
#: Stands for a null doc_id, after all others.
UNKNOWN = (1 << 63) - 1
BATCH_BYTES = 4 << 20

#: A 32-bit number for each byte, from a hash of it.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 10) for b in range(256)], np.uint32)
CHUNKS = "row bigint, doc bigint, digest bigint, behind int, at int, known array<int>"


def cuts(data: bytes, bits: int = BITS, longest: int = LONGEST) -> np.ndarray:
    """Where the chunks of a text end, the last one at its end."""
    if not data:
        return np.zeros(0, np.int64)
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < REACH:  # sums over 1, 2, 4, ... bytes, an older byte shifted further
        longer = rolled.copy()
        longer[width:] += rolled[:-width] << np.uint32(width)
        rolled, width = longer, 2 * width
    # The bits above the reach hold what all REACH bytes put there.
    ends = np.flatnonzero(rolled >> np.uint32(REACH - 1) & np.uint32((1 << bits) - 1) == 0) + 1
    ends = np.r_[ends[ends < len(data)], len(data)]
    starts = np.r_[0, ends[:-1]]
    more = (ends - starts - 1) // longest
    if more.any():
        wide = np.flatnonzero(more)
        inner = [np.arange(starts[i] + longest, ends[i], longest) for i in wide]
        ends = np.sort(np.concatenate([ends, *inner]))
    return ends


def chunked(rows: DataFrame, bits: int = BITS, longest: int = LONGEST) -> DataFrame:
    """The chunks of each row (row, doc, text): their digests, a part of the digest before, and their numbers in the text.

    Chunks whose pair of digests stood earlier in the batch are listed in `known`, one record per text, under a
    digest that spreads these records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, names = xxhash.xxh3_64_intdigest, [f.split()[0] for f in CHUNKS.split(", ")]
        for whole in batches:
            for batch in slices(whole, 2, BATCH_BYTES):
                lengths, digests = [], []
                for data in batch.column(2).cast(pa.binary()).to_pylist():
                    ends = cuts(data or b"", bits, longest).tolist()
                    lengths.append(len(ends))
                    digests += [digest(data[a:b]) for a, b in zip([0, *ends], ends)]
                row, doc = (np.repeat(batch.column(i).to_numpy(), lengths) for i in (0, 1))
                found = np.array(digests, np.uint64)
                at = (np.arange(len(found)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
                # At the start of a text there is nothing before: 0.
                behind = np.where(at > 0, np.r_[np.uint64(0), found[:-1]][: len(found)], np.uint64(0)).astype(np.uint32)
                order = np.lexsort((at, row, doc, behind, found))
                first = np.zeros(len(found), bool)
                by, before = found[order], behind[order]
                first[order] = np.r_[True, (by[1:] != by[:-1]) | (before[1:] != before[:-1])][: len(found)]
                none = pa.nulls(int(first.sum()), pa.list_(pa.int32()))
                arrays = row[first], doc[first], found.view(np.int64)[first], behind.view(np.int32)[first], at[first]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in arrays), none], names)
                of = row[~first]
                starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]][: len(of)])
                texts = of[starts]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(of)], pa.int32()), pa.array(at[~first]))
                spread = (texts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                last, zero = np.full(len(texts), UNKNOWN), np.zeros(len(texts), np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (texts, last, spread, zero, zero - 1)), lists], names)

    return rows.select("row", "doc", "text").mapInArrow(run, CHUNKS)


def copies(chunks: DataFrame) -> DataFrame:
    """(row, copied): the numbers of each text's chunks that stand earlier, there or elsewhere, in any order; of those that
    didn't stand behind the chunk before them there, the complement (so that a chunk takes four bytes)."""
    digest = Window.partitionBy("digest").orderBy("doc", "row", "at")
    pair = Window.partitionBy("digest", "behind").orderBy("doc", "row", "at")
    places = {"n": F.row_number().over(digest), "joined": F.row_number().over(pair) > 1}
    later = chunks.withColumns(places).filter("n > 1 OR known IS NOT NULL")
    own = F.when(F.col("joined"), F.col("at")).otherwise(F.bitwise_not("at"))
    found = F.coalesce("known", F.array(own)).alias("found")
    return later.select("row", found).groupBy("row").agg(F.flatten(F.collect_list("found")).alias("copied"))


def copied_spans(data: bytes, copied: np.ndarray) -> list[tuple[int, int, bool]]:
    """(start, stop, joined) of the chunks of a text whose numbers `copies` gives."""
    at = np.where(copied < 0, ~copied, copied)
    order = np.argsort(at)
    ends = np.r_[0, cuts(data)]
    return list(zip(ends[at[order]].tolist(), ends[at[order] + 1].tolist(), (copied[order] >= 0).tolist()))


def runs(spans: list[tuple], least: int) -> list[tuple[int, int]]:
    """Touching spans joined, those of at least `least` bytes. A span (start, stop, False) isn't joined to the one before."""
    out: list[list[int]] = []
    for start, stop, *joined in spans:
        if out and out[-1][1] == start and all(joined):
            out[-1][1] = stop
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out if b - a >= least]


_WHITE = re.compile(rb"[ \t-\r]")


def removed(data: bytes, spans: list[tuple], least: int = LEAST_BYTES) -> list[tuple[int, int]]:
    """What goes of a text: its runs, cut back to whole words."""
    out = []
    for start, stop in runs(spans, least):
        if start and not data[start - 1 : start].isspace():
            found = _WHITE.search(data, start, stop)
            start = found.end() if found else stop
        if stop < len(data) and not data[stop : stop + 1].isspace():
            while stop > start and not data[stop - 1 : stop].isspace():
                stop -= 1
        if start < stop:
            out.append((start, stop))
    return out


def deduplicated(docs: DataFrame, least: int = LEAST_BYTES, into: str = "removed") -> DataFrame:
    """The rows with what is left of their texts, and the (start, stop) bytes of the former text that went, in `into`."""
    columns = [c for c in docs.columns if c != into]
    kept = [F.col(f"`{c}`") for c in columns if c != "text"]
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(UNKNOWN)).alias("doc"),
            F.col("text").cast("string").alias("text"),
            F.struct(*kept).alias("others"),
        ),
        "rows",
    )
    marked = rows.join(copies(chunked(rows)), "row", "left").select("text", "copied", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0, BATCH_BYTES):
                left, gone = [], []
                copied = batch.column(1)
                stops = np.cumsum(pc.fill_null(pc.list_value_length(copied), 0).to_numpy()).tolist()
                numbers = copied.flatten().to_numpy()
                for data, a, b in zip(batch.column(0).cast(pa.binary()).to_pylist(), [0, *stops], stops):
                    spans = removed(data, copied_spans(data, numbers[a:b]), least) if a < b else []
                    at, parts = 0, []
                    for start, stop in spans:
                        parts.append(data[at:start])
                        at = stop
                    left.append(data if data is None else b"".join([*parts, data[at:]]).decode("utf-8", "replace"))
                    gone.append([{"start": start, "stop": stop} for start, stop in spans])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.string()), pa.array(gone, kind), batch.column(2)], ["text", "gone", "others"]
                )

    others = marked.schema["others"].dataType.simpleString()
    out = marked.mapInArrow(run, f"text string, gone array<struct<start:bigint,stop:bigint>>, others {others}")
    back = [F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in columns]
    return out.select(*back, F.col("gone").alias(into))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the passages that stand in earlier ones; a document of which no word is left goes."""
    mark = "_removed_spans"
    left = deduplicated(docs, into=mark)
    gone = (F.size(mark) > 0) & (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) == "")
    return left.filter(~gone).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its removed spans, how many bytes they hold, and a digest of what is left."""
    left = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return left.select(
        "doc_id",
        F.size("removed").cast("bigint").alias("n_spans"),
        gone.alias("removed_bytes"),
        F.transform("removed", lambda s: s["start"]).alias("span_starts"),
        F.transform("removed", lambda s: s["stop"]).alias("span_stops"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
        "text",
    )
