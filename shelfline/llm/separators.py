"""Token counts by a separator scan (operator 4).

A flat token file holds the ids of many documents end to end, each ended by a separator id; it has no index and no
row boundaries. Here ids have `WIDTH` bytes, little-endian.

Files are cut into blocks of a fixed size, wherever documents end. Each block is searched for separators at once, as
an array. What a block can't know is where its first document began: a prefix scan over the blocks of a file gives how
many tokens and separators came before and where the last separator was, and stitches the pieces. Blocks are
summarised before the scan, so it moves positions of separators and no tokens.

Empty files have no rows, an empty document has a count of zero. Tokens after the last separator of a file are a
document with `closed` false. A file that isn't a whole number of ids stops the job. Null text is written as an empty
document. A document may be longer than a block, or span many. No documents: no rows. A file is read as one row, so a
writer should keep files below 1 GB (`DOCS_PER_FILE`); blocks bound everything after that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.llm import pieces
from shelfline.llm.common import scratch, slices, table, texts

WIDTH = 2
#: The id of `</s>`, which no text is encoded to.
SEPARATOR = 2
BLOCK_TOKENS = 1 << 18
DOCS_PER_FILE = 4000
BLOCKS = "file string, block int, tokens bigint, separators array<int>"


def write_token_files(
    docs: DataFrame, path: str, model: str, separator: int = SEPARATOR, docs_per_file: int = DOCS_PER_FILE
) -> None:
    """Flat token files of the texts' ids, without begin and end ids, each text ended by the separator.

    Spark's text sink writes rows as bytes, each followed by a line separator: here the bytes of ids, and of the
    separator id. Those must be ASCII, as the sink takes the separator as text.
    """
    ending = separator.to_bytes(WIDTH, "little")
    if not ending.isascii():
        raise ValueError("a separator whose bytes aren't ASCII can't be written")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces.codec(model)
        if own.size > 1 << 8 * WIDTH:
            raise ValueError(f"ids don't fit in {WIDTH} bytes")
        for whole in batches:
            for batch in slices(whole, 0, pieces.BATCH_BYTES):
                ids = (np.frombuffer(i, "<u4")[1:-1].astype("<u2").tobytes() for i in own.encode_batch(texts(batch.column(0))))
                yield pa.RecordBatch.from_arrays([pa.array(list(ids), pa.binary())], ["ids"])

    flat = docs.select(F.col("text").cast("string")).mapInArrow(run, "ids binary").select(F.col("ids").cast("string"))
    flat.write.option("lineSep", ending.decode()).option("maxRecordsPerFile", docs_per_file).text(path)


def read_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data): the bytes of each file in blocks."""
    size = block_tokens * WIDTH
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    starts = F.sequence(F.lit(0), F.floor((F.length("content") - 1) / size).cast("int"))
    cut = F.transform(starts, lambda i: F.substring(F.col("content"), i * size + 1, F.lit(size)))
    return files.select(F.col("path").alias("file"), F.posexplode(cut).alias("block", "data"))


def scan(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """(file, block, tokens, separators): how many ids a block has and which of them are separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for data in batch.column(2).to_pylist():
                if len(data) % WIDTH:
                    raise ValueError("a token file ends inside an id")
                ids = np.frombuffer(data, "<u2")
                counts.append(len(ids))
                found.append(np.flatnonzero(ids == separator))
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["file", "block", "tokens", "separators"],
            )

    return blocks.select("file", "block", "data").mapInArrow(run, BLOCKS)


def documents(blocks: DataFrame) -> DataFrame:
    """(file, doc_index, start, n_tokens, closed) of each document of scanned blocks, positions in ids."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumns(
        {
            "start": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
            "docs": F.coalesce(F.sum(F.size("separators")).over(before), F.lit(0)),
            "last_block": F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull(),
        }
    )
    placed = placed.withColumn("ends", F.expr("transform(separators, s -> start + s)"))
    placed = placed.withColumn("opened", F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1)) + 1)
    ended = placed.select(
        "file", "docs", "opened", "ends", F.posexplode("ends").alias("i", "end")
    ).select(
        "file",
        (F.col("docs") + F.col("i")).alias("doc_index"),
        F.coalesce(F.expr("get(ends, i - 1)") + 1, "opened").alias("start"),
        "end",
        F.lit(True).alias("closed"),
    )
    stop = F.col("start") + F.col("tokens")
    tail = placed.filter("last_block").select(
        "file",
        (F.col("docs") + F.size("separators")).alias("doc_index"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("opened")).alias("start"),
        stop.alias("end"),
        F.lit(False).alias("closed"),
    )
    found = ended.union(tail.filter(F.col("end") > F.col("start")))
    return found.select("file", "doc_index", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "closed")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as flat token files, and what a scan of them finds."""
    import public_tokenizers

    path = scratch(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("piece_bpe_32k.model"))
    found = documents(scan(read_blocks(spark, path)))
    name = F.concat_ws("", F.regexp_extract("file", r"/(part-\d+)-", 1), F.regexp_extract("file", r"(-c\d+)\.\w+$", 1))
    return found.withColumn("file", name)
