"""What several operators share: tables of the sample, stored intermediate sets, memos of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shelfline.sinks.tables import shared_folder

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return. `bytes.split` cuts at exactly these.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares (spark.checkpoint.dir)."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a set to the shared folder and read it back: its rows are fixed and its lineage is cut.

    What follows reads files, so a lost executor costs the tasks it ran and nothing before them.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Memo(dict):
    """Results of a pure function by key, in two generations of at most `most` entries each.

    The younger one fills up, then becomes the older one and the former older one goes; an entry that is
    asked for again moves into the younger one. So memory is bounded and frequent keys stay.
    """

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most = most
        self.older: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that are in neither generation; those of the older one move up."""
        new, absent = self, []
        if len(new) > self.most:
            self.older = dict(new)
            new.clear()
        older = self.older
        for key in keys.difference(new):
            if key in older:
                new[key] = older[key]
            else:
                absent.append(key)
        return absent


def texts(column: pa.Array) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose strings hold about `most` bytes each; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)
