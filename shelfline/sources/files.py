"""Parquet scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def scan_set(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan of a set that must exist: Spark raises PATH_NOT_FOUND otherwise."""
    return spark.read.schema(schema).parquet(path)


def scan_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan of a set that may be absent: then an empty set of the same schema."""
    if path_exists(spark, path):
        return scan_set(spark, path, schema)
    return spark.createDataFrame([], schema)


def scan_complete(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan of a set that must exist and have been written to its end."""
    if path_exists(spark, path) and not path_exists(spark, f"{path}/_SUCCESS"):
        raise ValueError(f"{path} was not written to its end")
    return scan_set(spark, path, schema)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in their declared types; a value that does not fit raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])
