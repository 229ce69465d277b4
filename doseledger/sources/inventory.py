"""What a lake holds: files with sizes, and partitions per medicine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.session import path_exists

_EMPTY = "drug string, file string, size_bytes bigint, size_kb double"


def _files(spark: SparkSession, base: str) -> DataFrame:
    """Path parts and lengths; file contents are never read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath().rstrip("/") + "/"
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
        .select("path", "length")
    )
    inside = F.substring_index("path", root, -1)
    return listing.select(
        F.regexp_extract(inside, r"^(?:drug=)?([^/]+)/", 1).alias("drug"),
        F.regexp_replace(inside, r"^[^/]+/", "").alias("file"),
        F.col("length").alias("size_bytes"),
    ).filter(F.col("drug") != "")


def lake_inventory(spark: SparkSession, base: str) -> DataFrame:
    """One row per file below a medicine's folder; files lying directly in the base are ignored."""
    if not path_exists(spark, base):
        return spark.createDataFrame([], _EMPTY)
    return _files(spark, base).withColumn("size_kb", F.bround(F.col("size_bytes") / 1024, 1))


def lake_partitions(spark: SparkSession, base: str) -> DataFrame:
    """Month partitions and flat files per medicine, as sorted lists."""
    files = _files(spark, base)
    month = F.regexp_extract("file", r"^(?:resource=)?([^/]+)/", 1)
    flat = F.when(~F.col("file").contains("/"), F.col("file"))
    return (
        files.groupBy("drug")
        .agg(
            F.array_sort(F.collect_set(F.nullif(month, F.lit("")))).alias("partitions"),
            F.array_sort(F.collect_set(flat)).alias("flat_files"),
        )
    )


