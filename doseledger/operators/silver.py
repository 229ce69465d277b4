"""Bronze records to the typed, trusted Silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseledger.functions.casting import (
    double_to_bigint,
    safe_ratio,
    text_to_bigint,
    text_to_double,
)
from doseledger.functions.months import iso_date, month_key
from doseledger.schemas import SILVER_COLUMNS, promoted_table


def _double(df: DataFrame, name: str) -> Column:
    text = isinstance(df.schema[name].dataType, T.StringType)
    return text_to_double(F.col(name)) if text else F.col(name).cast("double")


def _bigint(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_bigint(F.col(name))
    if isinstance(kind, T.FractionalType):
        return double_to_bigint(F.col(name).cast("double"))
    return F.col(name).cast("bigint")


def drop_both_null(bronze: DataFrame) -> DataFrame:
    """Leave out rows with neither cost nor items, judged on the raw values.

    A row whose values are present but unreadable stays, with NULLs in Silver.
    """
    return bronze.filter(F.col("actual_cost").isNotNull() | F.col("items").isNotNull())


def promote(bronze: DataFrame, promoted: DataFrame) -> DataFrame:
    """Keep promoted medicines. On a lake partitioned by drug this prunes folders at run time."""
    return bronze.join(promoted, "drug", "left_semi")


def tolerant_types(bronze: DataFrame) -> DataFrame:
    """Cast date, cost, items and quantity; what cannot be cast becomes NULL."""
    typed = bronze.select(
        F.col("date").alias("__written"),
        iso_date(F.col("date")).alias("date"),
        _double(bronze, "actual_cost").alias("actual_cost"),
        _bigint(bronze, "items").alias("items"),
        _double(bronze, "quantity").alias("quantity"),
        "row_id",
        "setting",
        "ccg",
        "drug",
    )
    return typed.withColumn("year_month", month_key(F.col("__written"), F.col("date"))).drop("__written")


def silver(bronze: DataFrame, promoted: DataFrame | None = None, stamp: Column | None = None) -> DataFrame:
    """Typed rows of promoted medicines with cost per item, month key and build time.

    Narrow from scan to output: one pass, no shuffle. Duplicate rows are kept.
    """
    if promoted is None:
        promoted = promoted_table(bronze.sparkSession)
    return (
        tolerant_types(promote(drop_both_null(bronze), promoted))
        .withColumn("nic_per_item", safe_ratio(F.col("actual_cost"), F.col("items")))
        .withColumn("ingested_at", F.current_timestamp() if stamp is None else stamp)
        .select(*SILVER_COLUMNS)
    )


def month_range(df: DataFrame, from_month: str, to_month: str) -> DataFrame:
    """Rows of an inclusive month window; prunes partitions of a table laid out by month."""
    return df.filter(F.col("year_month").between(from_month, to_month))


def strict_cast(bronze: DataFrame) -> DataFrame:
    """Cast the numeric fields and fail on a value that is none."""
    return bronze.withColumns(
        {
            "actual_cost": F.col("actual_cost").cast("double"),
            "items": F.col("items").cast("bigint"),
            "quantity": F.col("quantity").cast("double"),
        }
    )


def prescribing_frame(bronze: DataFrame) -> DataFrame:
    """All Bronze records, strictly cast, with cost per item and month key; nothing is filtered."""
    return (
        strict_cast(bronze)
        .withColumn("nic_per_item", safe_ratio(F.col("actual_cost"), F.col("items")))
        .withColumn("year_month", month_key(F.col("date")))
        .select(
            "date", "actual_cost", "items", "quantity", "row_id", "setting", "ccg", "drug",
            "nic_per_item", "year_month",
        )
    )
