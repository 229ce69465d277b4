"""Versioned practice dimension (type 2) and point-in-time reads of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseledger.functions.months import month_start


def practice_versions(rows: DataFrame, impute_month_start: bool = True) -> DataFrame:
    """First and last date of each (practice, setting, ccg).

    ``rows`` is Silver or its :func:`~doseledger.operators.rollups.month_partials`. A record dated only by month counts as of the
    month's first day; without ``impute_month_start`` it has no date.
    """
    if "first_date" in rows.columns:
        first, last = F.col("first_date"), F.col("last_date")
        if impute_month_start:
            # least and greatest leave out NULLs
            undated = F.when(F.col("undated") > 0, month_start(F.col("year_month")))
            first, last = F.least(first, undated), F.greatest(last, undated)
    else:
        first = F.coalesce("date", month_start(F.col("year_month"))) if impute_month_start else F.col("date")
        last = first
    return rows.groupBy(F.col("row_id").alias("practice_id"), "setting", "ccg").agg(
        F.min(first).alias("first_seen"), F.max(last).alias("last_seen")
    )


def dim_practice(rows: DataFrame, impute_month_start: bool = True) -> DataFrame:
    """One row per version of a practice, valid from its first date to the next version's.

    Versions are distinct attribute combinations, so a practice that returns to earlier attributes
    keeps its first version. The window sees versions, not records.
    """
    by_age = Window.partitionBy("practice_id").orderBy(
        F.asc_nulls_last("first_seen"), F.asc_nulls_last("setting"), F.asc_nulls_last("ccg")
    )
    return (
        practice_versions(rows, impute_month_start)
        .select(
            "practice_id",
            "setting",
            "ccg",
            F.col("first_seen").alias("valid_from"),
            F.lead("first_seen").over(by_age).alias("valid_to"),
            F.row_number().over(by_age).alias("version_num"),
        )
        .withColumn("is_current", F.col("valid_to").isNull())
        .orderBy(F.asc_nulls_last("practice_id"), F.asc_nulls_last("valid_from"), "version_num")
    )


def _valid_at(dim: DataFrame, at: Column) -> Column:
    return (dim["valid_from"] <= at) & (dim["valid_to"].isNull() | (dim["valid_to"] > at))


def pit_lookup(dim: DataFrame, at, practice_id: str | None = None) -> DataFrame:
    """Versions valid on a date, for one practice or all."""
    rows = dim.filter(_valid_at(dim, F.lit(at).cast("date")))
    return rows if practice_id is None else rows.filter(F.col("practice_id") == practice_id)


def pit_join(facts: DataFrame, dim: DataFrame, impute_month_start: bool = True) -> DataFrame:
    """Every fact with the attributes its practice had on its date, and whether there were any (``has_version``).

    Versions and the distinct days that facts ask for stand in one order per practice, and the last version is carried forward to the
    days behind it. So a practice costs its days and versions, not their product, however many facts it holds; the facts then
    meet their day by an equality that adaptive execution can split. Versions of a practice must not overlap.

    A fact known by month only counts as of the month's first day, or has no date without ``impute_month_start``. Facts without a date,
    practice or version are kept.
    """
    at = F.col("date")
    if impute_month_start:
        at = F.coalesce(at, month_start(F.col("year_month")))
    dated = facts.withColumn("__at", at)
    days = dated.select(F.col("row_id").alias("practice_id"), "__at").dropna().distinct()
    version = F.struct(F.col("setting").alias("setting_then"), F.col("ccg").alias("ccg_then"), "valid_to", "version_num")
    line = (
        dim.filter(F.col("valid_from").isNotNull())
        .select("practice_id", F.col("valid_from").alias("__at"), version.alias("__v"))
        .unionByName(days, allowMissingColumns=True)
    )
    # a version holds on its first day already, so it comes before the day
    order = Window.partitionBy("practice_id").orderBy("__at", F.col("__v").isNull(), "__v.version_num")
    carried = line.withColumn("__last", F.last("__v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    answers = carried.filter(F.col("__v").isNull() & F.col("__last").isNotNull()).filter(
        F.col("__last.valid_to").isNull() | (F.col("__last.valid_to") > F.col("__at"))
    ).select("practice_id", F.col("__at").alias("__day"), "__last")
    joined = dated.join(answers, (dated["row_id"] == answers["practice_id"]) & (dated["__at"] == answers["__day"]), "left")
    return joined.select(
        *[dated[c] for c in facts.columns],
        *[F.col(f"__last.{c}").alias(c) for c in ("setting_then", "ccg_then", "version_num")],
        F.col("__last").isNotNull().alias("has_version"),
    )


def version_gap_check(dim: DataFrame) -> DataFrame:
    """Versions whose end differs from the start of the next one; empty when all is well."""
    chain = Window.partitionBy("practice_id").orderBy("version_num")
    return (
        dim.withColumn("next_from", F.lead("valid_from").over(chain))
        .withColumn("has_next", F.lead("version_num").over(chain).isNotNull())
        .filter(F.col("has_next") & ~F.col("valid_to").eqNullSafe(F.col("next_from")))
        .select("practice_id", "version_num", "valid_to", "next_from")
    )


def version_counts(dim: DataFrame) -> DataFrame:
    """Versions, practices, current, closed and changed versions in one row."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_versions"),
        F.count_distinct("practice_id").alias("unique_practices"),
        F.count_if("is_current").alias("current_versions"),
        F.count_if(~F.col("is_current")).alias("historical_versions"),
        F.count_if(F.col("version_num") > 1).alias("changed_versions"),
    )


def current_uniqueness(dim: DataFrame) -> DataFrame:
    """Practices that do not have exactly one current version."""
    return (
        dim.groupBy("practice_id")
        .agg(F.count_if("is_current").alias("current_rows"))
        .filter(F.col("current_rows") != 1)
    )
