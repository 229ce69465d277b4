"""Gold aggregates, Bronze profiles and report feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doseledger.functions.casting import round_half_away


def _totals(items: str = "items", cost: str = "actual_cost"):
    return (
        F.sum(items).alias("total_items"),
        round_half_away(F.sum(cost), 2).alias("total_cost_gbp"),
    )


def practice_months(silver: DataFrame) -> DataFrame:
    """Items and cost per medicine, practice and month.

    A refresh writes this once and derives every Gold table from it, so Silver is scanned and
    shuffled one time. The keys are fine enough to spread a dominant medicine or practice.
    """
    return silver.groupBy("drug", "row_id", "year_month").agg(
        F.sum("items").alias("items"), F.sum("actual_cost").alias("actual_cost")
    )


def month_partials(silver: DataFrame) -> DataFrame:
    """Sums, dates and undated records per medicine, practice, its attributes and month.

    All Gold tables and the practice dimension derive from these rows, and a month's rows depend on that month of Silver alone, so
    a change of some months needs only theirs again.
    """
    return silver.groupBy("drug", "row_id", "setting", "ccg", "year_month").agg(
        F.sum("items").alias("items"),
        F.sum("actual_cost").alias("actual_cost"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if(F.col("date").isNull()).alias("undated"),
    )


def drug_summary(rows: DataFrame) -> DataFrame:
    """Per medicine: items, cost, cost per item, practices and months, largest first.

    ``rows`` is Silver, its :func:`practice_months` or its :func:`month_partials`; all give the same result.
    """
    return (
        rows.groupBy("drug")
        .agg(
            *_totals(),
            round_half_away(
                F.sum("actual_cost") / F.nullif(F.sum("items"), F.lit(0)), 4
            ).alias("avg_nic_per_item"),
            F.count_distinct("row_id").alias("unique_practices"),
            F.count_distinct("year_month").alias("months_of_data"),
        )
        .orderBy(F.desc_nulls_last("total_items"), F.asc_nulls_last("drug"))
    )


def drug_monthly_spend(rows: DataFrame) -> DataFrame:
    """Items and cost per medicine and month."""
    return (
        rows.groupBy("drug", "year_month")
        .agg(*_totals())
        .orderBy(F.asc_nulls_last("drug"), F.asc_nulls_last("year_month"))
    )


def practice_totals(rows: DataFrame) -> DataFrame:
    """Items and cost per medicine and practice."""
    return rows.groupBy("drug", F.col("row_id").alias("practice_id")).agg(*_totals())


def practice_leaderboard(rows: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` practices with most items per medicine; ties go to the smaller practice id.

    The rank runs over totals, and each task drops all but its own first ``k`` per medicine before
    the shuffle, so a medicine's group stays small.
    """
    best = Window.partitionBy("drug").orderBy(
        F.desc_nulls_last("total_items"), F.asc_nulls_last("practice_id")
    )
    return (
        practice_totals(rows)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .orderBy(F.asc_nulls_last("drug"), "rank")
    )


def bronze_profile(bronze: DataFrame) -> DataFrame:
    """Per medicine: rows, first and last date as written, rows without cost."""
    return (
        bronze.groupBy("drug")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("earliest"),
            F.max("date").alias("latest"),
            F.count_if(F.col("actual_cost").isNull()).alias("null_cost_rows"),
        )
        .orderBy(F.asc_nulls_last("drug"))
    )


def icb_top_cost(bronze: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` commissioning bodies with the highest rounded cost."""
    return (
        bronze.filter(F.col("actual_cost").isNotNull())
        .groupBy(F.col("ccg").alias("icb_code"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            round_half_away(F.sum("actual_cost"), 2).alias("total_cost_gbp"),
            F.sum("items").alias("total_items"),
        )
        .orderBy(F.desc_nulls_last("total_cost_gbp"), F.asc_nulls_last("icb_code"))
        .limit(k)
    )


def avg_cost_per_item(bronze: DataFrame) -> DataFrame:
    """Unweighted mean of each row's cost per item, and rows lacking either value."""
    ratio = F.col("actual_cost") / F.nullif(F.col("items"), F.lit(0))
    return (
        bronze.groupBy("drug")
        .agg(
            round_half_away(F.avg(ratio), 4).alias("avg_cost_per_item_gbp"),
            F.count_if(F.col("actual_cost").isNull() | F.col("items").isNull()).alias("null_rows"),
        )
        .orderBy(F.desc_nulls_last("avg_cost_per_item_gbp"), F.asc_nulls_last("drug"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


def layer_reconcile(silver: DataFrame, summary: DataFrame) -> DataFrame:
    """Items in Silver against items in the summary, in one row."""
    sums = silver.select(F.col("items").alias("silver"), F.lit(None).cast("bigint").alias("gold")).unionByName(
        summary.select(F.lit(None).cast("bigint").alias("silver"), F.col("total_items").alias("gold"))
    )
    return sums.agg(
        F.sum("silver").alias("silver_items"), F.sum("gold").alias("gold_items")
    ).withColumn("balanced", F.col("silver_items").eqNullSafe(F.col("gold_items")))


def subset_check(leaderboard: DataFrame, silver: DataFrame) -> DataFrame:
    """Leaderboard practices that Silver does not have; empty when all is well."""
    known = silver.select(F.col("row_id").alias("practice_id")).distinct()
    return leaderboard.select("practice_id").distinct().join(known, "practice_id", "left_anti")


def top_cost_drugs(summary: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` medicines with the highest cost."""
    return (
        summary.select(
            "drug",
            "total_items",
            round_half_away(F.col("total_cost_gbp"), 2).alias("cost_gbp"),
            round_half_away(F.col("avg_nic_per_item"), 4).alias("cost_per_item"),
        )
        .orderBy(F.desc_nulls_last("cost_gbp"), F.asc_nulls_last("drug"))
        .limit(k)
    )


def cost_per_item_order(summary: DataFrame) -> DataFrame:
    """Medicines by cost per item, dearest first."""
    return summary.select(
        "drug", round_half_away(F.col("avg_nic_per_item"), 2).alias("cost_per_item")
    ).orderBy(F.desc_nulls_last("cost_per_item"), F.asc_nulls_last("drug"))


def chart_terms_feed(terms: DataFrame, drug: str, n: int = 8) -> DataFrame:
    """The first ``n`` terms of one medicine; empty for an unknown one."""
    return (
        terms.filter(F.col("drug") == drug)
        .select("term", "frequency", "page_type")
        .orderBy(F.desc("frequency"), F.asc_nulls_last("term"), F.asc_nulls_last("page_type"))
        .limit(n)
        .select("term", "frequency")
    )


def chart_trend_feed(monthly: DataFrame, drugs=None) -> DataFrame:
    """Monthly cost series of chosen (or all) medicines, in order; unknown ones are left out."""
    rows = monthly if not drugs else monthly.filter(F.col("drug").isin(list(drugs)))
    return rows.select("drug", "year_month", "total_cost_gbp").orderBy(
        F.asc_nulls_last("drug"), F.asc_nulls_last("year_month")
    )
