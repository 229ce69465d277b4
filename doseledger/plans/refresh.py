"""A whole refresh: Bronze to report, Silver, gate, Gold, dimension and terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.operators.event_log import recorded
from doseledger.operators.ingest import ingest_csv, ingest_pages, read_committed
from doseledger.operators.practices import dim_practice
from doseledger.operators.quality import check_null_rates, veracity_report
from doseledger.operators.rollups import (
    drug_monthly_spend,
    drug_summary,
    month_partials,
    practice_leaderboard,
    table_counts,
)
from doseledger.operators.silver import month_range, silver
from doseledger.operators.tables import MONTH, backfill, publish, publish_silver, replace_months
from doseledger.operators.terms import top_terms
from doseledger.sources.ledger_csv import read_epd_csv


def build_gold(spark: SparkSession, silver_table: str, gold: str, months: tuple[str, str] | None = None) -> dict[str, int]:
    """Publish the three Gold tables; returns their row counts.

    They and the practice dimension derive from the partial aggregates in ``<gold>.month_partials``, laid out by month. After a change of some ``months`` of Silver
    (first, last) only these are read and aggregated again; the other partials are kept as they are.
    """
    partials = f"{gold}.month_partials"
    silver_rows = spark.table(silver_table)
    if months is None or not spark.catalog.tableExists(partials):
        publish(month_partials(silver_rows), partials, [MONTH])
    else:
        replace_months(month_partials(month_range(silver_rows, *months)), partials, *months)
    totals = spark.table(partials)
    tables = {
        f"{gold}.drug_summary": drug_summary(totals),
        f"{gold}.drug_monthly_spend": drug_monthly_spend(totals),
        f"{gold}.practice_leaderboard": practice_leaderboard(totals),
    }
    return {name: publish(df, name).rows for name, df in tables.items()}


def build_dimension(spark: SparkSession, gold: str) -> int:
    """Publish the practice dimension from the partials of :func:`build_gold`; returns its row count."""
    return publish(dim_practice(spark.table(f"{gold}.month_partials")), f"{gold}.dim_practice").rows


def backfill_gold(
    bronze: DataFrame, silver_table: str, gold: str, from_month: str, to_month: str, promoted: DataFrame | None = None
) -> dict[str, int]:
    """Re-derive a month range of Silver, then Gold and the dimension from the range's months and the other months' partials."""
    spark = bronze.sparkSession
    backfill(bronze, silver_table, from_month, to_month, promoted)
    built = build_gold(spark, silver_table, gold, (from_month, to_month))
    return built | {f"{gold}.dim_practice": build_dimension(spark, gold)}


def medallion_run(
    bronze: DataFrame,
    sections: DataFrame,
    silver_db: str,
    gold_db: str,
    log: str,
    promoted: DataFrame | None = None,
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """Refresh every table and return the row count of each.

    Every step logs its start and its end. A breached null limit stops the run before Gold is
    touched. Running again replaces every table with the same rows.
    """
    spark = bronze.sparkSession
    silver_name = f"{silver_db}.prescribing"
    gold_names = [f"{gold_db}.{t}" for t in ("drug_summary", "drug_monthly_spend", "practice_leaderboard")]
    with recorded(spark, log, "profile_bronze", ["bronze.prescribing"], [f"{silver_db}.veracity_report"]):
        publish(veracity_report(bronze), f"{silver_db}.veracity_report")
    with recorded(spark, log, "build_silver", ["bronze.prescribing"], [silver_name]):
        written = publish_silver(silver(bronze, promoted), silver_name, limits)
    with recorded(spark, log, "validate_silver", [silver_name], []):
        # counted by the write, not by a second scan
        check_null_rates(written.rows, written.nulls, limits)
    with recorded(spark, log, "build_gold", [silver_name], gold_names):
        build_gold(spark, silver_name, gold_db)
    with recorded(spark, log, "build_dimension", [silver_name], [f"{gold_db}.dim_practice"]):
        build_dimension(spark, gold_db)
    with recorded(spark, log, "extract_terms", ["bronze.pages"], [f"{gold_db}.top_terms"]):
        publish(top_terms(sections), f"{gold_db}.top_terms")
    names = {
        "veracity_report": f"{silver_db}.veracity_report",
        "silver": silver_name,
        **{n.split(".")[1]: n for n in gold_names},
        "dim_practice": f"{gold_db}.dim_practice",
        "top_terms": f"{gold_db}.top_terms",
    }
    return table_counts({k: spark.table(v) for k, v in names.items()}).select(
        F.col("table_name"), F.col("rows")
    )


def medallion_from_files(
    spark: SparkSession,
    csv_paths,
    page_lines: DataFrame,
    base: str,
    silver_db: str,
    gold_db: str,
    log: str,
    codes: DataFrame | None = None,
    promoted: DataFrame | None = None,
    limits: dict[str, float] | None = None,
    row_cap: int | None = None,
) -> DataFrame:
    """The whole way from source files and page documents to every table; returns the row count of each.

    Batches that break their contract are refused and reported (:func:`doseledger.operators.ingest.read_rejects`); the refresh goes on
    with the others and with what earlier runs have accepted.
    """
    records_base, pages_base = f"{base}/records", f"{base}/pages"
    with recorded(spark, log, "ingest_records", ["source.ledger_csv"], ["bronze.prescribing"]):
        ingest_csv(read_epd_csv(spark, csv_paths, codes, row_cap), records_base)
    with recorded(spark, log, "ingest_pages", ["source.pages"], ["bronze.pages"]):
        ingest_pages(page_lines, pages_base)
    bronze, sections = read_committed(spark, records_base), read_committed(spark, pages_base)
    return medallion_run(bronze, sections, silver_db, gold_db, log, promoted, limits)
