"""Physical plans hold what the design relies on."""

import os

from conftest import DATA
from pyspark.sql import functions as F

from doseledger.operators import rollups
from doseledger.operators.practices import dim_practice, pit_join
from doseledger.operators.silver import silver
from doseledger.operators.terms import top_terms
from doseledger.plans.catalogue import QUERIES
from doseledger.schemas import promoted_table
from doseledger.sources import sample_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bronze(spark):
    return sample_tables.records(spark, DATA)


def trusted(spark):
    return silver(bronze(spark), promoted_table(spark, sample_tables.PROMOTED))


def test_no_python_in_any_batch_plan(spark):
    for name in ("silver_build", "drug_summary", "dim_practice", "pit_join", "top_terms", "contract_records",
                 "src_html_sections", "veracity_report", "batch_numbering", "lineage_runs"):
        text = plan(QUERIES[name](spark, DATA))
        assert "Python" not in text and "Pandas" not in text, name


def test_silver_adds_no_shuffle(spark, tmp_path):
    bronze(spark).write.parquet(str(tmp_path / "b"))
    text = plan(silver(spark.read.parquet(str(tmp_path / "b")), promoted_table(spark, ["SMALL"])))
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastHashJoin" in text


def test_promoted_set_prunes_folders(spark, tmp_path):
    bronze(spark).write.partitionBy("drug").parquet(str(tmp_path / "b"))
    text = plan(silver(spark.read.parquet(str(tmp_path / "b")), promoted_table(spark, ["SMALL"])))
    assert "dynamicpruning" in text or "PartitionFilters: [isnotnull(drug" in text


def test_leaderboard_and_terms_prune_before_the_shuffle(spark):
    for df in (rollups.practice_leaderboard(trusted(spark)), top_terms(sample_tables.sections(spark, DATA))):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2
        assert "Partial" in text


def test_scan_reads_only_needed_columns(spark, tmp_path):
    trusted(spark).write.parquet(str(tmp_path / "s"))
    text = plan(rollups.drug_monthly_spend(spark.read.parquet(str(tmp_path / "s"))))
    assert "ReadSchema: struct<actual_cost:double,items:bigint,drug:string,year_month:string>" in text


def test_top_costs_sort_only_what_is_kept(spark):
    assert "TakeOrderedAndProject" in plan(rollups.icb_top_cost(bronze(spark)))


def test_large_dimension_is_not_broadcast(spark):
    facts = trusted(spark).select("row_id", "date", "year_month", "items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(pit_join(facts, dim_practice(trusted(spark))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastNestedLoop" not in text and "CartesianProduct" not in text


def test_no_cross_or_nested_loop_joins(spark):
    for name in ("layer_reconcile", "pit_join", "summary_terms_join", "subset_check", "contract_batch"):
        text = plan(QUERIES[name](spark, DATA))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_sources_name_no_forbidden_calls():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "doseledger")
    for folder, _, files in os.walk(root):
        for file in files:
            if file.endswith(".py"):
                text = open(os.path.join(folder, file)).read()
                assert "localCheckpoint" not in text and "crossJoin" not in text and "toPandas" not in text


def test_hot_month_is_split_on_write(spark, tmp_path):
    hot = spark.range(200000).select(F.lit("2024-01").alias("year_month"), F.col("id"), F.rand(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        hot.repartition(8).hint("rebalance", "year_month").write.partitionBy("year_month").parquet(str(tmp_path / "h"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(tmp_path / "h" / "year_month=2024-01") if f.startswith("part-")]
    assert len(files) > 1


def test_ledger_rows_travel_by_file_before_they_are_text(spark):
    rows = sample_tables.ledger_csv(spark, DATA, by_file=True)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    moved = text.index("RebalancePartitions")
    # the text is made above the move, the order is kept for the write
    assert text.index("SUB-") < text.index("Sort [resource") < moved
    plain = sample_tables.ledger_csv(spark, DATA).drop("PRACTICE_NAME")
    assert rows.select(*plain.columns).exceptAll(plain).isEmpty() and rows.count() == plain.count()
