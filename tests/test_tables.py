import os
import threading
import uuid

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.operators import event_log, tables
from doseledger.operators.quality import NullRateBreach, approx_report, month_sketches, veracity_report
from doseledger.operators.silver import silver
from doseledger.operators.tables import (
    backfill,
    backfill_proof,
    create_or_replace,
    ensure_database,
    publish,
    publish_silver,
)
from doseledger.plans import refresh
from doseledger.plans.refresh import medallion_run


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, str(tmp_path / "db"))
    return name


def _folders(tmp_path, table):
    return [d for d in os.listdir(tmp_path / "db") if d.startswith(table)]


def test_swap_replaces_the_table_and_its_files(spark, db, tmp_path, records):
    table = f"{db}.t"
    publish(records, table)
    before = spark.table(table)
    publish(records.limit(2), table)
    assert spark.table(table).count() == 2
    # planned before the swap, still whole
    assert before.count() == 6
    publish(records.limit(3), table)
    assert len(_folders(tmp_path, "t-")) == 2
    assert not spark.catalog.tableExists(f"{table}_new")


def test_swap_recovers_from_a_left_staging_table(spark, db, tmp_path, records):
    records.write.option("path", str(tmp_path / "db" / "left")).saveAsTable(f"{db}.t_new")
    publish(records, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 6


def test_failed_build_keeps_the_old_table(spark, db, records):
    publish(records, f"{db}.t")
    with pytest.raises(Exception):
        publish(records.withColumn("items", F.raise_error(F.lit("no"))), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 6


def test_create_or_replace(spark, db, records):
    create_or_replace(records, f"{db}.d")
    create_or_replace(records.limit(1).withColumn("more", F.lit(1)), f"{db}.d")
    assert spark.table(f"{db}.d").columns == [*records.columns, "more"]
    create_or_replace(spark.table(f"{db}.d").drop("more"), f"{db}.d")
    assert spark.table(f"{db}.d").count() == 1


def test_backfill_needs_a_table(db, records):
    with pytest.raises(RuntimeError):
        backfill(records, f"{db}.none", "2024-01", "2024-02")


def test_backfill_touches_only_its_range(spark, db, records):
    table = f"{db}.s"
    stale = silver(records, stamp=F.lit("2001-01-01").cast("timestamp")).withColumn("items", F.lit(99).cast("bigint"))
    undated = stale.limit(1).withColumn("year_month", F.lit(None).cast("string"))
    emptied = stale.limit(1).withColumn("year_month", F.lit("2023-12"))
    publish_silver(stale.unionByName(undated).unionByName(emptied), table)
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "static")
    try:
        assert backfill(records, table, "2023-12", "2024-02") == 3
        assert spark.conf.get(mode) == "static"
    finally:
        spark.conf.set(mode, "dynamic")
    after = values(spark.table(table), "year_month", "items")
    assert after == [("2024-01", 6), ("2024-01", 10), ("2024-02", 5), ("2024-03", 99), ("2024-03", 99), (None, 99)]
    assert backfill(records, table, "2023-12", "2024-02") == 3
    assert values(spark.table(table), "year_month", "items") == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def test_backfill_by_resource_reads_only_those_files(spark, db, records):
    bronze = records.withColumn("resource", F.concat(F.lit("EPD_"), F.lit("202401")))
    late = records.limit(1).withColumn("resource", F.lit("EPD_202312"))
    publish_silver(silver(records), f"{db}.s")
    assert backfill(bronze.unionByName(late), f"{db}.s", "2024-01", "2024-01", by_resource=True) == 2
    assert backfill(bronze.unionByName(late), f"{db}.s", "2024-01", "2024-01") == 3


def test_backfill_reads_no_month_outside_its_range(spark, db, records):
    table = f"{db}.s"
    publish_silver(silver(records), table)
    plan = spark.table(table).filter("year_month BETWEEN '2024-01' AND '2024-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_backfill_proof(db, records):
    publish_silver(silver(records), f"{db}.s")
    row = backfill_proof(records, f"{db}.s", "2024-01", "2024-01").first()
    assert tuple(row) == (5, 2, 2, 2, 5, 2, True)


def test_refresh_is_repeatable_and_logged(spark, db, tmp_path, records):
    sections = spark.createDataFrame(
        [("metformin", "side_effects", "", "nausea nausea", [])],
        "drug string, page_type string, heading string, text string, bullets array<string>",
    )
    log = str(tmp_path / "log")
    limits = {"actual_cost": 50.0}
    first = dict(tuple(r) for r in medallion_run(records, sections, db, db, log, limits=limits).collect())
    second = dict(tuple(r) for r in medallion_run(records, sections, db, db, log, limits=limits).collect())
    assert first == second == {
        "veracity_report": 4, "silver": 5, "drug_summary": 2, "drug_monthly_spend": 3,
        "practice_leaderboard": 4, "dim_practice": 4, "top_terms": 1,
    }
    with pytest.raises(NullRateBreach):
        medallion_run(records, sections, db, db, log)
    runs = event_log.lineage_runs(event_log.read_events(spark, log))
    assert values(runs.groupBy("state").count(), "state", "count") == [("COMPLETE", 14), ("FAIL", 1)]
    up = event_log.upstream(event_log.lineage_edges(event_log.read_events(spark, log)), f"{db}.drug_summary")
    assert values(up, "distance", "dataset") == [(1, f"{db}.prescribing"), (2, "bronze.prescribing")]


def test_readers_never_miss_the_table_during_swaps(spark, db, records):
    table = f"{db}.t"
    publish(records, table)
    stop, seen, errors = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(table).count())
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(20):
            publish(records.limit(i % 6 + 1), table)
    finally:
        stop.set()
        reader.join()
    assert errors == [] and len(seen) > 5 and set(seen) <= set(range(1, 7))


STEPS = ("_write_version", "_own_partitions", "_write_manifest", "_register", "_show", "_retire")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_a_backfill_stopped_anywhere_leaves_a_whole_table(spark, db, records, monkeypatch, step, late):
    table = f"{db}.s"
    stale = silver(records, stamp=F.lit("2001-01-01").cast("timestamp")).withColumn("items", F.lit(99).cast("bigint"))
    emptied = stale.limit(1).withColumn("year_month", F.lit("2023-12"))
    publish_silver(stale.unionByName(emptied), table)
    old = values(spark.table(table), "year_month", "items")
    new = [("2024-01", 6), ("2024-01", 10), ("2024-02", 5), ("2024-03", 99), ("2024-03", 99)]
    whole = getattr(tables, step)

    def stopped(*args, **kwargs):
        if late:
            whole(*args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, stopped)
        with pytest.raises(KeyboardInterrupt):
            backfill(records, table, "2023-12", "2024-02")
    shown = step == "_retire" or step == "_show" and late
    assert values(spark.table(table), "year_month", "items") == (new if shown else old)
    # a repeat completes it and takes away what was left behind
    assert backfill(records, table, "2023-12", "2024-02") == 3
    assert values(spark.table(table), "year_month", "items") == new
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect() if r["tableName"].startswith("s__")]
    assert len(names) == 2


def test_backfills_copy_no_other_month(spark, db, tmp_path, records):
    table = f"{db}.s"
    publish_silver(silver(records), table)
    for _ in range(3):
        backfill(records, table, "2024-01", "2024-01")
    parts = tables.manifest(spark, table, tables.current_version(spark, table))
    own = tables._folder(spark, table, tables.current_version(spark, table))
    assert [m for m, f in sorted(parts.items()) if f.startswith(own)] == ["2024-01"]
    # the months of the first version are still where they were written, its rewritten month is gone
    first = {f.rpartition("/")[0] for m, f in parts.items() if m != "2024-01"}
    assert len(first) == 1 and sorted(d for d in os.listdir(first.pop().removeprefix("file:")) if "=" in d) == ["year_month=2024-02", "year_month=2024-03"]


def test_a_breached_limit_can_stop_before_readers_see_it(spark, db, records):
    table = f"{db}.s"
    written = publish_silver(silver(records.filter("actual_cost IS NOT NULL")), table, enforce=True)
    assert (written.rows, written.nulls) == (4, {"actual_cost": 0, "items": 0, "setting": 0})
    for change in (lambda: publish_silver(silver(records), table, enforce=True), lambda: backfill(records, table, "2024-02", "2024-02", enforce=True)):
        with pytest.raises(NullRateBreach):
            change()
        assert spark.table(table).count() == 4
    assert publish_silver(silver(records), table, {"actual_cost": 20.0}, enforce=True).nulls == {"actual_cost": 1}


def test_null_counts_come_from_the_write_alone(spark, db, records, tmp_path):
    records.write.parquet(str(tmp_path / "b"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "x")
    try:
        publish_silver(silver(spark.read.parquet(str(tmp_path / "b")).filter("items > 0")), f"{db}.s", {"actual_cost": 50.0}, enforce=True)
        stages = {s for j in jobs.getJobIdsForGroup("counted") for s in jobs.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # broadcast of the promoted set, rebalance, write, and the manifest of a few rows
    assert len(stages) <= 7


def test_sketches_of_replaced_months_merge(spark, db):
    rows = spark.range(30_000).select(
        F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("year_month"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 9000).alias("items"), F.lit("4").alias("setting"),
    )
    table = f"{db}.sketches"
    publish(month_sketches(rows.filter("items < 5"), ["items", "setting"]), table, ["year_month"])
    tables.replace_months(month_sketches(rows, ["items", "setting"]), table, "2024-01", "2024-03")
    got = {r["field"]: r for r in approx_report(spark.table(table)).collect()}
    for want in veracity_report(rows, ["items", "setting"]).collect():
        own = got[want["field"]]
        assert (own["null_count"], own["null_pct"]) == (want["null_count"], want["null_pct"])
        assert abs(own["unique_count"] - want["unique_count"]) <= 0.05 * want["unique_count"]


def test_gold_after_a_backfill_equals_a_full_rebuild_and_reads_only_its_months(spark, db, records):
    table, other = f"{db}.s", f"{db}_full"
    publish_silver(silver(records.withColumn("items", F.col("items") + 1)), table)
    refresh.build_gold(spark, table, db)
    refresh.build_dimension(spark, db)
    refresh.backfill_gold(records, table, db, "2024-01", "2024-02")
    ensure_database(spark, other)
    refresh.build_gold(spark, table, other)
    refresh.build_dimension(spark, other)
    for name in ("drug_summary", "drug_monthly_spend", "practice_leaderboard", "dim_practice"):
        full = spark.table(f"{other}.{name}")
        assert values(spark.table(f"{db}.{name}"), *full.columns) == values(full, *full.columns)
    touched = tables.month_range(spark.table(table), "2024-01", "2024-02")
    plan = refresh.month_partials(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    spark.sql(f"DROP DATABASE {other} CASCADE")
