import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.operators import practices
from doseledger.operators.rollups import month_partials
from doseledger.operators.tables import inject_history

D = dt.date


@pytest.fixture
def history(spark):
    rows = [
        ("A001", "4", "03V", D(2022, 1, 1), "2022-01"), ("A001", "4", "03V", D(2022, 8, 1), "2022-08"),
        ("A002", "4", "03V", D(2022, 1, 1), "2022-01"), ("A002", "4", "15N", D(2022, 8, 1), "2022-08"),
        ("A003", "4", "15N", None, "2022-09"),
    ]
    return spark.createDataFrame(rows, "row_id string, setting string, ccg string, date date, year_month string")


def test_versions(history):
    dim = practices.dim_practice(history)
    assert values(dim, "practice_id", "version_num", "ccg", "valid_from", "valid_to", "is_current") == [
        ("A001", 1, "03V", D(2022, 1, 1), None, True),
        ("A002", 1, "03V", D(2022, 1, 1), D(2022, 8, 1), False),
        ("A002", 2, "15N", D(2022, 8, 1), None, True),
        ("A003", 1, "15N", D(2022, 9, 1), None, True),
    ]
    row = practices.version_counts(dim).first()
    assert tuple(row) == (4, 3, 3, 1, 1)
    assert practices.current_uniqueness(dim).count() == 0
    assert practices.version_gap_check(dim).count() == 0


def test_compact_months_date_a_version_unless_days_are_asked_for(history):
    dim = practices.dim_practice(history, impute_month_start=False)
    assert dim.filter("practice_id = 'A003'").first()["valid_from"] is None


def test_versions_from_partials_equal_those_from_records(spark, history):
    rows = history.withColumns({"drug": F.lit("d"), "items": F.lit(1), "actual_cost": F.lit(1.0)})
    more = spark.createDataFrame(
        [("A001", "4", "03V", None, "2021-11"), ("A001", "4", "03V", D(2021, 11, 9), "2021-11"), ("A004", "4", "X", None, None)],
        "row_id string, setting string, ccg string, date date, year_month string",
    )
    rows = rows.unionByName(more, allowMissingColumns=True)
    for imputed in (True, False):
        shown = ("practice_id", "setting", "ccg", "first_seen", "last_seen")
        want = values(practices.practice_versions(rows, imputed), *shown)
        assert values(practices.practice_versions(month_partials(rows), imputed), *shown) == want


def test_returning_attributes_keep_the_first_version(spark):
    rows = [("P", "4", c, D(2022, m, 1)) for m, c in ((1, "A"), (2, "B"), (3, "A"))]
    df = spark.createDataFrame(rows, "row_id string, setting string, ccg string, date date").withColumn("year_month", F.lit("2022-01"))
    assert values(practices.dim_practice(df), "version_num", "ccg") == [(1, "A"), (2, "B")]


@pytest.mark.parametrize("day, ccg", [("2022-01-01", "03V"), ("2022-07-31", "03V"), ("2022-08-01", "15N"), ("2021-12-31", None)])
def test_lookup_on_a_day(history, day, ccg):
    rows = practices.pit_lookup(practices.dim_practice(history), day, "A002").collect()
    assert [r["ccg"] for r in rows] == ([ccg] if ccg else [])


def test_join_on_each_day_equals_lookups(spark, history):
    dim = practices.dim_practice(history)
    facts = spark.createDataFrame(
        [(p, D(2022, m, 15), None, m) for p in ("A001", "A002", "A003", "A009", None) for m in range(1, 13)]
        + [("A002", None, "2022-08", 20), ("A002", None, None, 21), ("A002", D(2021, 12, 31), "2021-12", 22)],
        "row_id string, date date, year_month string, items int",
    )
    joined = practices.pit_join(facts, dim)
    assert joined.count() == facts.count()
    got = {(r["row_id"], r["items"]): r["ccg_then"] for r in joined.collect()}
    for r in facts.collect():
        at = r["date"] or (D(2022, 8, 1) if r["year_month"] else None)
        found = practices.pit_lookup(dim, str(at), r["row_id"]).collect() if at and r["row_id"] else []
        assert got[r["row_id"], r["items"]] == (found[0]["ccg"] if found else None)
    assert joined.filter("has_version <> (version_num IS NOT NULL)").count() == 0


def test_a_practice_of_many_versions_is_no_product(spark):
    days = F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int"))
    dim = spark.range(10_000).select(
        F.lit("P").alias("practice_id"), F.lit("4").alias("setting"), F.concat(F.lit("C"), "id").alias("ccg"), days.alias("valid_from"),
        F.when(F.col("id") < 9999, F.date_add(days, 1)).alias("valid_to"), (F.col("id") + 1).cast("int").alias("version_num"),
    )
    facts = spark.range(30_000).select(F.lit("P").alias("row_id"), F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 10_000).cast("int")).alias("date"), F.lit(None).cast("string").alias("year_month"), "id")
    joined = practices.pit_join(facts, dim)
    assert joined.filter("version_num = id % 10000 + 1").count() == 30_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "valid_from" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_the_later_of_two_versions_of_a_day_holds(spark):
    rows = [("P", "4", "A", D(2022, 1, 1), D(2022, 1, 1), 1), ("P", "4", "B", D(2022, 1, 1), D(2022, 3, 1), 2)]
    dim = spark.createDataFrame(rows, "practice_id string, setting string, ccg string, valid_from date, valid_to date, version_num int")
    facts = spark.createDataFrame([("P", D(2022, 1, 1)), ("P", D(2022, 4, 1))], "row_id string, date date")
    joined = practices.pit_join(facts, dim, impute_month_start=False)
    assert values(joined, "date", "ccg_then", "has_version") == [(D(2022, 1, 1), "B", True), (D(2022, 4, 1), None, False)]


def test_gap_is_found(history):
    dim = practices.dim_practice(history).withColumn("valid_to", F.date_sub("valid_to", 2))
    assert values(practices.version_gap_check(dim), "practice_id", "next_from") == [("A002", D(2022, 8, 1))]


def test_injected_history_gives_a_second_version(history):
    full = history.select("*", F.current_timestamp().alias("ingested_at"))
    dim = practices.dim_practice(inject_history(full, "A001", "OLD001", "2021-06-01"))
    assert values(dim.filter("practice_id = 'A001'"), "version_num", "ccg", "valid_to", "is_current") == [
        (1, "OLD001", D(2022, 1, 1), False), (2, "03V", None, True),
    ]


def test_facts_known_by_month_join_unless_days_are_asked_for(spark):
    dim = spark.sql("SELECT 'A' AS practice_id, '4' AS setting, 'C1' AS ccg, DATE'2024-01-01' AS valid_from, DATE(NULL) AS valid_to, 1 AS version_num")
    facts = spark.sql("SELECT 'A' AS row_id, DATE(NULL) AS date, '2024-03' AS year_month")
    assert practices.pit_join(facts, dim).first()["ccg_then"] == "C1"
    assert not practices.pit_join(facts, dim, impute_month_start=False).first()["has_version"]
