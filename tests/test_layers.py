import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.operators import rollups
from doseledger.operators.quality import NullRateBreach, enforce_null_rates, null_rate_gate, veracity_report
from doseledger.operators.silver import month_range, prescribing_frame, silver, strict_cast, tolerant_types
from doseledger.operators.terms import summary_terms_join, term_counts, top_terms
from doseledger.schemas import SILVER_COLUMNS, promoted_table


@pytest.fixture
def trusted(records):
    return silver(records)


def test_silver_shape(trusted):
    assert tuple(trusted.columns) == SILVER_COLUMNS
    kinds = dict(trusted.dtypes)
    assert (kinds["date"], kinds["items"], kinds["nic_per_item"], kinds["ingested_at"]) == (
        "date", "bigint", "double", "timestamp",
    )


def test_silver_drops_rows_without_any_value(trusted):
    assert trusted.count() == 5
    assert trusted.filter("actual_cost IS NULL AND items IS NULL").count() == 0


def test_silver_ratio(trusted):
    by_items = {r["items"]: r["nic_per_item"] for r in trusted.collect()}
    assert by_items == {10: 15.0, 6: 15.0, 5: None, 3: 13.5, 0: None}


def test_silver_keeps_unreadable_and_duplicate_rows(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "n/a", "", "1", "A", "4", "C", "aspirin")] * 2,
        "date string, actual_cost string, items string, quantity string, row_id string, "
        "setting string, ccg string, drug string",
    )
    out = silver(raw).collect()
    assert len(out) == 2 and out[0]["actual_cost"] is None and out[0]["items"] is None


def test_only_promoted_medicines(spark, records):
    other = records.withColumn("drug", F.when(F.col("row_id") == "A01", "liraglutide").otherwise(F.col("drug")))
    assert "liraglutide" not in {r[0] for r in silver(other).select("drug").collect()}
    assert silver(other, promoted_table(spark, ["liraglutide"])).count() == 2


def test_fractional_items_by_source_type(spark):
    double = spark.createDataFrame([("202501", 1.0, 12.5, 1.0, "A", "4", "C", "d")], "date string, actual_cost double, items double, quantity double, row_id string, setting string, ccg string, drug string")
    text = double.withColumn("items", F.col("items").cast("string"))
    assert tolerant_types(double).first()["items"] == 12
    assert tolerant_types(text).first()["items"] == 13


def test_month_window(trusted):
    assert values(month_range(trusted, "2024-01", "2024-02"), "year_month") == [("2024-01",), ("2024-01",), ("2024-02",)]


def test_strict_cast_fails_on_text(spark):
    raw = spark.createDataFrame([("x", "1", "1")], "actual_cost string, items string, quantity string")
    with pytest.raises(Exception):
        strict_cast(raw).collect()


def test_frame_keeps_every_row(records):
    frame = prescribing_frame(records)
    assert frame.count() == 6
    assert set(frame.select("year_month").distinct().toPandas()["year_month"]) == {"2024-01", "2024-02", "2024-03"}


def test_summary(trusted):
    rows = [tuple(r) for r in rollups.drug_summary(trusted).collect()]
    assert rows == [("metformin", 21, 240.0, 11.4286, 2, 2), ("atorvastatin", 3, 120.5, 40.1667, 2, 1)]


def test_gold_from_the_shared_rollup_is_the_same(trusted):
    months = rollups.practice_months(trusted)
    for build in (rollups.drug_summary, rollups.drug_monthly_spend, rollups.practice_leaderboard):
        assert [tuple(r) for r in build(trusted).collect()] == [tuple(r) for r in build(months).collect()]


def test_gold_items_equal_silver_items(trusted):
    row = rollups.layer_reconcile(trusted, rollups.drug_summary(trusted)).first()
    assert (row["silver_items"], row["gold_items"], row["balanced"]) == (24, 24, True)


def test_leaderboard_ranks_ties_by_practice(spark):
    rows = [("d", f"P{i:02d}", 5 if i % 2 else 9, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "drug string, row_id string, items bigint, actual_cost double")
    board = rollups.practice_leaderboard(df).collect()
    assert [r["rank"] for r in board] == list(range(1, 21))
    assert [r["practice_id"] for r in board] == [f"P{i:02d}" for i in range(0, 40, 2)]
    assert rollups.subset_check(rollups.practice_leaderboard(df), df).count() == 0


def test_feeds(trusted):
    monthly = rollups.drug_monthly_spend(trusted)
    assert rollups.chart_trend_feed(monthly, ["unknown"]).count() == 0
    assert rollups.chart_trend_feed(monthly).count() == 3
    summary = rollups.drug_summary(trusted)
    assert rollups.top_cost_drugs(summary, 1).first()["drug"] == "metformin"
    assert rollups.cost_per_item_order(summary).first()["drug"] == "atorvastatin"


def test_report_counts_null_as_a_value(records):
    report = veracity_report(records)
    assert [r["field"] for r in report.collect()] == ["actual_cost", "items", "quantity", "setting"]
    rows = {r["field"]: tuple(r)[1:] for r in report.collect()}
    assert rows == {
        "actual_cost": (2, 33.33, 5), "items": (1, 16.67, 6), "quantity": (0, 0.0, 6), "setting": (0, 0.0, 1),
    }


def test_report_of_an_empty_or_narrow_table(records):
    rows = veracity_report(records.filter("false").drop("setting")).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("actual_cost", 0, 0.0, 0), ("items", 0, 0.0, 0), ("quantity", 0, 0.0, 0),
    ]


def test_gate_passes_and_fails(trusted):
    clean = trusted.filter("actual_cost IS NOT NULL")
    assert enforce_null_rates(clean) == {"actual_cost": 0.0, "items": 0.0, "setting": 0.0}
    with pytest.raises(NullRateBreach) as caught:
        enforce_null_rates(trusted)
    assert [(r["field"], r["null_pct"], r["threshold"]) for r in caught.value.rows] == [("actual_cost", 20.0, 5.0)]
    assert str(caught.value).endswith("actual_cost")


def test_gate_limits(trusted):
    assert enforce_null_rates(trusted, {"actual_cost": 20.0}) == {"actual_cost": 20.0}
    with pytest.raises(NullRateBreach):
        enforce_null_rates(trusted, {"actual_cost": 0.0})
    assert enforce_null_rates(trusted.filter("false")) == {}
    assert null_rate_gate(trusted.filter("false")).count() == 0


@pytest.fixture
def sections(spark):
    rows = [
        ("metformin", "side_effects", "Nausea", "nausea nausea rash", ["rash vomiting"]),
        ("metformin", "interactions", "", "rash with alcohol", []),
        ("aspirin", "side_effects", "", "the and with", None),
    ]
    return spark.createDataFrame(rows, "drug string, page_type string, heading string, text string, bullets array<string>")


def test_term_counts(sections):
    assert values(term_counts(sections), "drug", "page_type", "term", "frequency") == [
        ("metformin", "interactions", "alcohol", 1), ("metformin", "interactions", "rash", 1),
        ("metformin", "side_effects", "nausea", 3), ("metformin", "side_effects", "rash", 2),
        ("metformin", "side_effects", "vomiting", 1),
    ]


def test_stop_words_are_looked_up_once_a_term(sections):
    plan = term_counts(sections)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.index("Aggregate") < plan.index("Generate")
    assert values(term_counts(sections, ["rash"]).filter("drug = 'aspirin' OR term = 'rash'"), "term", "frequency") == [("with", 1)]
    assert term_counts(sections, []).count() == term_counts(sections, ["none"]).count() == 7


def test_top_terms_limit_is_per_medicine(spark, sections):
    top = [(r["term"], r["page_type"], r["frequency"]) for r in top_terms(sections, 3).collect()]
    assert top == [("nausea", "side_effects", 3), ("rash", "side_effects", 2), ("alcohol", "interactions", 1)]
    empty = top_terms(sections.filter("drug = 'aspirin'"))
    assert empty.columns == ["drug", "term", "frequency", "page_type"] and empty.count() == 0
    assert rollups.chart_terms_feed(term_counts(sections), "metformin", 1).first()["term"] == "nausea"
    summary = spark.createDataFrame([("metformin", 1, 2.0, 2.0)], "drug string, total_items bigint, total_cost_gbp double, avg_nic_per_item double")
    assert summary_terms_join(summary, top_terms(sections, 3)).count() == 3


def test_dates_of_compact_months_are_null(trusted):
    row = trusted.filter("drug = 'atorvastatin' AND items = 3").first()
    assert (row["date"], row["year_month"]) == (None, "2024-03")
    assert trusted.filter("items = 10").first()["date"] == dt.date(2024, 1, 1)
