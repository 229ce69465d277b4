"""Ingest: verdict, write and commit of batches as one step."""

import json
import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.operators import event_log, ingest
from doseledger.operators.tables import ensure_database
from doseledger.plans.refresh import medallion_from_files
from doseledger.schemas import LEDGER_CSV_HEADER
from doseledger.sources.ledger_csv import read_epd_csv

HEADER = "drug string, resource string, bnf_code string, source string, total_rows bigint"


def _lines(spark, *batches):
    """(drug, resource, [items of its records]) each."""
    rows = [
        (drug, resource, json.dumps({"date": "2024-01-01", "actual_cost": 1.0, "items": i, "quantity": 1, "row_id": "A", "drug": drug}))
        for drug, resource, items in batches for i in items
    ]
    return spark.createDataFrame(rows, "batch_drug string, batch_resource string, value string")


def _headers(spark, *batches):
    return spark.createDataFrame([(*b, "C", "nhsbsa_epd", 1) for b in batches], HEADER)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "lake")


def test_a_refused_batch_holds_up_no_other(spark, base):
    lines = _lines(spark, ("a", "R1", [1, 2]), ("a", "R2", [3]), ("b", "R1", [4, "x"]), ("c", "R1", [5]))
    headers = _headers(spark, ("a", "R1"), ("a", "R2"), ("b", "R1"), ("empty", "R1"))
    assert ingest.ingest_lines(lines, headers, base) == 1
    assert values(ingest.read_committed(spark, base), "drug", "resource", "items") == [("a", "R1", 1), ("a", "R1", 2), ("a", "R2", 3)]
    rejects = ingest.read_rejects(spark, base)
    assert values(rejects.filter("batch_drug = 'b'"), "batch_reasons", "items") == [(["records: contract broken"], 4), (["records: contract broken"], None)]
    assert [r["batch_reasons"] for r in rejects.filter("batch_drug = 'c'").collect()] == [["header: missing"]]
    assert values(ingest.commits(spark, base), "drug", "resource", "record_rows", "accepted") == [
        ("a", "R1", 2, True), ("a", "R2", 1, True), ("b", "R1", 2, False), ("c", "R1", 1, False), ("empty", "R1", 0, True),
    ]


def test_a_later_run_replaces_accepted_batches_only(spark, base):
    ingest.ingest_lines(_lines(spark, ("a", "R1", [1]), ("b", "R1", [2])), _headers(spark, ("a", "R1"), ("b", "R1")), base)
    assert ingest.ingest_lines(_lines(spark, ("a", "R1", [7, 8]), ("b", "R1", ["x"])), _headers(spark, ("a", "R1"), ("b", "R1")), base) == 2
    assert values(ingest.read_committed(spark, base), "drug", "items") == [("a", 7), ("a", 8), ("b", 2)]
    # an accepted batch of no rows replaces the rows before
    ingest.ingest_lines(_lines(spark, ("b", "R1", [3])), _headers(spark, ("a", "R1"), ("b", "R1")), base)
    assert values(ingest.read_committed(spark, base), "drug", "items") == [("b", 3)]


@pytest.mark.parametrize("step", ["_write_rows", "contract_batch", "_write_commit"])
@pytest.mark.parametrize("late", [False, True])
def test_a_run_stopped_anywhere_shows_nothing(spark, base, monkeypatch, step, late):
    ingest.ingest_lines(_lines(spark, ("a", "R1", [1])), _headers(spark, ("a", "R1")), base)
    whole = getattr(ingest, step)

    def stopped(*args):
        if late:
            whole(*args)
        raise KeyboardInterrupt

    more, headers = _lines(spark, ("a", "R1", [2]), ("a", "R2", [3])), _headers(spark, ("a", "R1"), ("a", "R2"))
    with monkeypatch.context() as patch:
        patch.setattr(ingest, step, stopped)
        with pytest.raises(KeyboardInterrupt):
            ingest.ingest(ingest.contract_records(more), headers, base, stopped if step == "contract_batch" else ingest.contract_batch)
    done = step == "_write_commit" and late
    assert values(ingest.read_committed(spark, base), "items") == ([(2,), (3,)] if done else [(1,)])
    # a commit that was not completed doesn't count either, and goes with the next run
    half = f"{base}/commits/run=9"
    os.makedirs(half)
    with open(f"{half}/part-0.json", "w") as out:
        out.write('{"drug":"a","resource":"R1","record_rows":0,"bad_records":0,"accepted":true,"reasons":[]}\n')
    assert 9 not in ingest.committed_runs(spark, base)
    ingest.ingest_lines(more, headers, base)
    assert values(ingest.read_committed(spark, base), "items") == [(2,), (3,)]
    assert not os.path.exists(half) and len(os.listdir(f"{base}/rows")) == (3 if done else 2)


def test_reading_prunes_to_the_batches_that_count(spark, base):
    ingest.ingest_lines(_lines(spark, ("a", "R1", [1])), _headers(spark, ("a", "R1")), base)
    plan = ingest.read_committed(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_nothing_committed(spark, base):
    with pytest.raises(FileNotFoundError):
        ingest.read_committed(spark, base)
    assert ingest.commits(spark, base).count() == 0


def _page(drug, kind):
    return drug, json.dumps({"drug": drug, "type": "nhs_pages", "pages": [{"url": "u", "page_type": kind, "text": "nausea rash"}]})


def test_refresh_from_files(spark, tmp_path):
    codes = {"metformin": "0601022B0", "aspirin": "0209000A0"}
    for month in ("202401", "202402"):
        with open(tmp_path / f"EPD_{month}.csv", "w") as out:
            out.write(",".join(LEDGER_CSV_HEADER) + "\n")
            for i, code in enumerate(codes.values()):
                row = {"YEAR_MONTH": month, "PRACTICE_CODE": f"P{i}", "ICB_CODE": "Q", "BNF_CHEMICAL_SUBSTANCE": code, "ITEMS": "2", "QUANTITY": "1", "ACTUAL_COST": "3.5", "UNIDENTIFIED": "N"}
                out.write(",".join(row.get(c, "x") for c in LEDGER_CSV_HEADER) + "\n")
    pages = spark.createDataFrame([_page("metformin", "side_effects"), _page("aspirin", "dosage")], "batch_drug string, value string")
    ensure_database(spark, "from_files", str(tmp_path / "db"))
    log, base = str(tmp_path / "log"), str(tmp_path / "lake")
    for _ in range(2):
        counts = medallion_from_files(spark, str(tmp_path / "*.csv"), pages, base, "from_files", "from_files", log)
        assert dict(tuple(r) for r in counts.collect()) == {
            "veracity_report": 4, "silver": 4, "drug_summary": 2, "drug_monthly_spend": 4, "practice_leaderboard": 2, "dim_practice": 2, "top_terms": 2,
        }
    assert values(spark.table("from_files.dim_practice"), "practice_id", "valid_from")[0][1].isoformat() == "2024-01-01"
    assert [r["batch_drug"] for r in ingest.read_rejects(spark, f"{base}/pages").select("batch_drug").distinct().collect()] == ["aspirin"]
    up = event_log.upstream(event_log.lineage_edges(event_log.read_events(spark, log)), "from_files.drug_summary")
    assert values(up, "distance", "dataset") == [(1, "from_files.prescribing"), (2, "bronze.prescribing"), (3, "source.ledger_csv")]
    spark.sql("DROP DATABASE from_files CASCADE")


def test_csv_rows_without_required_text_refuse_their_batch(spark, tmp_path, base):
    path = tmp_path / "EPD_202401.csv"
    path.write_text(",".join(LEDGER_CSV_HEADER) + "\n" + ",".join("0601022B0" if c == "BNF_CHEMICAL_SUBSTANCE" else "1" for c in LEDGER_CSV_HEADER) + "\n")
    rows = read_epd_csv(spark, str(path))
    ingest.ingest_csv(rows.unionByName(rows.withColumns({"resource": F.lit("EPD_202402"), "row_id": F.lit(None).cast("string")})), base)
    assert values(ingest.commits(spark, base), "resource", "accepted") == [("EPD_202401", True), ("EPD_202402", False)]


def test_headers_are_taken_once(spark, base):
    """Verdicts and rows without a header read the written headers, not what they come from."""
    seen = []

    def judge(headers, rows):
        seen.append(headers.inputFiles())
        return ingest.contract_batch(headers, rows)

    checked = ingest.contract_records(_lines(spark, ("a", "R1", [1])))
    ingest.ingest(checked, _headers(spark, ("a", "R1")), base, judge)
    assert seen[0] and ingest.read_committed(spark, base).count() == 1


def test_csv_batches_are_judged_without_a_search_for_missing_headers(spark, tmp_path, base, monkeypatch):
    """Headers taken from the rows themselves leave no row without one, and are counted in hash tables."""
    rows = [("d", "R1", None), ("d", "R1", "C"), ("d", "R2", None), ("", "R1", "C")]
    checked = spark.createDataFrame(rows, "batch_drug string, batch_resource string, bnf_code string").withColumn("violations", F.array().cast("array<string>"))
    plans, write, scratch = [], ingest._write_commit, ingest.write_scratch

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def seen(verdicts, *args):
        plans.append(plan(verdicts))
        write(verdicts, *args)

    def written(df, tag):
        plans.append(plan(df))
        return scratch(df, tag)

    monkeypatch.setattr(ingest, "_write_commit", seen)
    monkeypatch.setattr(ingest, "write_scratch", written)
    ingest.ingest(checked, None, base)
    headers, verdicts = plans
    assert "LeftAnti" not in verdicts
    scanned = headers[headers.rindex("Aggregate(keys=[batch_drug"):] if "Aggregate(keys=[batch_drug" in headers else headers
    assert "SortAggregate" not in scanned and "HashAggregate" in headers
    assert values(ingest.commits(spark, base), "drug", "resource", "record_rows", "accepted") == [
        ("d", "R1", 2, True), ("d", "R2", 1, False), ("unnamed", "R1", 1, True),
    ]
