import json
import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.schemas import LEDGER_CSV_HEADER, RAW_RECORD, drug_code_table
from doseledger.sources.bronze import read_bronze, read_lake, route_payloads, write_bronze
from doseledger.sources.inventory import lake_inventory, lake_partitions
from doseledger.sources.ledger_csv import csv_headers, latest_months, read_epd_csv
from doseledger.sources.web_pages import drug_key_ok, page_documents, read_sections


def _csv_line(header, **fields):
    quoted = ['"' + fields.get(c, "x").replace('"', '""') + '"' for c in header]
    return ",".join(quoted)


def _write_csv(path, header, rows):
    with open(path, "w") as out:
        out.write(",".join(header) + "\n\n")
        for row in rows:
            out.write(_csv_line(header, **row) + "\n")


METFORMIN = "0601022B0"


def _row(code=METFORMIN, practice="A1", items="3", cost="12.5", flag="N", **more):
    return {
        "YEAR_MONTH": "202506", "PRACTICE_CODE": practice, "ICB_CODE": "QWE", "ICB_NAME": "Board, North",
        "BNF_CHEMICAL_SUBSTANCE": code, "ITEMS": items, "QUANTITY": "28", "ACTUAL_COST": cost,
        "UNIDENTIFIED": flag, "ADDRESS_1": 'The "Old" Mill, 1', **more,
    }


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "EPD_202506.csv"
    _write_csv(
        path,
        LEDGER_CSV_HEADER,
        [
            _row(),
            _row(practice="A2", items="12.7", cost="NULL"),
            _row(practice="A3", items="", cost="bad"),
            _row(practice="A4", flag="TRUE"),
            _row(code="0212000B0", practice="A5"),
            _row(code="9999999X0", practice="A6", BNF_CODE=METFORMIN),
        ],
    )
    return str(path)


def test_csv_rows_of_wanted_substances(spark, csv_file):
    df = read_epd_csv(spark, csv_file)
    assert values(df, "drug", "row_id", "items", "actual_cost") == [
        ("atorvastatin", "A5", 3, 12.5),
        ("metformin", "A1", 3, 12.5),
        ("metformin", "A2", 12, None),
        ("metformin", "A3", None, None),
    ]
    first = df.filter("row_id = 'A1'").first()
    assert (first["date"], first["resource"], first["setting"], first["ccg"], first["icb_name"]) == (
        "202506", "EPD_202506", "4", "QWE", "Board, North",
    )


def test_csv_columns_are_found_by_name(spark, tmp_path, csv_file):
    other = tmp_path / "EPD_202507.csv"
    _write_csv(other, list(reversed(LEDGER_CSV_HEADER)), [_row(practice="B1")])
    df = read_epd_csv(spark, [csv_file, str(other)], drug_code_table(spark, {"metformin": METFORMIN}))
    assert values(df.filter("row_id LIKE 'B%'"), "row_id", "resource", "items") == [("B1", "EPD_202507", 3)]
    assert df.count() == 4


def test_row_cap_takes_the_first_rows_of_each_medicine(spark, csv_file):
    df = read_epd_csv(spark, csv_file, row_cap=2)
    assert values(df, "drug", "row_id") == [("atorvastatin", "A5"), ("metformin", "A1"), ("metformin", "A2")]


def test_latest_months(spark):
    names = ["EPD_202412", "EPD_202502", "EPD_202501", "INDEX_209901", "EPD_199912"]
    df = spark.createDataFrame([(n,) for n in names], "resource string")
    assert values(latest_months(df, 2), "resource") == [("EPD_202501",), ("EPD_202502",)]


def _jsonl(base, *parts, rows, extra=""):
    folder = os.path.join(base, *parts)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "prescribing.jsonl"), "w") as out:
        for row in rows:
            out.write(json.dumps(row) + "\n\n")
        out.write(extra)


def _rec(i, drug="metformin", **more):
    return {"date": "202506", "actual_cost": 1.5 * i, "items": i, "quantity": 2, "row_id": f"A{i}",
            "setting": 4, "ccg": "03V", "drug": drug, **more}


@pytest.fixture
def lake_dir(tmp_path):
    base = str(tmp_path / "lake")
    _jsonl(base, "metformin", "EPD_202506", rows=[_rec(1), _rec(2)])
    _jsonl(base, "metformin", "EPD_202505", rows=[_rec(3)])
    _jsonl(base, "metformin", rows=[_rec(9)])
    _jsonl(base, "aspirin", "EPD_202506", rows=[_rec(4, "aspirin", items="12")])
    with open(os.path.join(base, "stray.txt"), "w") as out:
        out.write("ignored")
    return base


def test_lake_scan_skips_blank_lines_and_flat_files(spark, lake_dir):
    df = read_bronze(spark, lake_dir)
    assert values(df, "row_id", "setting", "items", "resource") == [
        ("A1", "4", "1", "EPD_202506"), ("A2", "4", "2", "EPD_202506"),
        ("A3", "4", "3", "EPD_202505"), ("A4", "4", "12", "EPD_202506"),
    ]


def test_tolerant_scan_drops_broken_lines(spark, lake_dir):
    _jsonl(lake_dir, "aspirin", "EPD_202507", rows=[_rec(5, "aspirin")], extra='{"date": "20\nnot json\n')
    tolerant = read_bronze(spark, lake_dir, tolerant=True)
    assert tolerant.count() == 5
    assert tolerant.groupBy("drug").count().filter("drug = 'aspirin'").first()["count"] == 2
    with pytest.raises(Exception):
        read_bronze(spark, lake_dir).select("row_id").collect()


def test_read_lake_includes_the_flat_file(spark, lake_dir):
    assert values(read_lake(spark, lake_dir, "metformin", "nhsbsa_epd"), "row_id") == [
        ("A1",), ("A2",), ("A3",), ("A9",),
    ]


def test_read_lake_errors(spark, lake_dir):
    with pytest.raises(FileNotFoundError):
        read_lake(spark, lake_dir, "nothing", "nhsbsa_epd")
    with pytest.raises(ValueError):
        read_lake(spark, lake_dir, "metformin", "elsewhere")


def test_writing_replaces_only_its_partition(spark, tmp_path, records):
    base = str(tmp_path / "lake")
    rows = records.select("*", F.lit("b").alias("icb_name"), F.lit("EPD_202401").alias("resource"))
    write_bronze(rows, base, "nhsbsa_epd")
    write_bronze(rows.filter("drug = 'metformin'").limit(1), base, "nhsbsa_epd")
    assert values(read_bronze(spark, base).groupBy("drug").count(), "drug", "count") == [
        ("atorvastatin", 2), ("metformin", 1),
    ]
    text = open(next(p for p in _files(base) if "atorvastatin" in p)).read()
    assert len(read_lake(spark, base, "atorvastatin", "nhsbsa_epd").columns) == len(RAW_RECORD) and text
    with pytest.raises(ValueError):
        write_bronze(rows, base, "elsewhere")


def _files(base):
    return [os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if f.startswith("part-")]


def test_explicit_nulls_survive_in_bronze(spark, tmp_path, records):
    base = str(tmp_path / "lake")
    rows = records.select("*", F.lit(None).cast("string").alias("icb_name"), F.lit("R").alias("resource"))
    write_bronze(rows, base, "nhsbsa_epd")
    assert any('"actual_cost":null' in open(p).read() for p in _files(base))


def test_page_document_forms(spark, tmp_path):
    base = tmp_path / "lake"
    os.makedirs(base / "metformin")
    os.makedirs(base / "aspirin")
    page = {"url": "u", "page_type": "side_effects", "heading": "H", "text": "T", "bullets": ["a"]}
    (base / "metformin" / "nhs_pages.json").write_text(
        json.dumps({"drug": "metformin", "type": "nhs_pages", "pages": [page, {"page_type": "interactions"}]}, indent=2)
    )
    (base / "aspirin" / "nhs_pages.json").write_text(json.dumps({"pages": [page]}))
    got = read_sections(spark, str(base)).collect()
    assert sorted((r["drug"], r["page_type"], r["heading"], len(r["bullets"])) for r in got) == [
        ("aspirin", "side_effects", "H", 1), ("metformin", "interactions", "", 0), ("metformin", "side_effects", "H", 1),
    ]
    assert read_lake(spark, str(base), "metformin", "nhs_pages").count() == 2
    with pytest.raises(FileNotFoundError):
        read_sections(spark, str(base), "nothing")


def test_html_pages_round_trip_as_documents(spark, tmp_path):
    pages = spark.createDataFrame(
        [("metformin", "http://x/side-effects-of-metformin/", "<main><h2>A</h2><p>b</p><h2>C</h2></main>")],
        "drug string, url string, html string",
    )
    write_bronze(page_documents(pages), str(tmp_path / "p"), "nhs_pages")
    assert values(read_sections(spark, str(tmp_path / "p")), "drug", "page_type", "heading", "text") == [
        ("metformin", "side_effects", "A", "b"), ("metformin", "side_effects", "C", ""),
    ]


def test_router_refuses_unknown_kinds(spark, tmp_path):
    envelope = spark.createDataFrame(
        [("odd", None, "d", "r", [], [])],
        "type string, source string, drug string, resource string, "
        "records array<struct<date:string>>, pages array<struct<url:string>>",
    )
    with pytest.raises(ValueError):
        route_payloads(envelope, str(tmp_path / "a"), str(tmp_path / "b"))
    assert not os.path.exists(tmp_path / "a")


def test_inventory(spark, lake_dir, tmp_path):
    rows = {(r["drug"], r["file"]): r for r in lake_inventory(spark, lake_dir).collect()}
    assert set(rows) == {
        ("metformin", "EPD_202505/prescribing.jsonl"), ("metformin", "EPD_202506/prescribing.jsonl"),
        ("metformin", "prescribing.jsonl"), ("aspirin", "EPD_202506/prescribing.jsonl"),
    }
    for (drug, name), row in rows.items():
        size = os.path.getsize(os.path.join(lake_dir, drug, name))
        assert (row["size_bytes"], row["size_kb"]) == (size, round(size / 1024, 1))
    assert lake_inventory(spark, str(tmp_path / "missing")).count() == 0
    parts = {r["drug"]: (r["partitions"], r["flat_files"]) for r in lake_partitions(spark, lake_dir).collect()}
    assert parts == {
        "metformin": (["EPD_202505", "EPD_202506"], ["prescribing.jsonl"]), "aspirin": (["EPD_202506"], []),
    }


def test_medicine_keys(spark):
    keys = ["metformin", "co-amoxiclav", "metformin2", "Metformin", "-x", "a", "", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(drug_key_ok(F.col("k"))).collect()] == [True, True] + [False] * 6


def _mixed_folder(tmp_path, n=3):
    """Files of one folder in three column orders, one without two columns, one with a mark before its header, one empty."""
    headers = [list(LEDGER_CSV_HEADER), list(LEDGER_CSV_HEADER)[::-1], [c for c in LEDGER_CSV_HEADER if c not in ("ICB_NAME", "ADDRESS_1")]]
    for i in range(n):
        header = headers[i % 3]
        _write_csv(tmp_path / f"EPD_2024{i + 1:02d}.csv", header, [_row(practice=f"P{i}", items=str(i), YEAR_MONTH=f"2024{i + 1:02d}")])
    marked = tmp_path / "EPD_202400.csv"
    _write_csv(marked, headers[1], [_row(practice="M", items="77")])
    marked.write_text("\ufeff" + marked.read_text())
    (tmp_path / "EPD_209912.csv").write_text("")


@pytest.mark.parametrize("form", ["folder", "glob", "list"])
def test_csv_files_in_other_column_orders_are_read_by_name(spark, tmp_path, form):
    _mixed_folder(tmp_path)
    files = [str(p) for p in sorted(tmp_path.iterdir())]
    df = read_epd_csv(spark, {"folder": str(tmp_path), "glob": f"{tmp_path}/*.csv", "list": files}[form])
    assert values(df, "row_id", "items", "actual_cost", "icb_name", "resource") == [
        ("M", 77, 12.5, "Board, North", "EPD_202400"), ("P0", 0, 12.5, "Board, North", "EPD_202401"),
        ("P1", 1, 12.5, "Board, North", "EPD_202402"), ("P2", 2, 12.5, "", "EPD_202403"),
    ]


def test_headers_of_any_number_of_files_take_one_job(spark, tmp_path):
    _mixed_folder(tmp_path, 30)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("headers", "x")
    try:
        found = csv_headers(spark, [str(tmp_path)])
        jobs = tracker.getJobIdsForGroup("headers")
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds]
    finally:
        context._jsc.clearJobGroup()
    assert len(found) == 3 and sorted(map(len, found.values())) == [10, 10, 11]
    assert tasks == [31]  # Spark leaves out the empty file


def test_headers_read_only_the_beginning_of_a_file(spark, tmp_path):
    with open(tmp_path / "big.csv", "w") as out:
        out.write("A,B\n")
        for _ in range(200):
            out.write("1,2\n" * 100_000)
    import time

    csv_headers(spark, [str(tmp_path)])
    began = time.time()
    assert list(csv_headers(spark, [str(tmp_path)])) == ["A,B"]
    assert time.time() - began < 10


def test_folder_without_headers_has_no_rows(spark, tmp_path):
    (tmp_path / "EPD_202401.csv").write_text("\n\n")
    assert read_epd_csv(spark, str(tmp_path)).collect() == []


def test_header_job_sends_no_lines_to_python(spark, tmp_path, monkeypatch):
    """Lines behind the header stay beside the scan; blank lines and a byte order mark before it are passed over."""
    from pyspark.sql.classic.dataframe import DataFrame

    (tmp_path / "a.csv").write_text("\n \t\n\ufeffA,B \n1,2\n")
    (tmp_path / "b.csv").write_text("A,B\n3,4\n")
    for name in ("mapInPandas", "mapInArrow"):
        monkeypatch.delattr(DataFrame, name)
    found = csv_headers(spark, [str(tmp_path)])
    assert {k: len(v) for k, v in found.items()} == {"A,B": 2}


def test_lake_files_are_small_and_read_back(spark, tmp_path):
    rows = spark.range(5000).selectExpr("'2024-01-01' AS date", "1.5 AS actual_cost", "'m' AS drug", "'EPD_202401' AS resource")
    write_bronze(rows, str(tmp_path), "nhsbsa_epd", "gzip")
    sizes = [f.stat().st_size for f in tmp_path.rglob("part-*")]
    assert 0 < sum(sizes) < 5000 * 10
    assert read_bronze(spark, str(tmp_path)).filter("date = '2024-01-01' AND drug = 'm'").count() == 5000
