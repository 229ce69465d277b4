import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from doseledger.operators import contracts

GOOD = {"date": "2025-01-01", "actual_cost": 12.5, "items": 3, "quantity": 28.0, "row_id": "A1",
        "setting": "4", "ccg": "03V", "drug": "metformin"}


def _lines(spark, docs):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return spark.createDataFrame(list(enumerate(texts)), "i int, value string")


def _without(field):
    return {k: v for k, v in GOOD.items() if k != field}


CASES = [
    GOOD,
    {**GOOD, "actual_cost": None, "items": None},
    {**GOOD, "actual_cost": "100", "items": "7"},
    {**GOOD, "actual_cost": " 1.5 ", "items": "7.0"},
    {**GOOD, "items": 12.0},
    {**GOOD, "items": 12.5},
    {**GOOD, "items": "12.5"},
    {**GOOD, "items": True, "actual_cost": True},
    {**GOOD, "actual_cost": "xyz"},
    {**GOOD, "actual_cost": ""},
    {**GOOD, "actual_cost": [1]},
    {**GOOD, "quantity": {"a": 1}},
    {**GOOD, "extra": {"deep": 1}},
    {**GOOD, "setting": None},
    {**GOOD, "setting": 4},
    {**GOOD, "date": None},
    {**GOOD, "date": 202506},
    _without("setting"),
    _without("drug"),
    _without("row_id"),
    _without("actual_cost"),
    {},
]


def _accepted(doc):
    """The contract stated as a type-checked model."""
    pydantic = pytest.importorskip("pydantic")
    model = pydantic.create_model(
        "Record",
        date=(str, ...), actual_cost=(float | None, None), items=(int | None, None),
        quantity=(float | None, None), row_id=(str, ...), setting=(str, ""), ccg=(str, ""),
        icb_name=(str, ""), drug=(str, ...),
    )
    try:
        return model.model_validate(doc).model_dump()
    except pydantic.ValidationError:
        return None


def test_records_agree_with_a_typed_model(spark):
    rows = contracts.contract_records(_lines(spark, CASES)).orderBy("i").collect()
    for row, doc in zip(rows, CASES):
        expected = _accepted(doc)
        assert (not row["violations"]) == (expected is not None), doc
        if expected is not None:
            assert {k: row[k] for k in expected} == expected


def test_broken_rules_are_named(spark):
    docs = [{**_without("drug"), "actual_cost": "xyz", "setting": None}, '{"date": "20', "[1]", "3", ""]
    rows = contracts.contract_records(_lines(spark, docs)).orderBy("i").collect()
    assert rows[0]["violations"] == ["actual_cost: not a number", "setting: not text", "drug: text required"]
    assert [r["violations"] for r in rows[1:]] == [["not a JSON object"]] * 4


def test_lines_with_more_than_one_value_are_refused(spark):
    good = json.dumps(GOOD)
    within = json.dumps({**GOOD, "ccg": "a} b {c", "setting": '}"x'})
    docs = [good + " x", good + good, good + ', {"drug": "other"}', within, "  " + good + " \t", good[:-1] + ', "more": [{"a": 1}, {"b": {}}]}',
            good.replace('"', "'"), good.replace("12.5", "NaN"), "null", good[:-1] + ', "drug": "twice"}']
    rows = contracts.contract_records(_lines(spark, docs)).orderBy("i").collect()
    refused = [r["violations"] == ["not a JSON object"] for r in rows]
    assert refused == [True, True, True, False, False, False, True, True, True, False]
    assert rows[9]["drug"] == "twice" and rows[3]["ccg"] == "a} b {c"


def test_records_are_parsed_once(spark):
    plan = contracts.contract_records(_lines(spark, CASES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_written_quarantine_equals_the_split(spark, tmp_path):
    checked = contracts.contract_records(_lines(spark, CASES))
    for own, want in zip(contracts.write_quarantine(checked, str(tmp_path / "q")), contracts.quarantine_split(checked)):
        assert own.columns == want.columns
        assert sorted(map(repr, own.collect())) == sorted(map(repr, want.collect()))


def test_split_keeps_every_row(spark):
    checked = contracts.contract_records(_lines(spark, CASES))
    valid, rejected = contracts.quarantine_split(checked)
    assert valid.count() + rejected.count() == len(CASES)
    assert rejected.filter(F.size("violations") == 0).count() == 0 and "violations" not in valid.columns


def test_one_bad_record_refuses_its_batch(spark):
    lines = _lines(spark, [GOOD, GOOD, {**GOOD, "items": "x"}]).select(
        F.when(F.col("i") == 0, "one").otherwise("two").alias("batch_drug"), F.lit("R").alias("batch_resource"), "value"
    )
    headers = spark.createDataFrame(
        [("one", "R", "C1", "nhsbsa_epd", 1), ("two", "R", "C2", "nhsbsa_epd", 2), ("empty", "R", "C3", "nhsbsa_epd", 0),
         ("neg", "R", "C4", "nhsbsa_epd", -1), ("other", "R", "C5", "elsewhere", 0)],
        "drug string, resource string, bnf_code string, source string, total_rows bigint",
    )
    checked = contracts.contract_records(lines)
    verdicts = contracts.contract_batch(headers, checked)
    assert values(verdicts, "drug", "accepted") == [
        ("empty", True), ("neg", False), ("one", True), ("other", False), ("two", False),
    ]
    assert contracts.accepted_records(checked, verdicts).count() == 1


def test_pages(spark):
    page = {"url": "u", "page_type": "side_effects"}
    docs = [
        {"drug": "d", "type": "nhs_pages", "pages": [page, {**page, "page_type": "odd"}, {**page, "bullets": ["a", "b"]}]},
        {"drug": "d", "type": "nhs_pages", "pages": []},
        {"drug": "d", "type": "other", "pages": []},
        {"drug": "d", "type": "nhs_pages", "pages": [{**page, "bullets": [1]}, {"page_type": "interactions"}, {**page, "text": None}]},
        {"drug": "d", "type": "nhs_pages"},
        "broken",
    ]
    rows = contracts.contract_pages(_lines(spark, docs)).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["i"], []).append(r)
    assert [len(by_doc.get(i, [])) for i in range(6)] == [3, 0, 1, 3, 1, 1]
    first = sorted(by_doc[0], key=lambda r: (len(r["violations"]), len(r["bullets"])))
    assert (first[0]["heading"], first[0]["bullets"], first[1]["bullets"]) == ("", [], ["a", "b"])
    assert first[2]["violations"] == ["page_type: not one of side_effects, contraindications, interactions"]
    assert by_doc[2][0]["violations"] == ["type: not one of nhs_pages"]
    assert all(r["violations"] for r in by_doc[3])
    assert by_doc[4][0]["violations"] == ["pages: list required"]
    assert by_doc[5][0]["violations"] == ["not a JSON object"]
