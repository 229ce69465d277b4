import random

from conftest import values
from pyspark.sql import functions as F

from doseledger.functions import months
from doseledger.functions.casting import (
    double_to_bigint,
    round_half_away,
    safe_float,
    safe_int,
    safe_ratio,
    text_to_bigint,
    text_to_double,
)
from doseledger.functions.months import iso_date, month_key
from doseledger.functions.ordering import first_rows, number_rows
from doseledger.functions.text import section_text, tokenise


def _map(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_text_numbers(spark):
    texts = ["12.5", "-12.5", "1e3", "12d", "0x10", " 7 ", "", None, "n/a", "NULL"]
    assert _map(spark, text_to_double, texts) == [12.5, -12.5, 1000.0, None, None, 7.0, None, None, None, None]
    assert _map(spark, text_to_bigint, texts) == [13, -13, 1000, None, None, 7, None, None, None, None]
    assert _map(spark, safe_float, texts)[:3] == [12.5, -12.5, 1000.0]
    assert _map(spark, safe_int, ["12.7", "-12.7", "x", "nan", "inf"]) == [12, -12, None, None, None]


def test_large_whole_numbers_keep_their_digits(spark):
    assert _map(spark, text_to_bigint, ["9007199254740993", "9223372036854775808"]) == [9007199254740993, None]


def test_double_to_bigint_rounds_half_to_even(spark):
    assert _map(spark, double_to_bigint, [12.5, 13.5, -0.5, 1e30], "double") == [12, 14, 0, None]


def test_rounding_scales_before_it_rounds(spark):
    out = _map(spark, lambda c: round_half_away(c, 2), [1.005, 2.675, -1.115, None], "double")
    assert out == [1.0, 2.68, -1.12, None]


def test_ratio_is_null_without_items(spark):
    df = spark.createDataFrame([(10.0, 4), (10.0, 0), (None, 4), (10.0, None)], "c double, i bigint")
    assert [r[0] for r in df.select(safe_ratio(F.col("c"), F.col("i"))).collect()] == [2.5, None, None, None]


def test_month_keys_of_both_date_forms(spark):
    texts = ["202506", "20256", "202513", "2024-01-31", "2024-1-5", "2024/01/05", "2024-02-30", "2024", "", None]
    assert _map(spark, month_key, texts) == [
        "2025-06", "2025-06", None, "2024-01", "2024-01", "2024-01", None, None, None, None,
    ]


def test_dates_with_and_without_the_pattern_agree(spark):
    """The short cut for ``YYYY-MM-DD`` and for text without dash or slash gives what the pattern gives."""
    drawn, forms = random.Random(3), ("2024-01-05", "2024/01/05", "2024-1-5", " 2024-01-0", "2024-01-05 10:30", "202401")
    texts = list(forms)
    for _ in range(4000):
        text = list(drawn.choice(forms))
        for _ in range(drawn.randint(0, 2)):
            text[drawn.randrange(len(text))] = drawn.choice("0139-/ T\t+:é")
        texts.append("".join(text))

    def by_pattern(text):
        return F.when(text.rlike(months._ISO), F.translate(F.trim(text), "/", "-").try_cast("date"))

    assert _map(spark, iso_date, texts) == _map(spark, by_pattern, texts)
    frame = spark.createDataFrame([("2024-01-05",)], "v string").select(iso_date(F.col("v")))
    assert "length(v" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_compact_month_is_no_date(spark):
    assert [str(v) for v in _map(spark, iso_date, ["202506", "2024-01-05", "2024"])] == [
        "None", "2024-01-05", "None",
    ]


def test_tokenise_cases(spark):
    texts = ["Nausea and NAUSEA", "abc de", "a1b2 cough3cough", "with the and", "", "éclairs déjà"]
    assert _map(spark, tokenise, texts) == [
        ["nausea", "nausea"], [], ["cough", "cough"], [], [], ["clairs"],
    ]
    assert _map(spark, lambda c: tokenise(c, ["rash"]), ["rash with fever"]) == [["with", "fever"]]
    assert _map(spark, lambda c: tokenise(c, []), ["rash with"]) == [["rash", "with"]]


def test_section_text_joins_all_parts(spark):
    df = spark.createDataFrame([("h", "t", ["a", "b"]), ("", "t", [])], "h string, t string, b array<string>")
    out = [r[0] for r in df.select(section_text(F.col("h"), F.col("t"), F.col("b"))).collect()]
    assert out == ["h t a b", " t"]


def test_number_rows_equals_a_plain_count_on_a_skewed_group(spark):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"g{i % 11}", rng.random(), i) for i in range(3000)]
    rows += [(None, rng.random(), 3000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, x double, i int").repartition(5)
    got = {r["i"]: r["row_num"] for r in number_rows(df, ["x", "i"], ["g"]).collect()}
    expected, seen = {}, {}
    for g, x, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        expected[i] = seen[g]
    assert got == expected


def test_first_rows_follow_block_order(spark):
    rows = [("a", f"f{i // 40}", 0, i % 40) for i in range(400)] + [("b", "f3", 0, i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, file string, block int, seq int").repartition(6)
    got = values(first_rows(df, ["g"], ["file", "block"], "seq", 55), "g", "file", "seq")
    expected = [("a", f"f{i // 40}", i % 40) for i in range(55)] + [("b", "f3", i) for i in range(5)]
    assert got == sorted(expected)


def test_first_rows_scan_their_input_once(spark):
    """What is returned comes from written rows; blocks cut at the limit leave nothing to those behind them."""
    df = spark.range(1000).selectExpr("id % 2 AS g", "id DIV 100 AS block", "id AS seq")
    first = first_rows(df, ["g"], ["block"], "seq", 120)
    assert "Range (" not in first._jdf.queryExecution().optimizedPlan().toString()
    assert values(first, "g", "seq") == sorted((g, s) for g in (0, 1) for s in range(g, 240, 2))
    assert values(first_rows(df, ["g"], ["block"], "seq", 7), "g", "seq") == sorted((g, s) for g in (0, 1) for s in range(g, 14, 2))
