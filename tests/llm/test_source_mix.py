"""Mixed rows keep their own columns and their own blanks."""

import collections

import pytest
from pyspark.sql import functions as F

from doseledger.llm import source_mix


def test_rows_that_differ_in_other_columns(spark):
    body = "\tone two\nthree  four\n\nfive " * 40
    rows = [(1, body, "a", lang, {"k": lang}) for lang in ("en", "de", None)] + [(2, body + "x", "b", "fr", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, more map<string,string>")
    mixed = source_mix.mix(docs, shard_words=10**6).collect()
    words = collections.Counter()
    for r in mixed:
        words[r["lang"]] += len(r["text"].split())
        assert (body + "x").startswith(r["text"])
    planned = collections.Counter()
    for r in source_mix.plan_mix(docs, shard_words=10**6).collect():
        planned[r["source"]] += r["taken"]
    assert planned["a"] == words["en"] + words["de"] + words[None] and planned["b"] == words["fr"]
    assert all(words[x] for x in ("en", "de", None))
    assert all(r["more"] == ({"k": r["lang"]} if r["doc_id"] == 1 else None) for r in mixed)
    assert any(len(r["text"].split()) not in (200, 201) for r in mixed)


def plain_targets(sizes, share=1.5, most=2.0):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    left, full = list(range(len(sizes))), set()
    while True:
        budget = share * sum(sizes) - sum(most * sizes[i] for i in full)
        open_weight = sum(weights[i] for i in left if i not in full)
        level = budget / open_weight if open_weight else float("inf")
        over = {i for i in left if i not in full and weights[i] * level >= most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in full else weights[i] * level for i in left]
        full |= over


@pytest.mark.parametrize("sizes", [[10, 100], [5, 0, 7, 900, 3, 3], [0, 0], [4], [1, 2, 4, 8, 16, 32, 64, 128]])
def test_targets(spark, sizes):
    names = [*(f"s{i:03d}" for i in range(len(sizes) - 1)), None]
    totals = spark.createDataFrame(list(zip(names, sizes)), "source string, words long")
    got = sorted(source_mix.source_targets(totals).collect(), key=lambda r: r["rank"])
    assert [r["source"] for r in got] == names
    assert [r["target"] for r in got] == pytest.approx(plain_targets(sizes))


def test_rare_sources_reach_their_targets(spark):
    big = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"), F.lit("big").alias("source"))
    small = spark.range(1000, 1300).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("small").alias("source"))
    for shard_words, cell_words in ((10**6, 16_384), (2000, 16_384), (2000, 500)):
        out = source_mix.plan_mix(big.unionByName(small), shard_words=shard_words, cell_words=cell_words)
        taken = {r["source"]: r for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
        assert all(abs(r["taken"] - r["target"]) <= 16 for r in taken.values()), taken
        assert out.filter("taken > 2 * size").count() == 0


def test_many_sources(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 40).alias("text"), F.format_string("host%06d", "id").alias("source"))
    out = source_mix.plan_mix(docs, shard_words=200_000)
    far = out.groupBy("source").agg(F.abs(F.sum("taken") - F.max("target")).alias("far")).agg(F.max("far"), F.count(F.lit(1))).first()
    assert far[0] <= 16 and far[1] == 200_000
