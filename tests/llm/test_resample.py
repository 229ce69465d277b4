"""Resampling against a plain version: nulls, empty and very long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from doseledger.llm import resample

rng = random.Random(11)
WORDS = ["river", "Stone", "été", "x1", "under", "glass", "oak", "the"]
COLUMNS = "doc_id long, text string, weight long, score string, row string, th long, rank long"


def prose(n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))


ROWS = [(i, prose(rng.randint(0, 60))) for i in range(60)]
ROWS += [(60, None), (61, ""), (62, "?! \n"), (63, prose(40_000)), (None, prose(30)), (None, None), ROWS[4], ROWS[4], (4, prose(25)), (-7, prose(22))]
TARGET = [(1, "the river, the Glass!"), (2, None), (3, prose(50))]


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, runs):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in range(1, runs + 1) for i in range(len(own) - n + 1)]


def plain(rows, target, runs, buckets, least, percent, seed):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, runs))

    s, t = counts(r[1] for r in rows), counts(r[1] for r in target)
    of, to = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (of + buckets) / ((s[b] + 1) * (to + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        own = features(text, runs)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, weight + noise, None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def run(spark, rows, target, **options):
    docs = spark.createDataFrame([(*r, 1, "s", "r", 2, 3) for r in rows], COLUMNS).repartition(3)
    bench = spark.createDataFrame(target, "item_id long, text string")
    out = resample.resample(docs, bench, **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("runs,percent", [(1, 10), (1, 60), (2, 100), (3, 33)])
def test_equal_to_plain(spark, runs, percent):
    # a document with id 4 of other words, so that no two different rows tie in score and id
    got = run(spark, ROWS, TARGET, runs=runs, buckets=97, percent=percent)
    assert got == plain(ROWS, TARGET, runs, 97, 20, percent, 2024)


def test_ties_go_to_smaller_ids(spark, monkeypatch):
    # without noise all equal texts tie
    from pyspark.sql import functions as F

    monkeypatch.setattr(resample, "gumbel", lambda doc_id, seed: F.lit(0).cast("long"))
    rows = [(i, "the oak " * 12) for i in [*range(50, 0, -1), None, 2**63 - 1]]
    got = run(spark, rows, TARGET, percent=96)  # 49 of 52
    assert {r[0]: r[4] for r in got if r[4]} == {i: i for i in range(1, 50)}
    got = run(spark, rows, TARGET, percent=99)  # 51: a null id is larger than all others
    assert {r[0] for r in got if r[4] is None} == {None}
    same = run(spark, [(1, "the oak " * 12)] * 30, TARGET, percent=50)
    assert sorted(r[4] for r in same if r[4]) == list(range(1, 16))


def test_empty_tables(spark):
    assert run(spark, [], TARGET) == []
    got = run(spark, ROWS, [], buckets=97)
    assert got == plain(ROWS, [], 1, 97, 20, 10, 2024)
    assert all(r[4] is None for r in run(spark, ROWS[:4], TARGET, percent=0))


def test_pieces_hold_every_feature_once(monkeypatch):
    monkeypatch.setattr(resample, "PIECE", 16)
    for text in (prose(200), "a" * 100 + " b " + "c" * 40, "", "   ", "one two " * 50):
        for n in (1, 2, 4):
            got = Counter(f.decode() for piece in resample.feature_pieces(text, n) for f in piece)
            assert got == Counter(features(text, n))


def test_cutoff_is_exact(spark):
    gen = np.random.default_rng(3)
    values = [int(v) for v in [*gen.integers(-(2**62), 2**62, 40), *[7] * 20, *range(20)]]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for want in (1, 13, 39, 40, 41, 60, 80):
        cutoff, above = resample._highest(df, "v", want)
        assert cutoff == ordered[want - 1] and above == sum(v > cutoff for v in values)
