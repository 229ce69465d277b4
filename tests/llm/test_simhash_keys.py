"""Keys that many fingerprints share: blocks of bounded size find the same components as all pairs do."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from doseledger.llm import simhash


def smallest_reached(prints):
    """The smallest print that each print reaches over pairs within three bits, by comparing all pairs."""
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 3) for p in prints]
    least = prints.copy()
    while True:
        step = np.array([least[n].min() for n in near])
        if (step == least).all():
            return {int(p): int(x) for p, x in zip(prints, least)}
        least = step


def from_links(prints, links):
    root = {int(p): int(p) for p in prints}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


def frame(spark, prints):
    return spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long").repartition(3)


def linked(df):
    return [(r["a"] % 2**64, r["b"] % 2**64) for r in df.collect()]


@pytest.mark.parametrize("block", [1, 7, 200, 4096])
def test_blocks_give_the_components_of_all_pairs(spark, block):
    gen = np.random.default_rng(5)
    n = 60 if block == 1 else 2500
    # one exact segment and, for most, one codeword; 21 free bits leave many components
    crowd = gen.integers(0, 2**21, n, dtype=np.uint64) << np.uint64(43) | np.uint64(12345)
    prints = np.unique(np.concatenate([crowd, gen.integers(0, 2**63, 300, dtype=np.uint64)]))
    found = from_links(prints, linked(simhash.links(frame(spark, prints), block)))
    assert found == smallest_reached(prints)
    assert 1 < len(set(found.values())) < len(prints) or n == 60


def test_forest_of_two_sides():
    gen = np.random.default_rng(6)
    both = np.unique(gen.integers(0, 2**12, 300, dtype=np.uint64))
    a, b = both[::2], both[1::2]
    across = simhash._forest(a, b)
    assert all((x ^ y).bit_count() <= 3 for x, y in across) and len(across) < len(both)
    own = simhash._forest(a) + simhash._forest(b)
    assert from_links(both, [*across, *own]) == smallest_reached(both)
    assert simhash._forest(a[:0], b) == [] and simhash._forest(a, b[:0]) == []


def test_a_key_of_twenty_thousand_prints_stays_in_bounded_cells(spark):
    gen = np.random.default_rng(7)
    prints = np.unique(gen.integers(0, 2**21, 20_300, dtype=np.uint64))[:20_000] << np.uint64(43)
    full = spark.createDataFrame(
        [(1, i // simhash.BLOCK, int(p)) for i, p in enumerate(prints.view(np.int64))], "key long, block long, fp long"
    )
    cell = simhash.cells(full).groupBy("key", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    n, most, pairs = cell.agg(F.count(F.lit(1)), F.max("n"), F.sum(F.when(F.col("lo") == F.col("hi"), F.col("n")))).first()
    blocks = -(-len(prints) // simhash.BLOCK)
    assert (n, pairs) == (blocks * (blocks + 1) // 2, len(prints)) and most <= 2 * simhash.BLOCK
    # with about 15 neighbours each, nearly all are one component
    found = from_links(prints, linked(simhash.links(frame(spark, prints))))
    assert found == smallest_reached(prints)
