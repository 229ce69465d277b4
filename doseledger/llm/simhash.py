"""SimHash near-duplicates with Golay-code keys.

A fingerprint has 64 bits; two link if at most three differ. It is cut into segments of 22, 21 and 21 bits. The perfect
(23,12) Golay code maps every segment to a nearest codeword, and a segment gets as keys the codewords of itself and of its one-bit
neighbours (one key, or six near a border), so that segments with one error share a key. Three errors
over three segments leave either a segment without errors and another with one at most, or one error in each:

* exact segment + Golay key of another segment (six ordered pairs of segments), or
* Golay key of the first segment + an exact half of each of the other two (four pairs of halves).

Keys keep about 33 bits of selectivity. Rows are distinct fingerprints, so copies cost nothing here. Inside one key, fingerprints are
verified by counting differing bits, and only links that join parts not yet joined leave the task. The prints of a key
with more than ``BLOCK`` are numbered in blocks, and every two blocks of it meet in a cell of their own, a task of bounded size. Components are found by star contraction over written
tables, whose edges shrink; no links pass the driver.

Defined cases: a null text is an empty one; texts without words have fingerprint zero and link like others; a null id counts only
if all ids of a component are null; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseledger.llm.common import carried, ship_package
from doseledger.session import write_scratch

SHINGLE, SEED, MOST = 3, 42, 3
#: (first bit, width) of each segment, and of the halves of the second and third
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALVES = (((22, 11), (33, 10)), ((43, 11), (54, 10)))
GENERATOR = 0b110001110101  # fixed value: generator polynomial of the (23,12) Golay code
#: most prints of a key that one task compares with each other; fuller keys go by pairs of such blocks
BLOCK = 4096


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*(words[i:] for i in range(SHINGLE)))]
    counts, block = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(shingles), block):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles[at : at + block]), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprints(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long")(text)


@lru_cache(1)
def nearest_codeword() -> np.ndarray:
    """For each 23-bit word the message of the one codeword within three bits."""
    message = np.arange(4096, dtype=np.int64)
    rest = message << 11
    for bit in range(22, 10, -1):  # remainder of the division by the generator
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    codewords = message << 11 | rest
    errors = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)]
    table = np.zeros(1 << 23, np.uint16)
    for error in errors:
        table[codewords ^ error] = message
    return table


def segment_keys(values: np.ndarray, width: int) -> np.ndarray:
    """(n, width + 1) codeword numbers of values and their one-bit neighbours; repeats are -1."""
    flips = np.array([0] + [1 << b for b in range(width)], np.int64)
    keys = np.sort(nearest_codeword()[values.astype(np.int64)[:, None] ^ flips].astype(np.int64), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def _bits(prints: np.ndarray, first: int, width: int) -> np.ndarray:
    return (prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)


def link_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys): prints within three bits share a key. Keys are numbers of 38 bits at most."""
    rows, keys = [], []
    golay = [segment_keys(_bits(prints, *s), s[1]) for s in SEGMENTS]
    exact = [_bits(prints, *s) for s in SEGMENTS]
    kinds = [(exact[i], golay[j], 21) for i in range(3) for j in range(3) if i != j]
    kinds += [(_bits(prints, *a) << 11 | _bits(prints, *b), golay[0], 22) for a in HALVES[0] for b in HALVES[1]]
    for kind, (whole, near, _) in enumerate(kinds):
        at, slot = np.nonzero(near >= 0)
        rows.append(at)
        keys.append((np.int64(kind) << 34 | whole[at] << 12) | near[at, slot])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(np.int64).view(np.uint64)
        for at in range(0, len(prints), 4096):
            part = prints[at : at + 4096]
            rows, keys = link_keys(part)
            yield pd.DataFrame({"key": keys, "fp": part[rows].view(np.int64)})


def _forest(prints: np.ndarray, others: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what lies within three bits of each other, each joining two parts.

    With ``others``, only pairs of one print of each side are compared.
    """
    if others is None and len(prints) == 2:
        return [(int(prints[0]), int(prints[1]))] if int(prints[0] ^ prints[1]).bit_count() <= MOST else []
    start = 1 if others is None else len(prints)
    nodes = prints if others is None else np.concatenate([prints, others])
    part, out = np.arange(len(nodes)), []
    for x in range(start, len(nodes)):
        near = np.flatnonzero(np.bitwise_count(nodes[: x if others is None else start] ^ nodes[x]) <= MOST)
        parts = part[near]
        # most often all neighbours are of one part already
        while len(parts):
            out.append((int(nodes[x]), int(nodes[near[0]])))
            part[part == part[x]] = parts[0]
            apart = parts != parts[0]
            near, parts = near[apart], parts[apart]
    return out


def _pairs(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    a = np.array(pairs, np.uint64).reshape(-1, 2)
    return pd.DataFrame({"a": a[:, 0].view(np.int64), "b": a[:, 1].view(np.int64)})


def _linked(block: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Links of keys with at most ``block`` prints; the prints of fuller keys go on as numbered blocks (``block`` -1: a link)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by key; a key may go on in the next batch
        key, held, n = None, np.empty(0, np.uint64), 0

        def close() -> pd.DataFrame:
            return numbered(key, held, n) if n else links_of(_forest(held))

        def links_of(pairs):
            return _pairs(pairs).assign(key=np.int64(0), block=np.int64(-1))

        def numbered(key, prints, first):
            own = first + np.arange(len(prints), dtype=np.int64) // block
            return pd.DataFrame({"a": prints.view(np.int64), "b": np.int64(0), "key": np.int64(key), "block": own})

        for batch in batches:
            keys = batch["key"].to_numpy(np.int64)
            prints = batch["fp"].to_numpy(np.int64).view(np.uint64)
            if not len(keys):
                continue
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            pairs = []
            # keys that begin and end inside the batch
            inner = np.flatnonzero(np.diff(starts[1:-1]) > 1) + 1
            for s, e in zip(starts[inner], starts[inner + 1]):
                if e - s <= block:
                    pairs += _forest(prints[s:e])
                else:
                    yield numbered(keys[s], prints[s:e], 0)
            if pairs:
                yield links_of(pairs)
            # the first and the last key may reach over the borders
            for s, e in sorted({(int(starts[0]), int(starts[1])), (int(starts[-2]), int(starts[-1]))}):
                if key != keys[s]:
                    if len(held):
                        yield close()
                    key, held, n = keys[s], np.empty(0, np.uint64), 0
                held = np.concatenate([held, prints[s:e]])
                if len(held) > block:
                    whole = (len(held) - 1) // block
                    yield numbered(key, held[: whole * block], n)
                    held, n = held[whole * block :], n + whole
        if len(held):
            yield close()

    return run


def _cell_links(cell: pd.DataFrame) -> pd.DataFrame:
    prints = cell["fp"].to_numpy(np.int64).view(np.uint64)
    second = (cell["block"] == cell["hi"]).to_numpy()
    if cell["lo"].iloc[0] == cell["hi"].iloc[0]:
        return _pairs(_forest(prints))
    return _pairs(_forest(prints[~second], prints[second]))


def cells(full: DataFrame) -> DataFrame:
    """Prints of full keys (key, block, fp) in cells of two blocks (key, lo, hi): every two blocks of a key meet in one cell.

    The number of blocks is joined by key and block, so that no task gets a whole key.
    """
    blocks = full.groupBy("key").agg(F.max("block").alias("last")).select("key", "last", F.explode(F.sequence(F.lit(0), "last")).alias("block"))
    paired = full.join(blocks, ["key", "block"]).withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    return paired.select("key", "block", "fp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that span every component.

    No task compares more than two blocks of ``block`` prints at a time, however many prints a key has.
    """
    keyed = prints.select("fp").mapInPandas(_keyed, "key long, fp long")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key")
    judged = write_scratch(sorted_keys.mapInPandas(_linked(block), "a long, b long, key long, block long"), "links")
    full = judged.filter("block >= 0").select("key", "block", F.col("a").alias("fp"))
    apart = cells(full).groupBy("key", "lo", "hi").applyInPandas(_cell_links, "a long, b long")
    return judged.filter("block < 0").select("a", "b").unionByName(apart).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternates two contractions until every edge ends at a root: each node's larger neighbours, then its
    smaller ones, are hung on the smallest neighbour. Minimum per node is one aggregate with map-side combine.
    """
    step = write_scratch(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = step.select("u", "v").unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_scratch(large, "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = write_scratch(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        n, total, mixed = step.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.hash("u", "v"))).first()
        if (n, total, mixed) == before:
            break
        before = (n, total, mixed)
    return step.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        step.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def grouped(per_print: DataFrame, roots: DataFrame) -> DataFrame:
    """fp, component_id, root of every print of ``per_print`` (fp, first_id): the smallest id of its component."""
    named = per_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return write_scratch(named.select("fp", "root").join(least, "root").select("fp", "component_id", "root"), "component-ids")


def first_of_each(kept: DataFrame) -> DataFrame:
    """The first row of each root by text, with its own columns."""
    # few rows share an id; only the first of each task goes on
    one = Window.partitionBy("root").orderBy(F.xxhash64("row.text"), F.to_json("row"))
    return kept.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (signed 64 bits), component_id (smallest id it reaches), root (a print that names the component)."""
    ship_package(docs.sparkSession)
    rows = write_scratch(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "fingerprints")
    per_print = write_scratch(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = write_scratch(components(links(per_print)), "components")
    ids = grouped(per_print, roots)
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: that of its smallest id; of rows with this id, the one of smallest text.

    Rows with a null id whose whole component has none are told apart by text as well.
    """
    judged = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = judged.select(F.col("doc_id").alias("k_id"), F.col("fp").alias("k_fp"), "root").distinct()
    rows = carried(docs, id=F.col("doc_id"), fp=fingerprints(F.col("text")))
    kept = rows.join(keys, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("fp") == F.col("k_fp")))
    # few rows share an id; only the first of each task goes on
    one = Window.partitionBy("root").orderBy(F.xxhash64("row.text"), F.to_json("row"))
    return kept.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")


def op8_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
