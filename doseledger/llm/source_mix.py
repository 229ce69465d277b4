"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get shares of a word budget by weight, at most a given multiple of their own words; what a source can't
use is shared again by weight. Every shard of documents then deals its equal-word blocks to its sources: the next block goes to the
source of highest quotient target / (2 * blocks + 1). The blocks that rounding in the shards left a source short of, or gave it too
many, are then evened out over its shards, so a source ends within a block of its target however many shards there are. The
integer quotas pick blocks in a seeded order of the source's documents inside the shard: whole rounds first, then blocks from the
start of that order.

The number of shards grows with the words, so a source with a third of all rows is dealt over many tasks; a source of few
words lies in few shards, as a cell should hold many blocks. Sources are a table of their own and may be as many as documents.

Defined cases: a null text has no words; a null source is a source of its own, last in order; documents without words are taken 0
times; equal rows are dealt one after the other; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseledger.functions.ordering import number_rows
from doseledger.llm.common import BLANK_RUN, carried, ship_package, text_key
from doseledger.session import write_scratch

WEIGHTS = (3, 1, 2)


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``totals`` (source, words) with rank from 0 by code point, null last, and target.

    Words go out by weight; what a source can't hold is shared again, until none is above ``most`` times its own. Each pass
    is one sum over the table and fills further sources, so there are few, and the driver sees two numbers of each.
    """
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = number_rows(totals, [F.col("source").asc_nulls_last()], name="place")
    ranked = ranked.select("source", "words", (F.col("place") - 1).alias("rank"))
    ranked = write_scratch(ranked.withColumn("weight", weight), "sources")
    level, filled = 0.0, -1
    total = ranked.agg(F.sum("words")).first()[0] or 0
    while True:
        full = F.col("words") * most <= F.col("weight") * level
        one = ranked.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("words"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if one.n == filled or not one.open:
            break
        filled, level = one.n, max(level, (share * total - most * one.held) / one.open)
    return ranked.select("source", "rank", "words", F.when(full, F.col("words") * most).otherwise(F.col("weight") * level).alias("target"))


def sainte_lague(votes, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / (2 * seats + 1); ties go to the first.

    Rounding by the mean quotient gives all but a few seats; a heap hands out or takes back the rest.
    """
    votes = np.asarray(votes, float)
    got = np.zeros(len(votes), np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return got
    got = np.floor(votes * seats / votes.sum() + 0.5).astype(np.int64)
    rest = int(seats - got.sum())
    if rest > 0:
        heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got)) if v > 0]
        heapq.heapify(heap)
        for _ in range(rest):
            _, i = heapq.heappop(heap)
            got[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    else:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got)) if g > 0]
        heapq.heapify(heap)
        for _ in range(-rest):
            _, i = heapq.heappop(heap)
            i = -i
            got[i] -= 1
            if got[i] > 0:
                heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    return got


def _shard_quotas(block: int) -> Callable:
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("rank")
        votes = cells["votes"].to_numpy()
        cells["quota"] = sainte_lague(votes, int(np.floor(votes.sum() / block + 0.5)))
        return cells[["rank", "shard", "words", "votes", "target", "quota"]]

    return run


def _asked(quota: Column, block: int, most: float) -> Column:
    """Words that a quota of blocks takes: a word no more often than ``most``, though the last block may reach beyond."""
    return F.least(quota * block, F.floor(F.col("words") * F.lit(most)).cast("long"))


def even_out(quotas: DataFrame, block: int, most: float) -> DataFrame:
    """Quotas that come within a block of each source's target: rank, shard, words, quota.

    The cells furthest below what they were due get a block more each, those furthest above one less. A window holds one
    row per shard of a source, and a shard holds about a million words.
    """
    cells = quotas.withColumn("asked", _asked(F.col("quota"), block, most))
    of = Window.partitionBy("rank")
    missing = F.round((F.first("target").over(of) - F.sum("asked").over(of)) / block).cast("long")
    cells = cells.withColumns({"missing": missing, "due": F.col("votes") - F.col("asked"), "cells": F.count(F.lit(1)).over(of)})
    # cells that can't take or give anything come last
    more = F.col("missing") > 0
    stuck = F.when(more, F.col("asked") >= F.floor(F.col("words") * most)).otherwise(F.col("quota") == 0)
    place = F.row_number().over(of.orderBy(stuck, F.when(more, -F.col("due")).otherwise(F.col("due")), "shard"))
    blocks = F.abs("missing")
    each = F.floor(blocks / F.col("cells")) + F.when(place <= blocks % F.col("cells"), 1).otherwise(0)
    quota = F.greatest(F.lit(0), F.col("quota") + F.signum("missing").cast("long") * each).cast("long")
    return cells.select("rank", "shard", "words", quota.alias("quota"))


def row_key(docs: DataFrame, text: str = "text") -> Column:
    """A 64-bit key of all columns of a row, the text by its own key. Nulls count, and what is nested goes by its JSON."""
    own = []
    for name, kind in docs.dtypes:
        column = F.col(f"`{name}`")
        if name == text:
            column = text_key(column)
        elif kind.startswith(("map", "struct", "array")):
            column = F.to_json(F.struct(column))
        own += [column, F.col(f"`{name}`").isNull()]
    return F.xxhash64(*own)


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 16,
    shard_words: int = 1_000_000,
    cell_words: int = 16_384,
    seed: int = 42,
) -> DataFrame:
    """One row per input row: doc_id, th, rh, source, size, source_size, target, taken."""
    ship_package(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        text_key(body).alias("th"),
        row_key(docs, text).alias("rh"),
        F.regexp_count(body, F.lit(BLANK_RUN.replace("[", "[^", 1))).cast("long").alias("size"),
    )
    rows = write_scratch(rows, "word-counts")
    totals = write_scratch(rows.groupBy("source").agg(F.sum("size").alias("words")), "source-words")
    sources = write_scratch(source_targets(totals, weights, share, most), "targets")
    shards = max(1, round((totals.agg(F.sum("words")).first()[0] or 0) / shard_words))
    known = sources.select(
        F.col("source").alias("s"),
        "rank",
        F.col("words").alias("source_size"),
        "target",
        # a source lies in as many shards, one after the other, as it fills with cells
        F.greatest(F.lit(1), F.least(F.lit(shards), F.floor(F.col("words") / cell_words))).alias("own"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "rank"), F.lit(shards)).alias("first"),
    )
    order = F.xxhash64(F.lit(seed), "doc_id", "th")
    ranked = rows.join(known, rows["source"].eqNullSafe(known["s"])).drop("s")
    shard = F.pmod(F.col("first") + F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "th"), F.col("own")), F.lit(shards))
    ranked = ranked.withColumns({"order": order, "shard": shard}).drop("own", "first")
    cells = ranked.groupBy("rank", "shard", "source_size", "target").agg(F.sum("size").alias("words"))
    votes = F.when(F.col("source_size") > 0, F.col("words") * (F.col("target") / F.col("source_size"))).otherwise(0.0)
    dealt = cells.withColumn("votes", votes).groupBy("shard").applyInPandas(
        _shard_quotas(block_words), "rank long, shard long, words long, votes double, target double, quota long"
    )
    quotas = write_scratch(even_out(write_scratch(dealt, "dealt"), block_words, most), "quotas")
    placed = ranked.join(quotas, ["rank", "shard"])
    inside = Window.partitionBy("rank", "shard").orderBy("order", "doc_id", "th", "rh").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("end", F.sum("size").over(inside))
    asked = _asked(F.col("quota"), block_words, most)
    rounds = F.when(F.col("words") > 0, F.floor(asked / F.col("words"))).otherwise(0)
    more = asked - rounds * F.col("words")
    part = F.greatest(F.lit(0), F.least(F.col("size"), more - (F.col("end") - F.col("size"))))
    taken = (rounds * F.col("size") + part).cast("long")
    return placed.select("doc_id", "th", "rh", "source", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows with their own columns: one row per whole repeat; the last may hold a text's first words only.

    Rows equal in all columns share what they are given together. A text is cut at the end of its last taken word.
    """
    plan = plan_mix(docs, **options).filter("taken > 0")
    per_row = plan.groupBy("doc_id", "th", "rh").agg(F.max("size").alias("size"), F.sum("taken").alias("taken"))
    named = per_row.select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), F.col("rh").alias("m_rh"), "size", "taken")
    rows = carried(docs, id=F.col("doc_id"), th=text_key(F.coalesce("text", F.lit(""))), rh=row_key(docs))
    one = rows.dropDuplicates(["id", "th", "rh"])
    met = one.join(named, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")) & (F.col("rh") == F.col("m_rh")))
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    # each word with the blanks before it
    spaced = F.regexp_extract_all("row.text", F.lit(BLANK_RUN.replace("+", "*") + BLANK_RUN.replace("[", "[^", 1)), F.lit(0))
    first_words = F.array_join(F.slice(spaced, F.lit(1), rest.cast("int")), "")
    copies = F.concat(
        F.array_repeat(F.col("row.text"), whole.cast("int")),
        F.when(rest > 0, F.array(first_words)).otherwise(F.array().cast("array<string>")),
    )
    spread = met.select("row", F.explode(copies).alias("body"))
    return spread.select(F.col("row").withField("text", F.col("body")).alias("row")).select("row.*")


def op2_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    out = plan_mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
