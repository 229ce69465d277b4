"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows of equal text form one group. A partial partition is a tuple of as many sums as there are shards; differencing
takes the two of largest spread and adds them in opposite order, until one is left. Groups are dealt into chunks of bounded size;
each chunk is differenced in a task of its own and leaves one tuple, and these tuples are differenced
in the same way, level by level, until one chunk holds all. Memory is bounded by a chunk at every
level, and nothing passes the driver. Slots number the rows of a shard through per-bucket counts, so no
shard is sorted in one task.

Defined cases: a null text has no bytes and equals an empty one; equal rows get slots of their own; rows of equal id and text are
interchangeable; an empty table gives an empty result. A group larger than its share makes its shard larger, as it can't be cut.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doseledger.llm.common import carried, ship_package
from doseledger.session import write_scratch

CHUNK = 8192


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, k) partial partitions to one: its k sums, and where each vector's places go, (n, k).

    Place j of vector i lands on place ``places[i, j]`` of the result.
    """
    n, k = vectors.shape
    order = np.argsort(-vectors, axis=1, kind="stable")
    heap, sums, merged = [], [], []
    for i in range(n):
        own = vectors[i][order[i]]
        sums.append(own)
        heap.append((int(own[-1] - own[0]), i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joint = sums[a] + sums[b][::-1]
        turn = np.argsort(-joint, kind="stable")
        merged.append((a, b, turn))
        sums.append(joint[turn])
        sums[a] = sums[b] = None
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    places = np.zeros((len(sums), k), np.int64)
    places[-1] = np.arange(k)
    for at in range(len(merged) - 1, -1, -1):
        a, b, turn = merged[at]
        back = np.empty(k, np.int64)
        back[turn] = places[n + at]
        places[a], places[b] = back, back[::-1]
    final = np.empty((n, k), np.int64)
    np.put_along_axis(final, order, places[:n], axis=1)
    return sums[-1], final


def _difference_chunk(k: int) -> Callable:
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["k1", "k2"], kind="stable")
        total, places = difference(np.stack(chunk["sums"].to_numpy()).astype(np.int64))
        out = chunk[["chunk", "k1", "k2"]].copy()
        out["places"] = list(places)
        out["total"] = [total if i == 0 else None for i in range(len(out))]
        return out

    return run


def balance(items: DataFrame, shards: int, chunk_rows: int = CHUNK) -> DataFrame:
    """(k1, k2, shard) for items (k1, k2, size), k1 and k2 together unique."""
    ship_package(items.sparkSession)
    first = F.array(F.col("size"), *[F.lit(0).cast("long")] * (shards - 1))
    level = write_scratch(items.select("k1", "k2", first.alias("sums")), "differencing")
    done = []
    while True:
        n = level.count()
        chunks = max(1, -(-n // chunk_rows))
        dealt = level.withColumn("chunk", F.pmod(F.xxhash64("k1", "k2"), F.lit(chunks)))
        out = dealt.groupBy("chunk").applyInPandas(
            _difference_chunk(shards), "chunk long, k1 long, k2 long, places array<long>, total array<long>"
        )
        out = write_scratch(out, "differencing")
        done.append(out)
        if chunks == 1:
            break
        level = write_scratch(
            out.filter("total IS NOT NULL").select(F.col("chunk").alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("total").alias("sums")),
            "differencing",
        )
    # from the last level down: where a chunk's places went, then where its members' places go
    moved = done[-1].select("k1", "k2", "places")
    for out in reversed(done[:-1]):
        outer = moved.select(F.col("k1").alias("chunk"), F.col("places").alias("outer"))
        joined = out.join(outer, "chunk")
        moved = write_scratch(joined.select("k1", "k2", F.transform("places", lambda p: F.get("outer", p.cast("int"))).alias("places")), "differencing")
    return moved.select("k1", "k2", F.element_at("places", 1).cast("int").alias("shard"))


def shard_rows(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("k1"),
        F.xxhash64(F.lit(1), body).alias("k2"),
    )
    rows = write_scratch(rows, "sizes")
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    groups = write_scratch(groups, "groups")
    placed = groups.select("k1", "k2").join(balance(groups.select("k1", "k2", "size"), shards), ["k1", "k2"])
    # buckets grow in number with the rows; one row per bucket and shard passes the window
    n = max(1, groups.agg(F.sum("n")).first()[0] or 0)
    buckets = max(1, -(-n // 50_000))
    bucket = F.pmod(F.xxhash64("doc_id", "k1"), F.lit(buckets))
    dealt = write_scratch(rows.join(placed, ["k1", "k2"]).withColumn("bucket", bucket), "placed")
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "k1", "k2")
    numbered = dealt.withColumn("place", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))


def shard_report(docs: DataFrame, shards: int = 8) -> DataFrame:
    return shard_rows(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Write the rows as one folder per shard; equal texts lie together."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = carried(docs, k1=F.xxhash64(body), k2=F.xxhash64(F.lit(1), body), size=(F.octet_length(body) + 1).cast("long"))
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("size"))
    placed = rows.join(balance(groups, shards), ["k1", "k2"])
    placed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], "shard").write.partitionBy("shard").parquet(path)


def op6_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    return shard_report(table(spark, sf_dir, "documents"))
