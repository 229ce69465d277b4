"""Line deduplication: lines that several documents share stay in one of them.

Lines are exploded with their position and two 64-bit hashes of their key. One aggregate per hash with
map-side combine keeps the smallest and the largest document id; they differ exactly when at least two
documents hold the line, so a line found in a third of all rows travels as one row per task. The
positions to drop are gathered per document, and the text is put together by position inside its row.

Defined cases: a null text is an empty one; a null id is one document that comes last; rows with equal
id are one document; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseledger.llm.common import ascii_lower, strip_blanks, text_key
from doseledger.session import write_scratch

_LAST = 2**63 - 1


def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    # keys are made below the generator, else they would be made again for every line; an outer explode adds no
    # filter on the array, which would make it twice
    keyed = docs.select(
        F.coalesce(F.col(doc_id), F.lit(_LAST)).alias("id"),
        text_key(body).alias("th"),
        F.split(ascii_lower(body), "\n").alias("all_lines"),
    )
    exploded = keyed.select("id", "th", F.posexplode_outer("all_lines").alias("pos", "line"))
    key = strip_blanks(F.col("line"))
    return exploded.select("id", "th", "pos", key.alias("key")).filter(F.length("key") >= min_chars).select(
        "id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and kept_text, the lines that stay joined by newlines."""
    lines = write_scratch(_lines(docs, doc_id, text, min_chars), "lines")
    shared = lines.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    # as a table of its own, both sides of the join are dealt for it, and a line that many share can be split
    shared = write_scratch(shared.filter("first_id <> last_id"), "shared-lines")
    drops = (
        lines.join(shared, ["h1", "h2"])
        .filter("id <> first_id")
        .groupBy("id", "th")
        .agg(F.sort_array(F.collect_set("pos")).alias("at"))
    )
    # one byte per line up to the last dropped one, '1' where it goes: constant-time look-ups in long texts
    gap = F.transform("at", lambda p, i: F.concat(F.repeat(F.lit("0"), p - F.coalesce(F.get("at", i - 1), F.lit(-1)) - 1), F.lit("1")))
    masks = drops.select(
        F.col("id").alias("m_id"),
        F.col("th").alias("m_th"),
        F.size("at").cast("long").alias("gone"),
        F.encode(F.array_join(gap, ""), "utf-8").alias("mask"),
    )
    body = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    body = body.withColumns({"id": F.coalesce("doc_id", F.lit(_LAST)), "th": text_key(F.col("body"))})
    found = body.join(masks, (F.col("id") == F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")
    split = F.split("body", "\n")
    kept = F.filter(split, lambda line, i: F.coalesce(F.substring(F.col("mask"), i + 1, F.lit(1)) != F.lit(b"1"), F.lit(True)))
    return found.select(
        "doc_id",
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce("gone", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("mask").isNull(), F.col("body")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def op5_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, s.first_id IS NOT NULL AND k.doc_id <> s.first_id AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""
