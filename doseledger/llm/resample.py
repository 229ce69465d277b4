"""Target-distribution importance resampling: the rows that look most like a target text, drawn at random by their weights.

Words hash into a fixed number of buckets. The gain of a bucket is the log ratio of its smoothed share in the target to that in the
corpus; a row's weight is the sum of the gains of its features, its score adds Gumbel noise taken from a hash of its id, and
the highest scores are drawn. That is sampling without replacement by weight, and the same at every rerun.

The gains are one array of ``buckets`` numbers, all that leaves the corpus counts; tasks score whole texts with it. Scores are written
once. The cutoff is found there by bisection: each job counts exactly, beside the scan, how many rows lie above some thresholds, first
of the score, then of the id among rows of the cutoff's score, then of the text key, then of the row's own number. No sort or
top-k over all rows is made; only drawn rows are range-partitioned for their ranks.

Defined cases: a null text has no words; a null id counts as empty text in the hash and as larger than all others in ties; rows equal
in id and score are taken by text key, equal rows in any order; an empty table gives an empty result; without target text all
gains follow the corpus alone.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseledger.functions.ordering import number_rows
from doseledger.llm.common import CRC_TABLE_SQL, crc_sql, ship_package, table, text_key
from doseledger.session import write_scratch

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: thresholds of one counting job, four halvings
CUTS = 15
#: a text is taken in pieces of about this many bytes
PIECE = 1 << 22

# ASCII letters in lower case and digits stay, other ASCII separates; every byte of a longer character is part of a word
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, piece by piece, so that a long one is never split up whole."""
    # of the bytes, only A-Z change
    data, at = (text or "").encode("utf-8", "surrogatepass").lower().translate(_FOLD), 0
    while at < len(data):
        end = len(data) if at + PIECE >= len(data) else data.rfind(b" ", at, at + PIECE) + 1
        if end <= at:  # one word longer than a piece
            end = data.find(b" ", at) + 1 or len(data)
        yield data[at:end].split()
        at = end


def feature_pieces(text: str | None, runs: int = 1) -> Iterator[list[bytes]]:
    """Features of a text: all runs of 1 to ``runs`` consecutive words, joined by a space."""
    held: list[bytes] = []
    for words in word_pieces(text):
        out = list(words)
        row = held + words
        for n in range(2, runs + 1):
            # runs that end in this piece
            out += [b" ".join(row[i : i + n]) for i in range(max(0, len(held) - n + 1), len(row) - n + 1)]
        held = row[max(0, len(row) - runs + 1) :]
        yield out


class BucketArray:
    """Looks up numbers by a feature's bucket; remembers features it has met, up to ``most``."""

    def __init__(self, values: np.ndarray, most: int = 1 << 18):
        self.values, self.most, self.known = values.tolist(), most, {}

    def total(self, features: list[bytes]) -> int:
        known, values, n = self.known, self.values, len(self.values)
        if len(known) > self.most:
            known.clear()
        out = 0
        for word, times in Counter(features).items():
            value = known.get(word)
            if value is None:
                value = known[word] = values[zlib.crc32(word) % n]
            out += value * times
        return out


def bucket_counts(texts: DataFrame, text: str, runs: int, buckets: int) -> np.ndarray:
    """Features per bucket over all rows. A task sends one row per bucket it met."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            met: Counter = Counter()
            for body in batch["body"]:
                for features in feature_pieces(body, runs):
                    met.update(features)
                    if len(met) > 1 << 20:
                        _add(sums, met)
            _add(sums, met)
        full = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": full, "n": sums[full]})

    per_task = texts.select(F.col(text).alias("body")).mapInPandas(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def _add(sums: np.ndarray, met: Counter) -> None:
    for feature, n in met.items():
        sums[zlib.crc32(feature) % len(sums)] += n
    met.clear()


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, per bucket."""
    n, of, to = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (of + n) / ((s + 1.0) * (to + n)))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, runs: int) -> DataFrame:
    """doc_id, th, n_words, n_features and weight of every row."""

    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        array = BucketArray(gain)
        for bodies in batches:
            out = []
            for body in bodies:
                features = weight = 0
                for piece in feature_pieces(body, runs):
                    features += len(piece)
                    weight += array.total(piece)
                words = features if runs == 1 else sum(len(p) for p in word_pieces(body))
                out.append((words, features, weight))
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight"], dtype=np.int64)

    weigh.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    own = F.pandas_udf(weigh, "n_words long, n_features long, weight long")(F.col(text)).alias("w")
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(body).alias("th"), own).select("doc_id", "th", "w.*")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, rounded down, from a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _highest(rows: DataFrame, column: str, want: int) -> tuple[int, int]:
    """(cutoff, above): the largest value with at least ``want`` rows at or above it, and how many are above.

    Bisection: a job counts the rows at or above each of ``CUTS`` thresholds, and the range shrinks to one step between two of them.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        # the cutoff is in low..high; thresholds are inside, in steps of a sixteenth of the range at least one wide
        marks = sorted({low + (high - low) * (i + 1) // (CUTS + 1) for i in range(CUTS)} - {low} | {high})
        counts = rows.agg(*[F.count_if(F.col(column) >= F.lit(m)).alias(f"m{i}") for i, m in enumerate(marks)]).first()
        reached = [m for m, n in zip(marks, counts) if n >= want]
        missed = [(m, n) for m, n in zip(marks, counts) if n < want]
        low = reached[-1] if reached else low
        if missed:
            high, above = missed[0][0] - 1, missed[0][1]
    return low, above


def drawn(scored: DataFrame, order: list[str], want: int) -> Column:
    """A condition that holds for the ``want`` rows that come first by ``order``, numbers of which the highest come first.

    The last column must tell all rows apart.
    """
    chosen, tied, left = F.lit(False), F.lit(True), want
    for column in order:
        rows = scored.filter(tied)
        cutoff, above = _highest(rows, column, left)
        chosen = chosen | (tied & (F.col(column) > F.lit(cutoff)))
        tied = tied & (F.col(column) == F.lit(cutoff))
        left -= above
        if scored.filter(tied).count() == left:
            return chosen | tied
    raise AssertionError("rows that the order doesn't tell apart")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    runs: int = 1,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, and rank (1, 2, 3, ... by falling score, null if not drawn).

    ``percent`` of the rows with ``min_words`` words or more are drawn, rounded down. Ids must be whole numbers.
    """
    ship_package(docs.sparkSession)
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, text, runs, buckets))
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    # numbers of which higher ones come first; the complement turns ids round without overflow, a null id comes last
    places = {"by_id": F.bitwise_not(F.coalesce("doc_id", F.lit(2**63 - 1))), "by_null": F.col("doc_id").isNotNull().cast("long")}
    scored = weighed(docs, gain, doc_id, text, runs).withColumn("score", score).withColumns(places)
    scored = write_scratch(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    want = able.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if want == 0:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    order = ["score", "by_id", "by_null", "th", "row"]
    first = (F.col("n_words") >= min_words) & drawn(able, order, want)
    ranked = number_rows(scored.filter(first), [F.desc(c) for c in order], name="rank")
    rest = scored.filter(~first).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(*columns, F.col("rank").cast("long").alias("rank"))


def op11_query(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BYTES = "list_transform(range(0, octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))"
ORACLE_SQL = rf"""WITH RECURSIVE {CRC_TABLE_SQL},
found AS (
  SELECT 'd' AS side, rowid AS row, unnest({_WORDS.format("text")}) AS word FROM (SELECT text, row_number() OVER () AS rowid FROM documents)
  UNION ALL SELECT 't', 0, unnest({_WORDS.format("text")}) FROM benchmark),
hashed AS (
  SELECT word, {crc_sql(_BYTES)} % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM found), crc),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM found JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (SUM(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (SUM(t) OVER () + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM counts),
weights AS (
  SELECT row, count(*) AS n, CAST(SUM(gain) AS BIGINT) AS weight FROM found JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
  SELECT doc_id, COALESCE(n, 0) AS n_features, COALESCE(weight, 0) AS weight,
    COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) LEFT JOIN weights USING (row)),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= total * {PERCENT} // 100 THEN place END AS rank FROM able
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {MIN_WORDS}"""
