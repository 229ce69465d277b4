"""What several text operators share: word and line borders, stable text keys, whole-row carrying."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.session import drop_scratch  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# the six ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other capitals stay."""
    return F.translate(text, UPPER, UPPER.lower())


def strip_blanks(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Runs of non-blank characters."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


# stands for a null id where rows pass Python, which would turn whole numbers with nulls into floats
NO_ID = -(2**63)


def id_in(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id), F.lit(NO_ID))


def id_out(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def text_key(text: Column) -> Column:
    """A 64-bit key of a text; with the document id it names rows that are the same."""
    return F.xxhash64(text)


def spread_sample(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` rows whose hash of ``columns`` is lowest: a filter beside the scan, with no task that gathers more."""
    total = df.count()
    if total <= rows:
        return df
    level = int(2**30 * rows / total)
    return df.filter(F.pmod(F.xxhash64(*columns), F.lit(2**30)) < level)


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of a row as one struct ``row``, so that added columns can't clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    path = Path(tempfile.mkdtemp(prefix="doseledger-code-")) / "doseledger.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "doseledger").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


# crc32 in SQL by its own rule: a table of 256 remainders, then one step a byte
CRC_TABLE_SQL = """remainders(b, c, i) AS (
  SELECT b, b, 0 FROM range(256) r(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM remainders WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS remainder FROM remainders WHERE i = 8)"""


def crc_sql(byte_list: str) -> str:
    """The crc32 of a list of bytes, where ``crc`` of :data:`CRC_TABLE_SQL` is joined."""
    step = "lambda a, b: xor(a >> 8, remainder[xor(a & 255, b) + 1])"
    return f"xor(list_reduce({byte_list}, {step}, 4294967295::BIGINT), 4294967295)"
