"""Bronze lake: prescribing records as JSON lines, page documents as JSON.

Two layouts are read: ``<drug>/<resource>/prescribing.jsonl`` with one file per month, and the
partitioned ``drug=<drug>/resource=<resource>/part-*`` that the writers here produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseledger.schemas import PAGE_KIND, RAW_RECORD, RECORD_KINDS, RECORDS_FILE
from doseledger.session import any_file, list_dirs
from doseledger.sources.web_pages import read_sections

_PARTITIONED = T.StructType([*RAW_RECORD.fields, T.StructField("resource", T.StringType())])


def is_partitioned(spark: SparkSession, base: str) -> bool:
    return any(d.startswith("drug=") for d in list_dirs(spark, base))


def _json(spark: SparkSession, tolerant: bool):
    # FAILFAST reports the first broken line, DROPMALFORMED leaves broken lines out
    return spark.read.option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")


def read_bronze(spark: SparkSession, base: str, tolerant: bool = False) -> DataFrame:
    """Every month of every medicine, all scalars as text, plus ``resource``.

    Blank lines are skipped. A filter on ``drug`` or ``resource`` prunes directories in the
    partitioned layout.
    """
    if is_partitioned(spark, base):
        return _json(spark, tolerant).schema(_PARTITIONED).json(base)
    rows = _json(spark, tolerant).schema(RAW_RECORD).json(f"{base}/*/*/{RECORDS_FILE}")
    return rows.withColumn(
        "resource", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    )


def read_lake(spark: SparkSession, base: str, drug: str, kind: str) -> DataFrame:
    """Read one medicine back: its records over all months, or its page sections.

    Records include a flat file left beside the month folders.
    """
    if kind in RECORD_KINDS:
        parts = []
        if any_file(spark, f"{base}/drug={drug}"):
            parts.append(
                spark.read.option("basePath", base).schema(_PARTITIONED).json(f"{base}/drug={drug}")
            )
        if any_file(spark, f"{base}/{drug}/{RECORDS_FILE}") or any_file(
            spark, f"{base}/{drug}/*/{RECORDS_FILE}"
        ):
            parts.append(
                spark.read.option("recursiveFileLookup", True)
                .option("pathGlobFilter", RECORDS_FILE)
                .schema(RAW_RECORD)
                .json(f"{base}/{drug}")
            )
        rows = parts[0] if len(parts) == 1 else None
        if len(parts) == 2:
            rows = parts[0].unionByName(parts[1], allowMissingColumns=True)
        if rows is None or rows.isEmpty():
            raise FileNotFoundError(f"no prescribing records for {drug!r} under {base}")
        return rows.select(*RAW_RECORD.names)
    if kind == PAGE_KIND:
        return read_sections(spark, base, drug).drop("drug")
    raise ValueError(f"unknown kind of lake data: {kind!r}")


def write_bronze(df: DataFrame, base: str, kind: str, compression: str = "none") -> None:
    """Write records per (drug, resource) or page documents per drug.

    Only partitions present in the frame are replaced. The rebalance lets adaptive execution
    split a dominant partition over several tasks and merge small ones, and the commit protocol
    keeps half-written files invisible. With ``compression`` (``gzip``) files hold the same lines in a fraction of the bytes.
    """
    if kind in RECORD_KINDS:
        keys = ["drug", "resource"]
    elif kind == PAGE_KIND:
        keys = ["drug"]
    else:
        raise ValueError(f"unknown payload type: {kind!r}")
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .option("compression", compression)
        .partitionBy(*keys)
        .json(base)
    )


def route_payloads(envelopes: DataFrame, records_base: str, pages_base: str) -> None:
    """Send each payload to its writer by ``type``, else by ``source``.

    ``envelopes`` has type, source, drug, resource, records and pages. An unknown kind stops the
    run before anything is written.
    """
    kind = F.coalesce(F.nullif(F.col("type"), F.lit("")), F.col("source"), F.lit(""))
    routed = envelopes.withColumn("kind", kind)
    known = [*RECORD_KINDS, PAGE_KIND]
    stray = routed.filter(~F.col("kind").isin(known)).select("kind").limit(1).collect()
    if stray:
        raise ValueError(f"unknown payload type: {stray[0][0]!r}")
    records = routed.filter(F.col("kind").isin(list(RECORD_KINDS))).select(
        "resource", F.col("drug").alias("payload_drug"), F.inline("records")
    )
    if "drug" not in records.columns:
        records = records.withColumn("drug", F.col("payload_drug"))
    write_bronze(records.drop("payload_drug"), records_base, RECORD_KINDS[0])
    pages = routed.filter(F.col("kind") == PAGE_KIND).select("drug", F.col("kind").alias("type"), "pages")
    write_bronze(pages, pages_base, PAGE_KIND)
