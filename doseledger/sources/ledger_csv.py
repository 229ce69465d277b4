"""Monthly source CSV files to normalised records."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.functions.casting import blank_text, safe_float, safe_int
from doseledger.functions.ordering import first_rows
from doseledger.schemas import RESOURCE_PREFIX, drug_code_table

_WANTED = (
    "YEAR_MONTH", "ICB_CODE", "ICB_NAME", "PRACTICE_CODE", "BNF_CHEMICAL_SUBSTANCE",
    "QUANTITY", "ITEMS", "ACTUAL_COST", "UNIDENTIFIED",
)


#: longer than any file: one task takes one file, and no file is cut
_ONE_TASK = 1 << 40


def csv_headers(spark: SparkSession, paths) -> dict[str, list[str]]:
    """Files by their header line, the first line that is not blank.

    One job for any number of files, a task a file. Lines past the header are dropped as the reader hands them over, so all of a file's
    bytes are read, but no line goes on; the driver gets one row a file, as the listing of files gives it anyway.
    """
    probe = spark.newSession()  # settings for this job only
    probe.conf.set("spark.sql.files.maxPartitionBytes", _ONE_TASK)
    probe.conf.set("spark.sql.files.openCostInBytes", _ONE_TASK)
    line = F.trim("value", F.lit("\ufeff \t\r")).alias("line")
    lines = probe.read.text(paths).filter("_metadata.file_block_start = 0").select(line, F.col("_metadata.file_path").alias("file"))
    # the id's lower bits number the lines that are not blank inside their task
    numbered = lines.filter("line <> ''").withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)))
    found: dict[str, list[str]] = {}
    for row in numbered.filter("at = 0").collect():
        found.setdefault(row["line"], []).append(unquote(row["file"]))
    return found


def _read_by_header(spark: SparkSession, paths) -> DataFrame:
    """Columns by header name, whatever their order in a file; files that share a header share one scan."""
    headers = csv_headers(spark, paths)
    reader = spark.read.option("header", True).option("escape", '"')
    parts = []
    for line, files in headers.items():
        header = next(csv.reader([line]))
        # by place, as the file's own header has told; a name that stands twice counts where it stands first
        schema = ", ".join(f"`_{i}` string" for i in range(len(header)))
        scan = reader.schema(schema).csv(paths if len(headers) == 1 else files)
        columns = [(F.col(f"_{header.index(c)}") if c in header else F.lit(None).cast("string")).alias(c) for c in _WANTED]
        parts.append(
            scan.select(
                *columns,
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("seq"),
            )
        )
    if not parts:
        schema = ", ".join(f"{c} string" for c in _WANTED)
        return spark.createDataFrame([], f"{schema}, file string, block bigint, seq bigint")
    return reduce(DataFrame.unionByName, parts)


def join_drug_codes(rows: DataFrame, codes: DataFrame, code_column: str) -> DataFrame:
    """Keep rows of a wanted substance and add its name.

    The code table carries its real size, so the planner broadcasts it while it is small and
    shuffles otherwise.
    """
    return rows.join(codes, rows[code_column] == codes["code"]).drop("code")


def read_epd_csv(
    spark: SparkSession, paths, drug_codes: DataFrame | None = None, row_cap: int | None = None
) -> DataFrame:
    """All wanted medicines of all given monthly files in one scan.

    Rows of unidentified practices are left out. ``row_cap`` keeps the first so many rows per
    medicine and month in file order. Adds ``bnf_code`` and ``resource`` (the month file's name).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    codes = drug_code_table(spark) if drug_codes is None else drug_codes
    rows = _read_by_header(spark, paths).filter(
        F.lower(blank_text(F.col("UNIDENTIFIED"))) != "true"
    )
    from_name = F.regexp_extract("file", r"(EPD_\d+)", 1)
    rows = join_drug_codes(rows, codes, "BNF_CHEMICAL_SUBSTANCE").select(
        "drug",
        F.coalesce(F.nullif(from_name, F.lit("")), F.concat(F.lit("EPD_"), "YEAR_MONTH")).alias("resource"),
        F.col("BNF_CHEMICAL_SUBSTANCE").alias("bnf_code"),
        blank_text(F.col("YEAR_MONTH")).alias("date"),
        F.col("ACTUAL_COST"),
        F.col("ITEMS"),
        F.col("QUANTITY"),
        blank_text(F.col("PRACTICE_CODE")).alias("row_id"),
        F.lit("4").alias("setting"),
        blank_text(F.col("ICB_CODE")).alias("ccg"),
        blank_text(F.col("ICB_NAME")).alias("icb_name"),
        "file",
        "block",
        "seq",
    )
    if row_cap is not None:
        rows = first_rows(rows, ["drug", "resource"], ["file", "block"], "seq", row_cap)
    return rows.select(
        "date",
        safe_float(F.col("ACTUAL_COST")).alias("actual_cost"),
        safe_int(F.col("ITEMS")).alias("items"),
        safe_float(F.col("QUANTITY")).alias("quantity"),
        "row_id", "setting", "ccg", "icb_name", "drug", "bnf_code", "resource",
    )


def latest_months(df: DataFrame, n: int = 1) -> DataFrame:
    """Rows of the last ``n`` month files by name."""
    names = (
        df.select("resource")
        .filter(F.col("resource").startswith(RESOURCE_PREFIX))
        .distinct()
        .orderBy(F.desc("resource"))
        .limit(n)
    )
    return df.join(names, "resource", "left_semi")
