"""Publishing tables and re-deriving month ranges, each as one change that readers see whole or not at all.

A published table is a view. Every version behind it is a catalog table with a folder of its own, named after the table and a version
number, and a manifest there that says which folder holds each of its partitions. A new version is written, registered and only then
shown, by one catalog call that changes the view. Nothing that readers can see is touched before that, and a run that
stops at any point leaves the version before in place; what it left behind goes with the next change.

A version may point at partition folders of earlier ones, so replacing some months copies no others. The version before the
current one stays for queries that were planned on it; folders that neither of the two names are removed. One writer at a time
changes a table.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from doseledger.functions.columns import once
from doseledger.operators.quality import check_null_rates, watched_fields, watched_nulls
from doseledger.operators.silver import month_range, silver
from doseledger.session import delete_path, list_dirs

MONTH = "year_month"
_UNDATED = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for a NULL partition
#: partitions named in one statement
_AT_ONCE = 200


class Written(NamedTuple):
    """Rows of a written version, and the NULLs per watched field, both counted by the write itself."""

    rows: int
    nulls: dict[str, int]


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def _root(spark: SparkSession, table: str) -> str:
    return spark.catalog.getDatabase(table.split(".")[0]).locationUri.rstrip("/")


def _folder(spark: SparkSession, table: str, version: str) -> str:
    return f"{_root(spark, table)}/{table.split('.')[1]}-{version}"


def current_version(spark: SparkSession, table: str) -> str | None:
    """The number of the version that the table's view shows."""
    if not spark.catalog.tableExists(table):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'View Text'").collect()
    return text[0]["data_type"].rpartition("__")[2].strip("`") if text else None


def _write_version(df: DataFrame, table: str, version: str, partition_by, watch=()) -> Written:
    """Write rows into the version's folder; counts are taken on the way."""
    spark = df.sparkSession
    if partition_by:
        # adaptive execution splits a dominant partition over tasks and merges small ones
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    # above the rebalance, in the tasks that write: each row counts once, also where a task before runs again
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *watched_nulls(watch)).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(_folder(spark, table, version))
    counts = dict(seen.get)
    return Written(counts.pop("rows"), counts)


def _own_partitions(spark: SparkSession, table: str, version: str) -> dict[str, str]:
    """Value and folder of each partition written into a version's own folder."""
    folder = _folder(spark, table, version)
    return {unquote(d.partition("=")[2]): f"{folder}/{d}" for d in list_dirs(spark, folder) if "=" in d}


def _write_manifest(spark: SparkSession, table: str, version: str, partitions: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(partitions.items()), "value string, folder string")
    rows.coalesce(1).write.json(f"{_folder(spark, table, version)}/_manifest")


def manifest(spark: SparkSession, table: str, version: str) -> dict[str, str]:
    """Value and folder of each partition of a version of a table partitioned by one column."""
    rows = spark.read.schema("value string, folder string").json(f"{_folder(spark, table, version)}/_manifest")
    return {r["value"]: r["folder"] for r in rows.collect()}  # one row a partition


def _register(spark: SparkSession, table: str, version: str, schema, partition_by, partitions: dict[str, str]) -> None:
    """A catalog table of the version, its partitions where the manifest says."""
    name = f"{table}__{version}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{_folder(spark, table, version)}'")
    if len(partition_by) > 1:
        spark.catalog.recoverPartitions(name)
    specs = [f"PARTITION (`{partition_by[0]}` = '{v}') LOCATION '{f}'" for v, f in sorted(partitions.items())] if partitions else []
    for at in range(0, len(specs), _AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(specs[at : at + _AT_ONCE])}")


def _show(spark: SparkSession, table: str, version: str) -> None:
    """Let the table's view show a version: one call to the catalog."""
    database, name = table.split(".")
    body = f"SELECT * FROM `{database}`.`{name}__{version}`"
    if current_version(spark, table) is None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # a plain table of an earlier release
        spark.sql(f"CREATE VIEW {table} AS {body}")
    else:
        spark.sql(f"ALTER VIEW {table} AS {body}")


def _retire(spark: SparkSession, table: str, kept: list[str], by_manifest: bool) -> None:
    """Drop versions other than those kept, and folders that none of these names."""
    database, name = table.split(".")
    for row in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{name}__*'").collect():
        version = row["tableName"].removeprefix(f"{name}__")
        if re.fullmatch("[0-9a-f]{32}", version) and version not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {table}__{version}")
    needed = {f for v in kept for f in manifest(spark, table, v).values()} if by_manifest else set()
    root = _root(spark, table)
    for folder in list_dirs(spark, root):
        if folder.rpartition("-")[0] != name or folder.rpartition("-")[2] in kept:
            continue
        inside = [f"{root}/{folder}/{d}" for d in list_dirs(spark, f"{root}/{folder}")]
        if needed.isdisjoint(inside):
            delete_path(spark, f"{root}/{folder}")
        else:
            for path in inside:
                if "=" in path.rpartition("/")[2] and path not in needed:
                    delete_path(spark, path)


def publish(df: DataFrame, table: str, partition_by=(), watch=(), check=None) -> Written:
    """Replace a table's rows and columns by those of ``df``, which may read the table itself.

    ``watch`` names fields whose NULLs are counted by the write. ``check`` gets the counts before the version is shown, and may raise.
    """
    spark, version, partition_by = df.sparkSession, uuid.uuid4().hex, list(partition_by)
    before = current_version(spark, table)
    written = _write_version(df, table, version, partition_by, watch)
    if check is not None:
        check(written)
    single = len(partition_by) == 1
    partitions = _own_partitions(spark, table, version) if single else {}
    if single:
        _write_manifest(spark, table, version, partitions)
    inner = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    _register(spark, table, version, inner, partition_by, partitions)
    _show(spark, table, version)
    _retire(spark, table, [v for v in (version, before) if v], single)
    return written


def replace_months(fresh: DataFrame, table: str, from_month: str, to_month: str, watch=(), check=None) -> Written:
    """Replace an inclusive month range of a table laid out by month by the rows of ``fresh``, in one change.

    Months of the range without rows in ``fresh`` are gone afterwards; folders of all other months, undated rows included, are
    pointed at, not copied.
    """
    spark, version = fresh.sparkSession, uuid.uuid4().hex
    before = current_version(spark, table)
    if before is None:
        raise RuntimeError(f"{table} does not exist; build it in full first")
    held = spark.table(f"{table}__{before}")
    rows = month_range(fresh, from_month, to_month).select(*held.columns)
    written = _write_version(rows, table, version, [MONTH], watch)
    if check is not None:
        check(written)
    kept = {
        month: folder for month, folder in manifest(spark, table, before).items()
        if month == _UNDATED or not from_month <= month <= to_month
    }
    partitions = kept | _own_partitions(spark, table, version)
    _write_manifest(spark, table, version, partitions)
    _register(spark, table, version, held.schema, [MONTH], partitions)
    _show(spark, table, version)
    _retire(spark, table, [version, before], True)
    return written


def create_or_replace(df: DataFrame, table: str) -> None:
    """Replace a table's rows and columns; ``df`` may have another schema, and may read the table itself."""
    publish(df, table)


def publish_silver(df: DataFrame, table: str, limits: dict[str, float] | None = None, enforce: bool = False) -> Written:
    """Publish Silver laid out by month; rows and NULLs are counted by the write.

    With ``enforce``, a breached null limit raises before readers see the new version.
    """
    check = (lambda w: check_null_rates(w.rows, w.nulls, limits)) if enforce else None
    return publish(df, table, [MONTH], watched_fields(limits), check)


def backfill(
    bronze: DataFrame,
    table: str,
    from_month: str,
    to_month: str,
    promoted: DataFrame | None = None,
    by_resource: bool = False,
    limits: dict[str, float] | None = None,
    enforce: bool = False,
) -> int:
    """Re-derive an inclusive month range of Silver from Bronze in one change; returns the rows in the range.

    A file may hold rows of other months, so by default every row is judged by its own date.
    ``by_resource`` reads only the files named after the range's months, for a lake known to keep
    them apart; on the partitioned layout that prunes folders.

    Rewritten and emptied months switch together. Everything outside the range, undated rows included, is
    untouched, and a second run gives the same table. With ``enforce``, a breached null limit among
    the new rows raises and changes nothing.
    """
    spark = bronze.sparkSession
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"{table} does not exist; build Silver in full before a backfill")
    if by_resource:
        names = ["EPD_" + month.replace("-", "") for month in (from_month, to_month)]
        bronze = bronze.filter(F.col("resource").between(*names))
    stamp = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    # both bounds compare the same derived month
    derived = once(silver(bronze, promoted, stamp=stamp), MONTH, F.col(MONTH))
    check = (lambda w: check_null_rates(w.rows, w.nulls, limits)) if enforce else None
    return replace_months(derived, table, from_month, to_month, watched_fields(limits), check).rows


def backfill_proof(
    bronze: DataFrame, table: str, from_month: str, to_month: str, promoted: DataFrame | None = None
) -> DataFrame:
    """Counts before and after a backfill run twice, in one row."""
    spark = bronze.sparkSession

    def counts():
        rows = spark.table(table)
        return rows.count(), month_range(rows, from_month, to_month).count()

    total_before, window_before = counts()
    first = backfill(bronze, table, from_month, to_month, promoted)
    second = backfill(bronze, table, from_month, to_month, promoted)
    total_after, window_after = counts()
    return spark.range(1).select(
        F.lit(total_before).cast("bigint").alias("total_before"),
        F.lit(window_before).cast("bigint").alias("window_before"),
        F.lit(first).cast("bigint").alias("inserted_first"),
        F.lit(second).cast("bigint").alias("inserted_second"),
        F.lit(total_after).cast("bigint").alias("total_after"),
        F.lit(window_after).cast("bigint").alias("window_after"),
        F.lit(first == second).alias("idempotent"),
    )


def inject_history(silver_rows: DataFrame, practice_id: str, old_ccg: str, date: str) -> DataFrame:
    """Silver plus one altered copy of a row of a practice, to give it an earlier version."""
    copy = (
        silver_rows.filter(F.col("row_id") == practice_id)
        .orderBy(*[c for c in silver_rows.columns if c != "ingested_at"])
        .limit(1)
        .withColumns(
            {
                "date": F.lit(date).cast("date"),
                "ccg": F.lit(old_ccg),
                "year_month": F.lit(date[:7]),
                "ingested_at": F.current_timestamp(),
            }
        )
    )
    return silver_rows.unionByName(copy)
