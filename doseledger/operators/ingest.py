"""From delivered batches to Bronze: contract verdict, write and commit of each batch as one step.

A run checks all batches it is given and writes every row once, into a folder of its own, laid out by batch:

    <base>/rows/run=<run>/batch_drug=<drug>/batch_resource=<resource>/   rows with the rules they break
    <base>/commits/run=<run>/                                            one line a batch: rows, verdict and reasons

The verdict of a batch (one broken row or header rule refuses it) is taken from what was written, and the commit is written last; its
``_SUCCESS`` file makes the run count. Readers go by committed runs alone: Bronze is, for each batch, its rows in the latest
committed run that accepted it; rejects are the rows of refused batches, with their reasons. So a stopped run leaves no trace that
a reader sees, a refused delivery leaves the batch's earlier rows in place, and one refused batch holds up no other.

Runs are numbered in order; one run writes at a time. The next run removes what an unfinished one left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseledger.operators.contracts import Rule, check_contract, contract_batch, contract_pages, contract_records, needs_value
from doseledger.schemas import PAGE_KIND, RECORD_KINDS
from doseledger.session import delete_path, list_dirs, path_exists, write_scratch

_BATCH = ("drug", "resource")
_COMMIT = (
    "drug string, resource string, record_rows bigint, bad_records bigint, accepted boolean, reasons array<string>, run bigint"
)


def committed_runs(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the runs whose commit is complete."""
    folders = [d for d in list_dirs(spark, f"{base}/commits") if d.startswith("run=")]
    return sorted(int(d[4:]) for d in folders if path_exists(spark, f"{base}/commits/{d}/_SUCCESS"))


def commits(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts of all batches of committed runs."""
    paths = [f"{base}/commits/run={run}" for run in committed_runs(spark, base)]
    if not paths:
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).option("basePath", f"{base}/commits").json(paths)


def latest_batches(spark: SparkSession, base: str) -> DataFrame:
    """drug, resource and run of each batch that has rows now: the latest committed run that accepted it."""
    last = commits(spark, base).filter("accepted").groupBy(*_BATCH).agg(
        F.max("run").alias("run"), F.max_by("record_rows", "run").alias("n")
    )
    # a comparison, by which the planner sees that these batches are worth pruning by
    return last.filter("n > 0").drop("n")


def _rows(spark: SparkSession, base: str) -> DataFrame:
    runs = [f"{base}/rows/run={run}" for run in committed_runs(spark, base) if path_exists(spark, f"{base}/rows/run={run}")]
    if not runs:
        raise FileNotFoundError(f"no committed rows under {base}")
    # types from one run's own files; partition columns as they were written
    own = spark.read.parquet(runs[-1]).schema
    kept = [f for f in own if f.name not in ("batch_drug", "batch_resource")]
    schema = T.StructType([*kept, *(T.StructField(c, T.StringType()) for c in ("batch_drug", "batch_resource")), T.StructField("run", T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{base}/rows").parquet(*runs)


def read_committed(spark: SparkSession, base: str) -> DataFrame:
    """Bronze rows with their batch's ``resource``. The batches that count prune folders at run time.

    Runs are expected to have the same fields; of others, those of the last run are read.
    """
    batches = latest_batches(spark, base).select(F.col("drug").alias("batch_drug"), F.col("resource").alias("batch_resource"), "run")
    rows = _rows(spark, base).join(batches, ["batch_drug", "batch_resource", "run"], "left_semi").drop("violations", "run")
    return rows.withColumnRenamed("batch_resource", "resource").drop("batch_drug")


def read_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rows of refused batches of all runs: own reasons in ``violations``, the batch's in ``batch_reasons``."""
    refused = commits(spark, base).filter("NOT accepted").select(
        F.col("drug").alias("batch_drug"), F.col("resource").alias("batch_resource"), "run", F.col("reasons").alias("batch_reasons")
    )
    return _rows(spark, base).join(refused, ["batch_drug", "batch_resource", "run"])


def _start(spark: SparkSession, base: str) -> int:
    """The next run's number; whatever unfinished runs left is removed."""
    done = set(committed_runs(spark, base))
    for part in ("rows", "commits"):
        for folder in list_dirs(spark, f"{base}/{part}"):
            if folder.startswith("run=") and int(folder[4:]) not in done:
                delete_path(spark, f"{base}/{part}/{folder}")
    return max(done, default=0) + 1


def _write_rows(checked: DataFrame, base: str, run: int) -> DataFrame:
    path = f"{base}/rows/run={run}"
    keys = ["batch_drug", "batch_resource"]
    checked.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)
    schema = T.StructType([f for f in checked.schema if f.name not in keys] + [T.StructField(c, T.StringType()) for c in keys])
    return checked.sparkSession.read.schema(schema).parquet(path)


def _write_commit(verdicts: DataFrame, base: str, run: int) -> None:
    """The last step: with this folder's ``_SUCCESS`` the run counts."""
    out = verdicts.select("drug", "resource", "record_rows", "bad_records", "accepted", F.col("violations").alias("reasons"))
    out.coalesce(1).write.json(f"{base}/commits/run={run}")


def ingest(checked: DataFrame, headers: DataFrame | None, base: str, judge=contract_batch) -> int:
    """Write checked rows, judge their batches, commit; returns the run's number.

    ``checked`` has batch_drug, batch_resource and violations beside the contract's fields. ``headers`` are the batches'
    own fields; rows without a header are refused. Without ``headers`` these are counted from the written rows.
    """
    spark = checked.sparkSession
    run = _start(spark, base)
    # a batch without a name still needs a folder that can be told apart
    named = checked.withColumns({c: F.coalesce(F.nullif(c, F.lit("")), F.lit("unnamed")) for c in ("batch_drug", "batch_resource")})
    written = _write_rows(named, base, run)
    derived = headers is None
    if derived:
        # counted by code first, in hash tables, so that rows are not sorted for the text
        coded = written.groupBy(F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource"), "bnf_code").agg(F.count(F.lit(1)).alias("n"))
        headers = coded.groupBy(*_BATCH).agg(
            F.first("bnf_code", ignorenulls=True).alias("bnf_code"), F.sum("n").alias("total_rows")
        ).withColumn("source", F.lit(RECORD_KINDS[0]))
    headers = write_scratch(headers, "headers")  # one row a batch; read for the verdicts and for rows without a header
    verdicts = judge(headers, written)
    columns = ["drug", "resource", "record_rows", "bad_records", "accepted", "violations"]
    if derived:
        # taken from the rows, so that none is without
        _write_commit(verdicts.select(*columns), base, run)
        return run
    own = written.select(F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource"), (F.size("violations") > 0).alias("bad"))
    orphans = own.join(headers.select(*_BATCH), list(_BATCH), "left_anti").groupBy(*_BATCH).agg(
        F.count(F.lit(1)).alias("record_rows"), F.count_if("bad").alias("bad_records")
    ).withColumns({"accepted": F.lit(False), "violations": F.array(F.lit("header: missing"))})
    _write_commit(verdicts.select(*columns).unionByName(orphans), base, run)
    return run


def ingest_lines(lines: DataFrame, headers: DataFrame, base: str, text: str = "value") -> int:
    """Ingest raw record lines (with batch_drug and batch_resource) of several batches."""
    return ingest(contract_records(lines, text), headers, base)


def ingest_csv(records: DataFrame, base: str) -> int:
    """Ingest records of source CSV files (:func:`doseledger.sources.ledger_csv.read_epd_csv`): a batch per medicine and file."""
    rules = [needs_value(c) for c in ("date", "row_id", "drug")]
    checked = check_contract(records, rules).withColumns({"batch_drug": F.col("drug"), "batch_resource": F.col("resource")})
    return ingest(checked.drop("resource"), None, base)


def judge_pages(headers: DataFrame, sections: DataFrame) -> DataFrame:
    """Verdict per page document: one bad section refuses it."""
    counts = sections.groupBy(F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource")).agg(
        F.count(F.lit(1)).alias("record_rows"), F.count_if(F.size("violations") > 0).alias("bad_records")
    )
    joined = headers.join(counts, list(_BATCH), "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("record_rows", "bad_records")}
    )
    verdict = check_contract(joined, [Rule("pages: contract broken", F.col("bad_records") > 0)])
    return verdict.withColumn("accepted", F.size("violations") == 0)


def ingest_pages(lines: DataFrame, base: str, text: str = "value") -> int:
    """Ingest page documents, one a line with its medicine in ``batch_drug``."""
    named = lines.withColumn("batch_resource", F.lit(PAGE_KIND))
    headers = named.select(F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource")).distinct()
    return ingest(contract_pages(named, text), headers, base, judge_pages)
