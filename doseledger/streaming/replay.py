"""Replaying a medicine's latest month as checkpointed micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseledger.functions.casting import blank_text, round_half_away
from doseledger.functions.ordering import number_rows
from doseledger.schemas import RAW_RECORD, RECORDS_FILE
from doseledger.session import any_file, delete_path, list_dirs, path_exists

#: records that carry a batch number of their own
NUMBERED = T.StructType([*RAW_RECORD.fields, T.StructField("batch_num", T.IntegerType())])
_SINK = (
    "date string, actual_cost double, items bigint, quantity double, row_id string, setting string, ccg string, "
    "batch_num int, arrived_at timestamp, drug string, epoch bigint"
)


def latest_partition(spark: SparkSession, base: str, drug: str) -> str:
    """Folder of the newest month of a medicine."""
    for folder in (f"{base}/drug={drug}", f"{base}/{drug}"):
        months = [
            m for m in list_dirs(spark, folder)
            if m.startswith("resource=") or any_file(spark, f"{folder}/{m}/{RECORDS_FILE}")
        ]
        if months:
            return f"{folder}/{months[-1]}"
    raise FileNotFoundError(f"no month of {drug!r} under {base}")


def replay_stream(spark: SparkSession, base: str, drug: str, files_per_trigger: int = 1) -> DataFrame:
    """Stream the newest month of a medicine. Another source with these columns takes its place."""
    rows = (
        spark.readStream.schema(RAW_RECORD)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(latest_partition(spark, base, drug))
    )
    return rows.withColumn("drug", F.coalesce("drug", F.lit(drug)))


def number_batches(rows: DataFrame, order, batch_size: int, group=("drug",)) -> DataFrame:
    """Batch number of each row: the first ``batch_size`` rows are batch 1, the rest follow."""
    numbered = number_rows(rows, order, group)
    return numbered.withColumn(
        "batch_num", (F.floor((F.col("row_num") - 1) / batch_size) + 1).cast("int")
    ).drop("row_num")


def sink_rows(rows: DataFrame) -> DataFrame:
    """Rows as the sink stores them: numbers typed, missing texts empty, arrival time added."""
    return rows.select(
        blank_text(F.col("date")).alias("date"),
        F.col("actual_cost").cast("double").alias("actual_cost"),
        F.col("items").cast("double").cast("bigint").alias("items"),
        F.col("quantity").cast("double").alias("quantity"),
        blank_text(F.col("row_id")).alias("row_id"),
        blank_text(F.col("setting")).alias("setting"),
        blank_text(F.col("ccg")).alias("ccg"),
        "drug",
        "batch_num",
        F.current_timestamp().alias("arrived_at"),
    )


def reset_stream(spark: SparkSession, sink: str, drug: str, checkpoint: str) -> None:
    """Remove a medicine's earlier rows together with the progress that produced them."""
    delete_path(spark, f"{sink}/drug={drug}")
    delete_path(spark, checkpoint)


def run_stream(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Drain a stream into the sink and return the totals per medicine.

    The sink is laid out by medicine and epoch, the number that the checkpoint gives a trigger. A trigger that failed half-way gets the
    same number and the same rows when the stream starts again, so it overwrites just what it left: every row is
    in the sink once. Records without a batch number get the epoch's. The sink can be queried between triggers.
    """
    spark = stream.sparkSession
    numbered = "batch_num" in stream.columns

    def store(batch: DataFrame, epoch: int) -> None:
        rows = batch if numbered else batch.withColumn("batch_num", F.lit(epoch + 1).cast("int"))
        (
            sink_rows(rows)
            .withColumn("epoch", F.lit(epoch).cast("bigint"))
            .hint("rebalance", "drug")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("drug", "epoch")
            .parquet(sink)
        )

    _drain(stream.writeStream.foreachBatch(store), checkpoint)
    return stream_totals(read_sink(spark, sink))


def _drain(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    rows = spark.createDataFrame([], _SINK) if not path_exists(spark, sink) else spark.read.schema(_SINK).parquet(sink)
    return rows.drop("epoch")


def stream_totals(rows: DataFrame) -> DataFrame:
    """Per medicine: records, items and cost. Also a streaming aggregate."""
    return rows.groupBy("drug").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("items").alias("total_items"),
        round_half_away(F.sum("actual_cost"), 2).alias("total_cost_gbp"),
    )


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Epochs whose totals were written whole."""
    epochs = [int(d[6:]) for d in list_dirs(spark, target) if d.startswith("epoch=")]
    return sorted(e for e in epochs if path_exists(spark, f"{target}/epoch={e}/_SUCCESS"))


def read_totals(spark: SparkSession, target: str) -> DataFrame:
    """The totals as of the latest trigger."""
    found = _versions(spark, target)
    schema = "drug string, total_records bigint, total_items bigint, total_cost_gbp double"
    return spark.read.schema(schema).parquet(f"{target}/epoch={found[-1]}") if found else spark.createDataFrame([], schema)


def run_totals(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Keep running totals of a stream in its state store; a trigger sends only the medicines it changed.

    These replace their rows of the epoch before; the others are taken over. An epoch's totals are a folder of its own that counts once it
    is whole, so a trigger that runs again gives the same totals. The epoch before the latest one is kept for readers.
    """
    spark = stream.sparkSession
    if "batch_num" not in stream.columns:
        stream = stream.withColumn("batch_num", F.lit(0))
    totals = stream_totals(sink_rows(stream).drop("arrived_at"))

    def merge(changed: DataFrame, epoch: int) -> None:
        own = changed.sparkSession
        before = [e for e in _versions(own, target) if e < epoch]
        if before:
            old = own.read.schema(totals.schema).parquet(f"{target}/epoch={before[-1]}")
            # both sides hold one row a medicine
            changed = changed.unionByName(old.join(changed.select("drug"), old["drug"].eqNullSafe(changed["drug"]), "left_anti"))
        changed.coalesce(1).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")
        for old_epoch in before[:-1]:
            delete_path(own, f"{target}/epoch={old_epoch}")

    _drain(totals.writeStream.outputMode("update").foreachBatch(merge), checkpoint)
    return read_totals(spark, target)


def batch_snapshot(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` batches of a sink: records, cost and first arrival."""
    return (
        rows.groupBy("batch_num")
        .agg(
            F.count(F.lit(1)).alias("records_in_batch"),
            round_half_away(F.sum("actual_cost"), 2).alias("batch_cost_gbp"),
            F.min("arrived_at").alias("first_arrived"),
        )
        .orderBy("batch_num")
        .limit(n)
    )


def stream_overview(rows: DataFrame) -> DataFrame:
    """Rows, batches and the span of arrival times of a sink, in one row."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("batch_num").alias("total_batches"),
        F.min("arrived_at").alias("first_arrived"),
        F.max("arrived_at").alias("last_arrived"),
    )
