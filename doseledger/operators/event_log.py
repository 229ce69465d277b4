"""The lineage log: run events as JSON lines, and queries over them."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.schemas import RUN_EVENT, RUN_STATES
from doseledger.session import write_scratch

NAMESPACE = "doseledger"
# fixed value: the public specification the events follow
EVENT_SCHEMA_URL = "https://openlineage.io/spec/1-0-5/OpenLineage.json"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Typed events; absent input and output lists are empty. :func:`rejected_events` has the lines left out."""
    raw = spark.read.schema(RUN_EVENT).json(path)
    none = F.array().cast(RUN_EVENT["inputs"].dataType)
    return raw.filter(F.col("eventType").isin(list(RUN_STATES))).select(
        F.col("eventType").alias("event_type"),
        F.try_to_timestamp("eventTime").alias("event_time"),
        F.col("run.runId").alias("run_id"),
        F.col("job.namespace").alias("job_namespace"),
        F.col("job.name").alias("job_name"),
        F.coalesce("inputs", none).alias("inputs"),
        F.coalesce("outputs", none).alias("outputs"),
        "producer",
        F.col("schemaURL").alias("schema_url"),
    )


def rejected_events(spark: SparkSession, path: str) -> DataFrame:
    """Lines that :func:`read_events` leaves out, with the reason."""
    event = F.from_json("value", RUN_EVENT, {"mode": "PERMISSIVE"})
    lines = spark.read.text(path).filter(F.trim("value") != "").withColumn("state", event["eventType"])
    known = F.col("state").isin(list(RUN_STATES))
    reason = F.when(F.col("state").isNull(), "no event type or not JSON").when(~known, "unknown event type")
    return lines.select("value", reason.alias("reason")).filter("reason IS NOT NULL")


def lineage_runs(events: DataFrame) -> DataFrame:
    """One row per run: final state, start, end and seconds between; a run without end is open."""
    ended = F.col("event_type").isin("COMPLETE", "FAIL")
    return (
        events.groupBy("run_id", "job_namespace", "job_name")
        .agg(
            F.min(F.when(F.col("event_type") == "START", F.col("event_time"))).alias("started_at"),
            F.max(F.when(ended, F.col("event_time"))).alias("ended_at"),
            F.max(F.when(ended, F.col("event_type"))).alias("end_state"),
        )
        .select(
            "run_id",
            "job_namespace",
            "job_name",
            "started_at",
            "ended_at",
            F.coalesce("end_state", F.lit("START")).alias("state"),
            (F.unix_seconds("ended_at") - F.unix_seconds("started_at")).alias("seconds"),
        )
    )


def lineage_edges(events: DataFrame) -> DataFrame:
    """Distinct dataset-to-dataset edges with the job between them, from finished runs."""
    return (
        events.filter(F.col("event_type") == "COMPLETE")
        .select("job_name", F.explode("inputs").alias("i"), "outputs")
        .select("job_name", F.col("i.name").alias("input"), F.explode("outputs").alias("o"))
        .select("input", "job_name", F.col("o.name").alias("output"))
        .distinct()
    )


def upstream(edges: DataFrame, dataset: str) -> DataFrame:
    """Every dataset a dataset derives from, with its distance in jobs.

    One join per level against the edge table, which is derived from the log once. Each level is written to the shared folder, which
    cuts the lineage; datasets already reached are not followed again, so cycles end.
    """
    spark = edges.sparkSession
    edges = write_scratch(edges.select("input", "output").distinct(), "edges")
    reached = spark.range(1).select(F.lit(dataset).alias("dataset"), F.lit(0).alias("distance"))
    frontier, distance = reached, 0
    while True:
        distance += 1
        frontier = write_scratch(
            edges.join(frontier, edges["output"] == frontier["dataset"])
            .select(F.col("input").alias("dataset"))
            .distinct()
            .join(reached, "dataset", "left_anti")
            .withColumn("distance", F.lit(distance)),
            "frontier",
        )
        if frontier.isEmpty():
            return reached.filter("distance > 0")
        reached = reached.unionByName(frontier)


def append_event(
    spark: SparkSession, path: str, job: str, state: str, run_id: str, inputs=(), outputs=()
) -> None:
    """Append one event to the log."""
    source = F.lit(NAMESPACE)

    def datasets(names):
        found = [F.struct(source.alias("namespace"), F.lit(n).alias("name")) for n in names]
        return F.array(*found).cast(RUN_EVENT["inputs"].dataType)

    event = spark.range(0, 1, 1, 1).select(
        F.lit(state).alias("eventType"),
        F.lit(datetime.now(timezone.utc).isoformat()).alias("eventTime"),
        F.struct(F.lit(run_id).alias("runId")).alias("run"),
        F.struct(source.alias("namespace"), F.lit(job).alias("name")).alias("job"),
        datasets(inputs).alias("inputs"),
        datasets(outputs).alias("outputs"),
        source.alias("producer"),
        F.lit(EVENT_SCHEMA_URL).alias("schemaURL"),
    )
    event.write.mode("append").json(path)


@contextmanager
def recorded(spark: SparkSession, path: str, job: str, inputs=(), outputs=()):
    """Log START, then COMPLETE or FAIL, around a step."""
    run_id = str(uuid.uuid4())
    append_event(spark, path, job, "START", run_id, inputs, outputs)
    try:
        yield run_id
    except Exception:
        append_event(spark, path, job, "FAIL", run_id, inputs, outputs)
        raise
    append_event(spark, path, job, "COMPLETE", run_id, inputs, outputs)
