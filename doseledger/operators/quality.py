"""Quality report and null-rate gate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from doseledger.functions.casting import round_half_away
from doseledger.schemas import NULL_LIMITS, REPORT_FIELDS

#: sketches keep 2 to this power of registers: a standard error of 1.6 %
SKETCH_BITS = 12


class NullRateBreach(Exception):
    """Raised with the failing rows of :func:`null_rate_gate`, kept in ``rows``."""

    def __init__(self, rows: list[Row]) -> None:
        super().__init__("too many missing values in " + ", ".join(r["field"] for r in rows))
        self.rows = rows


def _percent(part, total):
    """``part`` in percent of ``total`` to two places, 0.0 on an empty table."""
    share = part.cast("double") / F.nullif(total, F.lit(0)) * F.lit(100.0)
    return F.coalesce(round_half_away(share, 2), F.lit(0.0))


def veracity_report(df: DataFrame, fields=REPORT_FIELDS) -> DataFrame:
    """Per field: NULLs, their share in percent, and distinct values with NULL as one of them.

    One scan. Rows are turned into (field, value) pairs and counted per pair before the shuffle,
    so a value that fills a third of the table travels as a few rows.
    """
    fields = [f for f in fields if f in df.columns]
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))
                    for f in fields
                ]
            )
        )
    )
    seen = pairs.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = seen.groupBy("field").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("unique_count"),
    )
    # a table without rows still reports its fields
    names = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(f) for f in fields])).alias("place", "field")
    )
    return names.join(counted, "field", "left").orderBy("place").select(
        "field",
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        _percent(F.coalesce("null_count", F.lit(0)), F.coalesce("total", F.lit(0))).alias("null_pct"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
    )


def null_rate_gate(df: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Per field: null share, limit, and whether it exceeds the limit; no rows for an empty table.

    All fields are counted in one scan, which reads only their columns.
    """
    limits = NULL_LIMITS if limits is None else limits
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f).isNull()).alias(f) for f in limits],
    ).filter(F.col("total") > 0)
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                round_half_away(F.col(f) * F.lit(100.0) / F.col("total"), 2).alias("null_pct"),
                F.lit(float(limit)).alias("threshold"),
            )
            for f, limit in limits.items()
        ]
    )
    return counts.select(F.inline(rows)).withColumn(
        "violated", F.col("null_pct") > F.col("threshold")
    )


def enforce_null_rates(df: DataFrame, limits: dict[str, float] | None = None) -> dict[str, float]:
    """Null shares by field; raises :class:`NullRateBreach` when a limit is exceeded."""
    if limits is not None and not limits:
        return {}
    rows = null_rate_gate(df, limits).collect()  # one row per limit
    bad = [r for r in rows if r["violated"]]
    if bad:
        raise NullRateBreach(bad)
    return {r["field"]: r["null_pct"] for r in rows}


def watched_fields(limits: dict[str, float] | None = None) -> list[str]:
    return list(NULL_LIMITS if limits is None else limits)


def watched_nulls(fields) -> list[Column]:
    """NULL counts of fields as metrics that a write can gather on its way."""
    return [F.count_if(F.col(f).isNull()).alias(f) for f in fields]


def check_null_rates(rows: int, nulls: dict[str, int], limits: dict[str, float] | None = None) -> dict[str, float]:
    """Null shares by field from counts a write has gathered; raises :class:`NullRateBreach` when a limit is exceeded.

    The same verdict as :func:`enforce_null_rates`, without reading the table again.
    """
    limits = NULL_LIMITS if limits is None else limits
    if not rows:
        return {}
    shares = {f: math.floor(nulls[f] * 100.0 / rows * 100 + 0.5) / 100 for f in limits}
    bad = [Row(field=f, null_pct=share, threshold=float(limits[f]), violated=True) for f, share in shares.items() if share > limits[f]]
    if bad:
        raise NullRateBreach(bad)
    return shares


def month_sketches(df: DataFrame, fields=REPORT_FIELDS) -> DataFrame:
    """Per month and field: rows, NULLs and a sketch of the distinct values, all of which can be added up over months.

    A sketch has a fixed size, so a month of any size sends one row a task and field. Replacing a month replaces its rows here; the
    report over any months is :func:`approx_report`.
    """
    pairs = df.select(
        "year_month",
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields if f in df.columns])),
    )
    return pairs.groupBy("year_month", "field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", F.lit(SKETCH_BITS)).alias("sketch"),
    )


def approx_report(sketches: DataFrame) -> DataFrame:
    """:func:`veracity_report` from stored sketches: NULLs are exact, distinct values within about 5 % (three standard errors)."""
    merged = sketches.groupBy("field").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("null_count"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n")
    )
    return merged.select(
        "field",
        "null_count",
        _percent(F.col("null_count"), F.col("rows")).alias("null_pct"),
        # NULL is a value of its own
        (F.col("n") + (F.col("null_count") > 0).cast("bigint")).alias("unique_count"),
    )
