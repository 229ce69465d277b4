"""The supplied order tables seen as prescribing records, page documents and run events.

Line items play prescriptions: a part type is a medicine, a supplier a practice, its nation the
commissioning body (reorganised once, in July 1998), and a ship year one source file. Some values
are missing, zero or unreadable, and half of the dates are compact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.schemas import LEDGER_CSV_HEADER

ROW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
PROMOTED = ("ECONOMY", "SMALL", "LARGE")


_opened: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is looked up once per session, its rows are always read."""
    key = (spark.sparkContext.applicationId, id(spark._jsparkSession), sf_dir, name)
    if key not in _opened:
        _opened[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _opened[key]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def _every(n: int):
    return F.col("l_orderkey") % n == 0


def _both_missing():
    return _every(37) & (F.col("l_linenumber") == 1)


def _common():
    shipped = F.col("l_shipdate")
    return [
        F.when(_every(2), F.date_format(shipped, "yyyyMM"))
        .otherwise(F.date_format(shipped, "yyyy-MM-dd"))
        .alias("date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("row_id"),
        F.lit("4").alias("setting"),
        F.when(shipped < F.lit("1998-07-01").cast("timestamp_ntz"), F.concat(F.lit("C"), F.col("s_nationkey").cast("string")))
        .otherwise(F.concat(F.lit("I"), (F.col("s_nationkey") % 5).cast("string")))
        .alias("ccg"),
        F.concat(F.lit("Board "), F.col("s_nationkey").cast("string")).alias("icb_name"),
        F.col("p_type").alias("drug"),
        F.concat(F.lit("EPD_"), F.date_format(shipped, "yyyy"), F.lit("12")).alias("resource"),
    ]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Bronze records with their source file and row keys."""
    items = (
        F.when(_every(53) | _both_missing(), F.lit(None))
        .when(_every(41), F.lit(0))
        .otherwise(F.col("l_quantity"))
        .cast("bigint")
    )
    return _lines(spark, sf_dir).select(
        *_common(),
        F.when(~_every(37), F.col("l_extendedprice")).alias("actual_cost"),
        items.alias("items"),
        F.col("l_quantity").alias("quantity"),
        *ROW_KEYS,
    )


def _plain_text(column: str):
    return F.col(column).cast("decimal(18,2)").cast("string")


_SOURCE = ("l_shipdate", "l_quantity", "l_extendedprice", "s_nationkey", "p_type", "p_name")


def text_records(spark: SparkSession, sf_dir: str, dirty: bool = True, by_file: bool = False) -> DataFrame:
    """The same records with their numbers as text, some of it unreadable when ``dirty``.

    ``by_file`` lays them out and orders them by source file, as the supplied values, before the wider text is made of these.
    """
    lines, common = _lines(spark, sf_dir), _common()
    if by_file:
        lines = lines.select(*ROW_KEYS, *_SOURCE, common.pop()).hint("rebalance", "resource").sortWithinPartitions("resource")
        common.append(F.col("resource"))
    cost, whole = _plain_text("l_extendedprice"), F.col("l_quantity").cast("bigint").cast("string")
    items = (
        F.when(_every(53) | _both_missing(), F.lit(None)).when(_every(41), F.lit("0")).otherwise(whole)
    )
    cost = F.when(~_every(37), cost)
    if dirty:
        items = F.when(_every(23), "twelve").when(_every(19), F.concat(whole, F.lit(".5"))).otherwise(items)
        cost = F.when(_every(29), "n/a").when(_every(31), "").when(_every(43), "NULL").otherwise(cost)
    return lines.select(
        *common,
        cost.alias("actual_cost"),
        items.alias("items"),
        _plain_text("l_quantity").alias("quantity"),
        "p_name",
        *ROW_KEYS,
    )


def ledger_csv(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """The records in the layout of the monthly source CSV."""
    rows = text_records(spark, sf_dir, by_file=by_file)
    fixed = {
        "YEAR_MONTH": F.col("date"),
        "ICB_NAME": F.col("icb_name"),
        "ICB_CODE": F.col("ccg"),
        "PRACTICE_CODE": F.col("row_id"),
        "ADDRESS_1": F.concat(F.col("p_name"), F.lit(', "The Surgery"')),
        "BNF_CHEMICAL_SUBSTANCE": F.concat(F.lit("SUB-"), F.col("drug")),
        # a wanted code in another column must not count
        "BNF_CODE": F.lit("SUB-ECONOMY"),
        "QUANTITY": F.col("quantity"),
        "ITEMS": F.col("items"),
        "ACTUAL_COST": F.col("actual_cost"),
        "UNIDENTIFIED": F.when(_every(34), "TRUE").when(_every(17), "true").otherwise("N"),
    }
    columns = [fixed.get(c, F.lit("x")).alias(c) for c in LEDGER_CSV_HEADER]
    return rows.select(*columns, "resource", *ROW_KEYS)


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as raw JSON lines, some of those in files before 1998 breaking the contract."""
    rows = text_records(spark, sf_dir, dirty=False)
    quote = F.lit('"')

    def part(name, value):
        return F.concat(F.lit(f'"{name}":'), value)

    def fault(n):
        return _every(n) & (F.col("resource") < "EPD_1998")

    cost = F.coalesce("actual_cost", F.lit("null"))
    cost = F.when(fault(23), '"xyz"').when(_every(29), F.concat(quote, F.coalesce("actual_cost", F.lit("1")), quote)).otherwise(cost)
    items = F.when(fault(19), "12.5").otherwise(F.coalesce("items", F.lit("null")))
    setting = (
        F.when(_every(13), F.lit(None))
        .when(fault(17), '"setting":null')
        .when(fault(61), '"setting":4')
        .otherwise('"setting":"4"')
    )
    line = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            part("date", F.concat(quote, "date", quote)),
            part("actual_cost", cost),
            part("items", items),
            part("quantity", F.col("quantity")),
            part("row_id", F.concat(quote, "row_id", quote)),
            setting,
            part("ccg", F.concat(quote, "ccg", quote)),
            F.when(~fault(31), part("drug", F.concat(quote, "drug", quote))),
            part("extra", F.lit("true")),
        ),
        F.lit("}"),
    )
    # a cut line stays a line
    value = F.when(fault(59), F.substring(line, 1, 25)).otherwise(line)
    return rows.select(
        *ROW_KEYS, F.col("drug").alias("batch_drug"), F.col("resource").alias("batch_resource"), value.alias("value")
    )


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as page sections: language is the medicine, source the page type."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("drug"),
        F.col("source").alias("page_type"),
        F.col("source").alias("heading"),
        "text",
        F.array("lang", "source").alias("bullets"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run events: placed is a start; fulfilled, failed or still open is how it ended."""
    orders = table(spark, sf_dir, "orders")
    level = F.col("o_orderkey") % 5

    def dataset(lv, slot):
        name = F.concat(F.lit("layer"), lv.cast("string"), F.lit("."), slot.cast("string"))
        return F.struct(F.lit("sample").alias("namespace"), name.alias("name"))

    started = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    ended = F.date_format(
        F.timestamp_seconds(
            F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") % 3600
        ),
        "yyyy-MM-dd'T'HH:mm:ss",
    )

    def event(kind, time):
        return F.struct(
            F.lit(kind).alias("eventType"),
            F.concat(time, F.lit("+00:00")).alias("eventTime"),
            F.struct(F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("runId")).alias("run"),
            F.struct(F.lit("sample").alias("namespace"), F.col("o_orderpriority").alias("name")).alias("job"),
            F.array(dataset(level, F.col("o_custkey") % 7)).alias("inputs"),
            F.when(F.col("o_custkey") % 11 != 0, F.array(dataset(level + 1, F.col("o_custkey") % 3))).alias("outputs"),
            F.lit("sample").alias("producer"),
            F.lit("sample").alias("schemaURL"),
        )

    begun = orders.select(F.inline(F.array(event("START", started))))
    done = orders.filter("o_orderstatus = 'F'").select(F.inline(F.array(event("COMPLETE", ended))))
    failed = orders.filter("o_orderstatus = 'P'").select(F.inline(F.array(event("FAIL", ended))))
    return begun.unionByName(done).unionByName(failed)
