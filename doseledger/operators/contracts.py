"""Data contracts as declarative rules over raw JSON lines.

A line's fields are read as VARIANT, which tells a missing field (defaulted) from an explicit null
(rejected), and a number from its quoted form. Each rule is one boolean column; a row carries the
names of the rules it breaks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseledger.functions.casting import blank_list, blank_text
from doseledger.functions.columns import once
from doseledger.schemas import PAGE_KIND, PAGE_TYPES, RAW_RECORD, RECORD_KINDS


class Rule(NamedTuple):
    """A named condition that is true for a row breaking it."""

    name: str
    broken: Column


class Fields:
    """Type names and texts of a VARIANT object's fields.

    A kind is NULL for a missing field and ``VOID`` for an explicit null.
    """

    def __init__(self, doc: Column):
        self.doc = doc
        self.is_object = F.coalesce(F.schema_of_variant(doc), F.lit("")).startswith("OBJECT")

    def kind(self, field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(self.doc, f"$.{field}", "variant"))

    def text(self, field: str) -> Column:
        return F.try_variant_get(self.doc, f"$.{field}", "string")


class PreparedFields:
    """The same over columns computed once per row by :func:`_prepare_records`."""

    def __init__(self, row: Column):
        self.row = row
        self.is_object = row["is_object"]

    def kind(self, field: str) -> Column:
        return self.row["kinds"][field]

    def text(self, field: str) -> Column:
        return self.row["texts"][field]


_FLOAT = r"(?i)^\s*[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity|nan)\s*$"
_WHOLE = r"^\s*[+-]?\d+(?:\.0*)?\s*$"


def _number(fields, field: str) -> Column:
    text = fields.text(field)
    return F.when(
        fields.kind(field) == "BOOLEAN", text.try_cast("boolean").cast("double")
    ).otherwise(F.trim(text).try_cast("double"))


def _whole_number(fields, field: str) -> Column:
    text = F.trim(fields.text(field))
    return F.when(
        fields.kind(field) == "BOOLEAN", text.try_cast("boolean").cast("bigint")
    ).otherwise(F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")))


def needs_text(fields, field: str) -> Rule:
    return Rule(f"{field}: text required", F.coalesce(fields.kind(field), F.lit("")) != "STRING")


def optional_text(fields, field: str) -> Rule:
    return Rule(f"{field}: not text", F.coalesce(fields.kind(field), F.lit("STRING")) != "STRING")


def optional_number(fields, field: str) -> Rule:
    kind = F.coalesce(fields.kind(field), F.lit("VOID"))
    good = kind.isin("VOID", "BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    good = good | ((kind == "STRING") & fields.text(field).rlike(_FLOAT))
    return Rule(f"{field}: not a number", ~good)


def optional_whole(fields, field: str) -> Rule:
    kind = F.coalesce(fields.kind(field), F.lit("VOID"))
    value = fields.text(field).try_cast("double")
    integral = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    good = (
        kind.isin("VOID", "BIGINT", "BOOLEAN")
        | (integral & F.coalesce(value == F.floor(value), F.lit(False)))
        | ((kind == "STRING") & fields.text(field).rlike(_WHOLE))
    )
    return Rule(f"{field}: not a whole number", ~good)


def needs_value(column: str) -> Rule:
    """The rule of required text for a typed column."""
    return Rule(f"{column}: text required", F.col(column).isNull())


def one_of(fields, field: str, allowed) -> Rule:
    known = (fields.kind(field) == "STRING") & fields.text(field).isin(list(allowed))
    return Rule(f"{field}: not one of {', '.join(allowed)}", ~F.coalesce(known, F.lit(False)))


def is_object(fields) -> Rule:
    return Rule("not a JSON object", ~F.coalesce(fields.is_object, F.lit(False)))


def record_rules(doc) -> list[Rule]:
    """Rules of one prescribing record; fields not named here are ignored."""
    return [
        needs_text(doc, "date"),
        optional_number(doc, "actual_cost"),
        optional_whole(doc, "items"),
        optional_number(doc, "quantity"),
        needs_text(doc, "row_id"),
        optional_text(doc, "setting"),
        optional_text(doc, "ccg"),
        optional_text(doc, "icb_name"),
        needs_text(doc, "drug"),
    ]


def section_rules(doc: Fields) -> list[Rule]:
    """Rules of one page section."""
    bullets = F.try_variant_get(doc.doc, "$.bullets", "array<variant>")
    kind = F.coalesce(doc.kind("bullets"), F.lit("ARRAY"))
    texts = F.forall(
        F.coalesce(bullets, F.array().cast("array<variant>")),
        lambda b: F.coalesce(F.schema_of_variant(b), F.lit("")) == "STRING",
    )
    return [
        needs_text(doc, "url"),
        one_of(doc, "page_type", PAGE_TYPES),
        optional_text(doc, "heading"),
        optional_text(doc, "text"),
        Rule("bullets: not a list of texts", ~(kind.startswith("ARRAY") & texts)),
    ]


def check_contract(df: DataFrame, rules, first: Rule | None = None) -> DataFrame:
    """Add ``violations``, the names of broken rules; empty for a valid row.

    A row that breaks ``first`` is not judged by the other rules.
    """
    names = F.array(*[F.when(r.broken, r.name).otherwise("") for r in rules])
    found = F.array_remove(names, "")
    if first is not None:
        found = F.when(first.broken, F.array(F.lit(first.name))).otherwise(found)
    return once(df, "violations", found)


_FIELDS = T.StructType([*[T.StructField(n, T.VariantType()) for n in RAW_RECORD.names], T.StructField("__broken", T.StringType())])
_STRICT = {"columnNameOfCorruptRecord": "__broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _prepare_records(lines: DataFrame, text: str) -> DataFrame:
    """Each line's field types and field texts as one column ``row``, computed once.

    One pass of the JSON reader makes a small VARIANT of every contract field and skips the others; NULL is a missing field.
    """
    parsed = once(lines, "fields", F.from_json(text, _FIELDS, _STRICT))
    # the reader stops behind the first value; only a line with more behind a brace is parsed again, as the one item of a list
    more = F.col(text).rlike(r"\}\s*[^\s\]}]")
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = listed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    whole = F.when(more, alone).otherwise(F.lit(True))
    row = F.struct(
        (F.col("fields").isNotNull() & F.col("fields.__broken").isNull() & whole).alias("is_object"),
        F.struct(*[F.schema_of_variant(F.col(f"fields.{n}")).alias(n) for n in RAW_RECORD.names]).alias("kinds"),
        F.struct(*[F.try_variant_get(F.col(f"fields.{n}"), "$", "string").alias(n) for n in RAW_RECORD.names]).alias("texts"),
    )
    return once(parsed, "row", row).drop("fields", text)


def contract_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """Check raw record lines: contract fields with defaults, and ``violations``.

    Other columns of ``lines`` are kept. Values of a rejected row may be NULL.
    """
    fields = PreparedFields(F.col("row"))
    checked = check_contract(_prepare_records(lines, text), record_rules(fields), is_object(fields))
    kept = [c for c in lines.columns if c != text]
    return checked.select(
        *kept,
        fields.text("date").alias("date"),
        _number(fields, "actual_cost").alias("actual_cost"),
        _whole_number(fields, "items").alias("items"),
        _number(fields, "quantity").alias("quantity"),
        fields.text("row_id").alias("row_id"),
        blank_text(fields.text("setting")).alias("setting"),
        blank_text(fields.text("ccg")).alias("ccg"),
        blank_text(fields.text("icb_name")).alias("icb_name"),
        fields.text("drug").alias("drug"),
        "violations",
    )


def contract_pages(lines: DataFrame, text: str = "value") -> DataFrame:
    """Check page documents, one per line: one row per section with defaults and ``violations``.

    A document-level fault appears on each of its sections; an empty page list is valid and gives
    no rows unless the document itself is at fault.
    """
    document, section = Fields(F.col("doc")), Fields(F.col("section"))
    kept = [c for c in lines.columns if c != text]
    pages = F.try_variant_get(F.col("doc"), "$.pages", "array<variant>")
    document_rules = [
        needs_text(document, "drug"),
        one_of(document, "type", [PAGE_KIND]),
        Rule("pages: list required", ~F.coalesce(document.kind("pages"), F.lit("")).startswith("ARRAY")),
    ]
    documents = check_contract(
        once(lines, "doc", F.try_parse_json(F.col(text))), document_rules, is_object(document)
    ).withColumnRenamed("violations", "document_faults")
    rows = documents.select(
        *kept, document.text("drug").alias("drug"), "document_faults", F.explode_outer(pages).alias("section")
    ).filter(F.col("section").isNotNull() | (F.size("document_faults") > 0))
    checked = check_contract(rows, section_rules(section), is_object(section))
    own = F.when(F.col("section").isNull(), F.array().cast("array<string>")).otherwise(F.col("violations"))
    return checked.select(
        *kept,
        "drug",
        section.text("url").alias("url"),
        section.text("page_type").alias("page_type"),
        blank_text(section.text("heading")).alias("heading"),
        blank_text(section.text("text")).alias("text"),
        blank_list(F.try_variant_get(F.col("section"), "$.bullets", "array<string>")).alias("bullets"),
        F.concat("document_faults", own).alias("violations"),
    )


def contract_batch(headers: DataFrame, records: DataFrame) -> DataFrame:
    """Verdict per (drug, resource): one bad record or header fault rejects the whole batch.

    ``headers`` has drug, resource, bnf_code, source and total_rows; ``records`` is checked records
    with the same keys as ``batch_drug`` and ``batch_resource``. Bad records are counted inside
    each task first, so a batch of any size arrives as a few rows.
    """
    counts = records.groupBy(
        F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource")
    ).agg(
        F.count(F.lit(1)).alias("record_rows"),
        F.count_if(F.size("violations") > 0).alias("bad_records"),
    )
    joined = headers.join(counts, ["drug", "resource"], "left").withColumns(
        {
            "record_rows": F.coalesce("record_rows", F.lit(0)),
            "bad_records": F.coalesce("bad_records", F.lit(0)),
        }
    )
    rules = [
        Rule("bnf_code: text required", F.col("bnf_code").isNull()),
        Rule("source: not the ledger", ~F.coalesce(F.col("source") == RECORD_KINDS[0], F.lit(False))),
        Rule("total_rows: negative", F.coalesce(F.col("total_rows") < 0, F.lit(True))),
        Rule("records: contract broken", F.col("bad_records") > 0),
    ]
    return check_contract(joined, rules).withColumn("accepted", F.size("violations") == 0)


def accepted_records(records: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Records of accepted batches only."""
    refused = verdicts.filter(~F.col("accepted")).select(
        F.col("drug").alias("batch_drug"), F.col("resource").alias("batch_resource")
    )
    return records.join(refused, ["batch_drug", "batch_resource"], "left_anti")


def quarantine_split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row mode of a contract: (valid rows, rejected rows with their reasons)."""
    good = F.size("violations") == 0
    return checked.filter(good).drop("violations"), checked.filter(~good)


def write_quarantine(checked: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """:func:`quarantine_split` of rows that are checked and written once, in a folder for each status."""
    spark = checked.sparkSession
    status = F.when(F.size("violations") == 0, "valid").otherwise("rejected")
    checked.withColumn("status", status).write.partitionBy("status").parquet(base)
    rows = spark.read.schema(T.StructType([*checked.schema.fields, T.StructField("status", T.StringType())])).parquet(base)
    valid = rows.filter(F.col("status") == "valid").drop("status", "violations")
    return valid, rows.filter(F.col("status") == "rejected").drop("status")
