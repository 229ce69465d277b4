"""Record shapes and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------
# Medicine name -> chemical substance code, as published in the prescribing data.
DRUG_CODES = {
    "metformin": "0601022B0",
    "liraglutide": "0601023AB",
    "semaglutide": "0601023AW",
    "tirzepatide": "0601023AZ",
    "atorvastatin": "0212000B0",
    "lisinopril": "0205051L0",
    "simvastatin": "0212000Y0",
    "aspirin": "0209000A0",
    "lansoprazole": "0103050E0",
    "levothyroxine": "0602010V0",
    "salbutamol": "0301011R0",
    "amoxicillin": "0501013B0",
}
# Medicines promoted from Bronze to Silver.
PROMOTED_DRUGS = (
    "metformin", "semaglutide", "atorvastatin", "simvastatin", "aspirin", "lisinopril",
    "lansoprazole", "levothyroxine", "salbutamol", "amoxicillin",
)
# Largest tolerated share of NULLs per Silver field, in percent.
NULL_LIMITS = {"actual_cost": 5.0, "items": 3.0, "setting": 1.0}
# Fields of the quality report.
REPORT_FIELDS = ("actual_cost", "items", "quantity", "setting")
# Labels that route a payload to its writer.
RECORD_KINDS = ("nhsbsa_epd", "openprescribing")
PAGE_KIND = "nhs_pages"
PAGE_TYPES = ("side_effects", "contraindications", "interactions")
DRUG_KEY_PATTERN = r"^[a-z][a-z\-]*[a-z]$"
RESOURCE_PREFIX = "EPD_2"
RECORDS_FILE = "prescribing.jsonl"
PAGES_FILE = "nhs_pages.json"
RUN_STATES = ("START", "COMPLETE", "FAIL")
# Header of the monthly source CSV.
LEDGER_CSV_HEADER = (
    "YEAR_MONTH", "REGIONAL_OFFICE_NAME", "REGIONAL_OFFICE_CODE", "ICB_NAME", "ICB_CODE",
    "PCO_NAME", "PCO_CODE", "PRACTICE_NAME", "PRACTICE_CODE", "ADDRESS_1", "ADDRESS_2",
    "ADDRESS_3", "ADDRESS_4", "POSTCODE", "BNF_CHEMICAL_SUBSTANCE", "CHEMICAL_SUBSTANCE_BNF_DESCR",
    "BNF_CODE", "BNF_DESCRIPTION", "BNF_CHAPTER_PLUS_CODE", "QUANTITY", "ITEMS", "TOTAL_QUANTITY",
    "ADQUSAGE", "NIC", "ACTUAL_COST", "UNIDENTIFIED",
)
# --- end of fixed values ------------------------------------------------------------------


_TEXT = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Bronze is read as text: quoted numbers and integer settings both arrive intact.
RAW_RECORD = _struct(
    date=_TEXT, actual_cost=_TEXT, items=_TEXT, quantity=_TEXT, row_id=_TEXT, setting=_TEXT,
    ccg=_TEXT, icb_name=_TEXT, drug=_TEXT,
)
SECTION = _struct(
    url=_TEXT, page_type=_TEXT, heading=_TEXT, text=_TEXT, bullets=T.ArrayType(_TEXT)
)
PAGES_DOC = _struct(drug=_TEXT, type=_TEXT, pages=T.ArrayType(SECTION))
_DATASETS = T.ArrayType(_struct(namespace=_TEXT, name=_TEXT))
RUN_EVENT = _struct(
    eventType=_TEXT, eventTime=_TEXT, run=_struct(runId=_TEXT),
    job=_struct(namespace=_TEXT, name=_TEXT), inputs=_DATASETS, outputs=_DATASETS,
    producer=_TEXT, schemaURL=_TEXT,
)
SILVER_COLUMNS = (
    "date", "actual_cost", "items", "quantity", "row_id", "setting", "ccg", "drug",
    "nic_per_item", "year_month", "ingested_at",
)


def drug_code_table(spark: SparkSession, codes: dict[str, str] | None = None) -> DataFrame:
    """The medicine/code pairs as a two-column table.

    Built from literals, so the planner knows how small it is and picks the join by size.
    """
    pairs = F.create_map(*[F.lit(v) for kv in (codes or DRUG_CODES).items() for v in kv])
    return spark.range(1).select(F.explode(pairs).alias("drug", "code"))


def promoted_table(spark: SparkSession, drugs=None) -> DataFrame:
    """The promoted medicines as a one-column table; promoting one more is adding a row."""
    names = F.array(*[F.lit(d) for d in (PROMOTED_DRUGS if drugs is None else drugs)])
    return spark.range(1).select(F.explode(names).alias("drug"))
