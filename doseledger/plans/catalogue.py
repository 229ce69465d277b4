"""Registered queries: each operator run over the supplied tables, with its comparison SQL.

A query takes (spark, sf_dir) and returns a DataFrame. Queries about writers, streams and table
maintenance first write into fresh folders under the shared scratch space, then return what a
reader finds there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.functions import casting, months
from doseledger.functions.text import section_text, tokenise
from doseledger.operators import contracts, event_log, ingest, practices, quality, rollups, tables, terms
from doseledger.operators import silver as silver_ops
from doseledger.plans import refresh
from doseledger.plans import sql_text as q
from doseledger.schemas import LEDGER_CSV_HEADER, NULL_LIMITS, RAW_RECORD, drug_code_table, promoted_table
from doseledger.session import new_scratch, write_scratch
from doseledger.sources import bronze as lake
from doseledger.sources import inventory, ledger_csv, sample_tables, web_pages
from doseledger.streaming import replay

QUERIES: dict = {}
ORACLE: dict = {}
_ORDER = list(sample_tables.ROW_KEYS)


def query(sql: str | None = None, name: str | None = None):
    """Register a query, by default under its function's name, with comparison SQL where SQL can say it."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        key = name or fn.__name__
        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql
        return fn

    return add


# --- shared inputs ------------------------------------------------------------------------


def _bronze(spark, sf):
    return sample_tables.records(spark, sf)


def _promoted(spark, extra=()):
    return promoted_table(spark, [*sample_tables.PROMOTED, *extra])


def _silver(spark, sf, extra=()):
    return silver_ops.silver(_bronze(spark, sf), _promoted(spark, extra))


def _silver_out(df):
    return df.drop("ingested_at")


def _dim(spark, sf):
    return practices.dim_practice(_silver(spark, sf))


def _keyed(df):
    """Records with their row keys, numbers as given."""
    return df.select(
        "date", "actual_cost", "items", "quantity", "row_id", "setting", "ccg", "drug", "resource"
    )


def _typed(df):
    """Records read back as text, with numbers typed again."""
    return df.withColumns(
        {
            "actual_cost": F.col("actual_cost").cast("double"),
            "items": F.col("items").cast("bigint"),
            "quantity": F.col("quantity").cast("double"),
        }
    )


_lakes: dict = {}


def _lake(spark, sf) -> str:
    """A Bronze lake of the sample records, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _lakes:
        base = new_scratch(spark, "lake")
        lake.write_bronze(_bronze(spark, sf).select(*RAW_RECORD.names, "resource"), base, "nhsbsa_epd", "gzip")
        _lakes[key] = base
    return _lakes[key]


def _database(spark) -> str:
    """A fresh database under the shared scratch space."""
    name = f"dl_{uuid.uuid4().hex[:12]}"
    tables.ensure_database(spark, name, new_scratch(spark, "db"))
    return name


_RECORD_SQL = "SELECT date, actual_cost, items, quantity, row_id, setting, ccg, drug, resource FROM bronze"
_SILVER_SQL = (
    "SELECT date, actual_cost, items, quantity, row_id, setting, ccg, drug, nic_per_item, year_month FROM "
)

# --- sources and sinks --------------------------------------------------------------------

_CSV_FIELDS = """
  date, TRY_CAST(NULLIF(NULLIF(actual_cost, ''), 'NULL') AS DOUBLE) AS actual_cost,
  CAST(trunc(TRY_CAST(NULLIF(NULLIF(items, ''), 'NULL') AS DOUBLE)) AS BIGINT) AS items,
  TRY_CAST(quantity AS DOUBLE) AS quantity, row_id, setting, ccg, icb_name,
  lower(drug) AS drug, 'SUB-' || drug AS bnf_code
"""
_CSV_CODES = {"economy": "SUB-ECONOMY", "small": "SUB-SMALL", "large": "SUB-LARGE", "promo": "SUB-PROMO"}
_CSV_RESOURCE = "'EPD_' || date AS resource"
_CSV_KEPT = "drug IN ('ECONOMY', 'SMALL', 'LARGE', 'PROMO') AND l_orderkey % 17 <> 0"


@query(f"WITH {q.DIRTY} SELECT {_CSV_FIELDS}, {_CSV_RESOURCE} FROM dirty WHERE {_CSV_KEPT}")
def src_epd_csv(spark, sf):
    """Source CSV to records: wanted substances, identified practices; files of two column orders in one folder."""
    path = new_scratch(spark, "csv")
    rows = sample_tables.ledger_csv(spark, sf).drop("resource")
    for part, columns in enumerate((LEDGER_CSV_HEADER, LEDGER_CSV_HEADER[::-1])):
        own = rows.filter(F.col("l_linenumber") % 2 == part).select(*columns)
        own.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return ledger_csv.read_epd_csv(spark, path, drug_code_table(spark, _CSV_CODES))


@query(
    f"""WITH {q.DIRTY} SELECT {_CSV_FIELDS}, resource FROM dirty WHERE {_CSV_KEPT}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY drug, resource
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 25"""
)
def src_row_cap(spark, sf):
    """The first 25 rows per medicine and file, in file order."""
    path = new_scratch(spark, "csv")
    rows = sample_tables.ledger_csv(spark, sf).orderBy("resource", *_ORDER).drop(*_ORDER)
    rows.write.partitionBy("resource").option("header", True).option("escape", '"').csv(path)
    return ledger_csv.read_epd_csv(spark, f"{path}/*", drug_code_table(spark, _CSV_CODES), row_cap=25)


@query(
    f"""WITH {q.BRONZE}, latest AS (
      SELECT DISTINCT resource FROM bronze WHERE starts_with(resource, 'EPD_2')
      ORDER BY resource DESC LIMIT 1)
    {_RECORD_SQL} WHERE resource IN (SELECT resource FROM latest)"""
)
def src_latest_months(spark, sf):
    """Records of the newest source file."""
    return _keyed(ledger_csv.latest_months(_bronze(spark, sf), 1))


@query(f"WITH {q.BRONZE} {_RECORD_SQL}")
def src_bronze_jsonl(spark, sf):
    """The whole lake read back from JSON lines."""
    return _keyed(_typed(lake.read_bronze(spark, _lake(spark, sf))))


@query(
    f"""WITH {q.BRONZE} SELECT date, actual_cost, items, quantity, row_id, ccg, drug FROM bronze
    WHERE l_orderkey % 59 <> 0"""
)
def src_bronze_tolerant(spark, sf):
    """A lake with cut and blank lines read back without them."""
    base = new_scratch(spark, "torn")
    line = F.to_json(
        F.struct("date", "actual_cost", "items", "quantity", "row_id", "ccg", "icb_name", "drug"),
        {"ignoreNullFields": "false"},
    )
    torn = (
        F.when(F.col("l_orderkey") % 59 == 0, F.substring(line, 1, 25))
        .when(F.col("l_orderkey") % 61 == 0, F.concat(line, F.lit("\n\n")))
        .otherwise(line)
    )
    _bronze(spark, sf).select(torn.alias("value"), "drug", "resource").write.partitionBy("drug", "resource").text(base)
    rows = lake.read_bronze(spark, base, tolerant=True)
    return _typed(rows).select("date", "actual_cost", "items", "quantity", "row_id", "ccg", "drug")


@query(f"WITH {q.BRONZE} SELECT date, actual_cost, items, quantity, row_id, setting, ccg, icb_name, drug FROM bronze WHERE drug = 'ECONOMY'")
def src_read_lake(spark, sf):
    """One medicine read back over all its files."""
    return _typed(lake.read_lake(spark, _lake(spark, sf), "ECONOMY", "nhsbsa_epd"))


_SECTION_SQL = """SELECT lang AS drug, source AS page_type, source AS heading, text,
  lang || '|' || source AS bullets, 'doc/' || doc_id AS url FROM documents"""


def _section_docs(sections):
    section = F.struct("url", "page_type", "heading", "text", "bullets")
    return sections.select("drug", F.lit("nhs_pages").alias("type"), F.array(section).alias("pages"))


def _joined_bullets(df):
    return df.withColumn("bullets", F.array_join("bullets", "|"))


@query(_SECTION_SQL)
def src_pages_doc(spark, sf):
    """Page documents flattened to sections."""
    base = new_scratch(spark, "pages")
    lake.write_bronze(_section_docs(sample_tables.sections(spark, sf)), base, "nhs_pages")
    return _joined_bullets(web_pages.read_sections(spark, base))


@query(q.html_sections_sql("html"))
def src_html_sections(spark, sf):
    """Raw web pages to sections."""
    pages = sample_tables.table(spark, sf, "pages")
    return _joined_bullets(web_pages.html_sections(pages))


@query(
    q.html_sections_sql(
        "regexp_replace(replace(html, '<p>', '<h2>Part &amp; parcel</h2><p>'), '<(/?)article>', '<\\1main>', 'g')"
    )
)
def src_html_headings(spark, sf):
    """The same pages with headings: each paragraph opens a section of the page's main part."""
    html = F.regexp_replace(
        F.regexp_replace("html", "<p>", "<h2>Part &amp; parcel</h2><p>"), "<(/?)article>", "<$1main>"
    )
    pages = sample_tables.table(spark, sf, "pages").withColumn("html", html)
    return _joined_bullets(web_pages.html_sections(pages))


_SLUGS = """url || CASE page_id % 3 WHEN 0 THEN '/side-effects-of-x/'
  WHEN 1 THEN '/who-can-and-cannot-take-x/' ELSE '/taking-x-with-other-medicines/' END"""


@query(
    f"""SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN 'side_effects'
      WHEN 1 THEN 'contraindications' ELSE 'interactions' END AS page_type
    FROM (SELECT page_id, {_SLUGS} AS url FROM pages)"""
)
def src_page_type(spark, sf):
    """Kind of page from its address."""
    slug = (
        F.when(F.col("page_id") % 3 == 0, "/side-effects-of-x/")
        .when(F.col("page_id") % 3 == 1, "/who-can-and-cannot-take-x/")
        .otherwise("/taking-x-with-other-medicines/")
    )
    pages = sample_tables.table(spark, sf, "pages").withColumn("url", F.concat("url", slug))
    return pages.select("page_id", "url", web_pages.page_type(F.col("url")).alias("page_type"))


@query(
    """SELECT p_partkey, key, regexp_matches(key, '^[a-z][a-z\\-]*[a-z]$') AS valid FROM (
      SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', '-')
        WHEN p_partkey % 3 = 1 THEN p_name || p_size ELSE p_type END AS key FROM part)"""
)
def src_drug_name_check(spark, sf):
    """Which names may be used as medicine keys."""
    key = (
        F.when(F.col("p_partkey") % 3 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
        .when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.col("p_size").cast("string")))
        .otherwise(F.col("p_type"))
    )
    parts = sample_tables.table(spark, sf, "part").withColumn("key", key)
    return parts.select("p_partkey", "key", web_pages.drug_key_ok(F.col("key")).alias("valid"))


@query(
    f"""WITH {q.BRONZE} SELECT * REPLACE (
      CASE WHEN drug = 'SMALL' AND resource = 'EPD_199612' THEN quantity * 2 ELSE quantity END AS quantity)
    FROM ({_RECORD_SQL})"""
)
def snk_bronze_records(spark, sf):
    """One (medicine, file) partition rewritten; the others stay."""
    base = new_scratch(spark, "lake")
    rows = _bronze(spark, sf).select(*RAW_RECORD.names, "resource")
    lake.write_bronze(rows, base, "nhsbsa_epd")
    changed = rows.filter("drug = 'SMALL' AND resource = 'EPD_199612'")
    lake.write_bronze(changed.withColumn("quantity", F.col("quantity") * 2), base, "nhsbsa_epd")
    return _keyed(_typed(lake.read_bronze(spark, base)))


@query(
    f"""SELECT * REPLACE (CASE WHEN drug = 'fr' THEN 'neu' ELSE heading END AS heading)
    FROM ({_SECTION_SQL})"""
)
def snk_bronze_pages(spark, sf):
    """Page documents of one medicine rewritten; the others stay."""
    base = new_scratch(spark, "pages")
    sections = sample_tables.sections(spark, sf)
    lake.write_bronze(_section_docs(sections), base, "nhs_pages")
    changed = sections.filter("drug = 'fr'").withColumn("heading", F.lit("neu"))
    lake.write_bronze(_section_docs(changed), base, "nhs_pages")
    return _joined_bullets(web_pages.read_sections(spark, base))


@query(
    f"""WITH {q.BRONZE}
    SELECT 'records' AS sink, drug, COUNT(*) AS rows, CAST(SUM(items) AS BIGINT) AS total FROM bronze GROUP BY drug
    UNION ALL
    SELECT 'pages', lang, COUNT(*), CAST(SUM(length(text)) AS BIGINT) FROM documents GROUP BY lang"""
)
def snk_type_router(spark, sf):
    """A mix of payloads sent to the writer each belongs to."""
    bronze = _bronze(spark, sf)
    record = F.struct(*RAW_RECORD.names)
    sections = sample_tables.sections(spark, sf)
    section = F.struct("url", "page_type", "heading", "text", "bullets")
    envelopes = bronze.select(
        F.lit(None).cast("string").alias("type"),
        F.lit("nhsbsa_epd").alias("source"),
        F.col("drug"),
        "resource",
        F.array(record).alias("records"),
    ).unionByName(
        sections.select(F.lit("nhs_pages").alias("type"), "drug", F.array(section).alias("pages")),
        allowMissingColumns=True,
    )
    records_base, pages_base = new_scratch(spark, "records"), new_scratch(spark, "pages")
    lake.route_payloads(envelopes, records_base, pages_base)
    records = _typed(lake.read_bronze(spark, records_base)).groupBy("drug").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("items").alias("total")
    )
    pages = web_pages.read_sections(spark, pages_base).groupBy("drug").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("bigint")).alias("total")
    )
    return records.select(F.lit("records").alias("sink"), "*").unionByName(
        pages.select(F.lit("pages").alias("sink"), "*")
    )


@query(f"WITH {q.SILVER}, {q.TOTALS} SELECT * FROM totals")
def snk_staged_swap(spark, sf):
    """A table published twice through its staging name."""
    table = f"{_database(spark)}.practice_totals"
    totals = rollups.practice_totals(_silver(spark, sf))
    tables.publish(totals.filter("drug = 'SMALL'"), table)
    tables.publish(totals, table)
    return spark.table(table)


@query(f"WITH {q.DIM} SELECT * FROM dim")
def snk_create_or_replace(spark, sf):
    """A dimension table replaced in place."""
    table = f"{_database(spark)}.dim_practice"
    dim = _dim(spark, sf)
    tables.create_or_replace(dim.filter("version_num = 1").drop("is_current"), table)
    tables.create_or_replace(dim, table)
    return spark.table(table)


@query(
    f"""WITH {q.BRONZE} SELECT DISTINCT drug, resource AS folder, true AS holds_data, true AS sizes_agree FROM bronze"""
)
def lake_inventory(spark, sf):
    """Files of the lake with their sizes, summed up per folder."""
    files = inventory.lake_inventory(spark, _lake(spark, sf))
    return files.groupBy("drug", F.regexp_extract("file", r"^resource=([^/]+)/", 1).alias("folder")).agg(
        (F.sum("size_bytes") > 0).alias("holds_data"),
        # a tenth of a kilobyte is 102.4 bytes, so rounding moves a size by 51.2 at most
        F.bool_and(F.abs(F.col("size_kb") * 1024 - F.col("size_bytes")) < 51.3).alias("sizes_agree"),
    )


@query(
    f"""WITH {q.BRONZE} SELECT drug, string_agg(resource, ',' ORDER BY resource) AS partitions,
      CAST(0 AS INTEGER) AS flat_files FROM (SELECT DISTINCT drug, resource FROM bronze) GROUP BY drug"""
)
def lake_partitions(spark, sf):
    """Month partitions per medicine."""
    found = inventory.lake_partitions(spark, _lake(spark, sf))
    names = F.transform("partitions", lambda p: F.regexp_replace(p, "^resource=", ""))
    return found.select("drug", F.array_join(names, ",").alias("partitions"), F.size("flat_files").alias("flat_files"))


# --- projections, filters, predicates -----------------------------------------------------


@query(f"WITH {q.SILVER} {_SILVER_SQL} silver")
def silver_build(spark, sf):
    """Bronze to Silver."""
    return _silver_out(_silver(spark, sf))


_TEXT_CAST = f"""TRY_CAST(date AS DATE) AS date, TRY_CAST(actual_cost AS DOUBLE) AS actual_cost,
  TRY_CAST(items AS BIGINT) AS items, TRY_CAST(quantity AS DOUBLE) AS quantity,
  row_id, setting, ccg, drug, {q.MONTH_KEY} AS year_month"""


@query(f"WITH {q.DIRTY} SELECT {_TEXT_CAST} FROM dirty")
def silver_cast(spark, sf):
    """Unreadable values become NULL."""
    return silver_ops.tolerant_types(sample_tables.text_records(spark, sf))


@query(f"WITH {q.BRONZE} SELECT date, actual_cost, items, quantity, row_id, drug FROM bronze")
def strict_cast(spark, sf):
    """Readable text cast strictly."""
    rows = silver_ops.strict_cast(sample_tables.text_records(spark, sf, dirty=False))
    return rows.select("date", "actual_cost", "items", "quantity", "row_id", "drug")


@query(
    f"""WITH {q.BRONZE} SELECT drug, actual_cost, items,
    ROUND(actual_cost / NULLIF(items, 0), 4) AS nic_per_item FROM bronze"""
)
def null_ratio(spark, sf):
    """Cost per item, NULL where it has no meaning."""
    return _bronze(spark, sf).select(
        "drug", "actual_cost", "items",
        casting.safe_ratio(F.col("actual_cost"), F.col("items")).alias("nic_per_item"),
    )


@query(f"WITH {q.BRONZE} SELECT date, {q.MONTH_KEY} AS year_month, COUNT(*) AS rows FROM bronze GROUP BY ALL")
def month_key(spark, sf):
    """Month keys of both date forms."""
    dates = _bronze(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return dates.select("date", months.month_key(F.col("date")).alias("year_month"), "rows")


@query(f"WITH {q.BRONZE} {_RECORD_SQL} WHERE drug IN ({q.PROMOTED})")
def promote_filter(spark, sf):
    """Records of promoted medicines."""
    return _keyed(silver_ops.promote(_bronze(spark, sf), _promoted(spark)))


@query(
    f"""WITH {q.DIRTY} SELECT date, actual_cost, items, quantity, row_id, drug FROM dirty
    WHERE NOT (actual_cost IS NULL AND items IS NULL)"""
)
def both_null_drop(spark, sf):
    """Rows with neither cost nor items left out, judged on raw values."""
    rows = silver_ops.drop_both_null(sample_tables.text_records(spark, sf))
    return rows.select("date", "actual_cost", "items", "quantity", "row_id", "drug")


@query(f"WITH {q.SILVER} SELECT COUNT(*) AS rows, COUNT(*) AS stamped, CAST(1 AS BIGINT) AS stamps FROM silver")
def audit_stamp(spark, sf):
    """Every row of a build carries the same build time."""
    return _silver(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingested_at").alias("stamped"),
        F.count_distinct("ingested_at").alias("stamps"),
    )


@query(f"WITH {q.SILVER} {_SILVER_SQL} silver WHERE year_month BETWEEN '1996-03' AND '1997-02'")
def month_range(spark, sf):
    """Silver rows of a month window."""
    return _silver_out(silver_ops.month_range(_silver(spark, sf), "1996-03", "1997-02"))


@query(
    f"""WITH {q.BRONZE} SELECT date, actual_cost, items, quantity, row_id, setting, ccg, drug,
    ROUND(actual_cost / NULLIF(items, 0), 4) AS nic_per_item, {q.MONTH_KEY} AS year_month FROM bronze"""
)
def prescribing_frame(spark, sf):
    """All records with the two derived columns."""
    return silver_ops.prescribing_frame(_bronze(spark, sf))


@query(
    f"""WITH {q.DIRTY} SELECT l_orderkey, l_linenumber, actual_cost AS text,
    TRY_CAST(NULLIF(NULLIF(actual_cost, ''), 'NULL') AS DOUBLE) AS value FROM dirty"""
)
def safe_float(spark, sf):
    """Source text to double."""
    rows = sample_tables.text_records(spark, sf)
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("actual_cost").alias("text"),
        casting.safe_float(F.col("actual_cost")).alias("value"),
    )


@query(
    f"""WITH {q.DIRTY} SELECT l_orderkey, l_linenumber, items AS text,
    CAST(trunc(TRY_CAST(NULLIF(NULLIF(items, ''), 'NULL') AS DOUBLE)) AS BIGINT) AS value FROM dirty"""
)
def safe_int(spark, sf):
    """Source text to whole numbers by truncation."""
    rows = sample_tables.text_records(spark, sf)
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("items").alias("text"),
        casting.safe_int(F.col("items")).alias("value"),
    )


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS heading,
    CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang || '|' || source END AS bullets FROM documents"""
)
def blank_text_default(spark, sf):
    """Missing texts and lists replaced by empty ones."""
    rows = sample_tables.sections(spark, sf)
    heading = F.when(F.col("doc_id") % 3 != 0, F.col("heading"))
    bullets = F.when(F.col("doc_id") % 5 != 0, F.col("bullets"))
    return _joined_bullets(
        rows.select(
            "doc_id", casting.blank_text(heading).alias("heading"), casting.blank_list(bullets).alias("bullets")
        )
    )


# --- joins --------------------------------------------------------------------------------


@query(
    f"""WITH {q.BRONZE} SELECT lower(bronze.drug) AS drug, 'SUB-' || bronze.drug AS substance, row_id, items
    FROM bronze WHERE bronze.drug IN ('ECONOMY', 'SMALL', 'LARGE', 'PROMO')"""
)
def join_drug_codes(spark, sf):
    """Records matched to the wanted substance codes."""
    rows = _bronze(spark, sf).select(F.concat(F.lit("SUB-"), "drug").alias("substance"), "row_id", "items")
    return ledger_csv.join_drug_codes(rows, drug_code_table(spark, _CSV_CODES), "substance")


@query(
    f"""WITH {q.DIM} SELECT * FROM dim WHERE valid_from <= DATE '1998-05-01'
    AND (valid_to IS NULL OR valid_to > DATE '1998-05-01')"""
)
def pit_lookup(spark, sf):
    """Practice versions valid on one day."""
    return practices.pit_lookup(_dim(spark, sf), "1998-05-01")


@query(
    f"""WITH {q.DIM} SELECT s.row_id, s.date, s.year_month, s.drug, s.items, s.actual_cost, d.setting AS setting_then,
      d.ccg AS ccg_then, d.version_num, d.practice_id IS NOT NULL AS has_version
    FROM (SELECT *, {q.AS_OF} AS at FROM silver) s LEFT JOIN dim d ON s.row_id = d.practice_id AND d.valid_from <= s.at
      AND (d.valid_to IS NULL OR d.valid_to > s.at)"""
)
def pit_join(spark, sf):
    """Every record with its practice's attributes on its day, or on the first of its month."""
    silver = _silver(spark, sf)
    facts = silver.select("row_id", "date", "year_month", "drug", "items", "actual_cost")
    return practices.pit_join(facts, practices.dim_practice(silver))


@query(
    f"""WITH {q.DIM_DAYS_ONLY} SELECT s.row_id, s.date, s.drug, s.items, s.actual_cost, d.setting AS setting_then,
      d.ccg AS ccg_then, d.version_num
    FROM silver s JOIN dim d ON s.row_id = d.practice_id AND d.valid_from <= s.date
      AND (d.valid_to IS NULL OR d.valid_to > s.date)"""
)
def pit_join_days_only(spark, sf):
    """The same for records and versions with a day of their own; others have no place in time and are left out."""
    silver = _silver(spark, sf)
    facts = silver.select("row_id", "date", "drug", "items", "actual_cost")
    joined = practices.pit_join(facts, practices.dim_practice(silver, impute_month_start=False), impute_month_start=False)
    return joined.filter("has_version").drop("has_version")


_BROKEN_DIM = """broken AS (SELECT * REPLACE (
  CASE WHEN version_num = 1 AND CAST(substr(practice_id, 2) AS BIGINT) % 10 = 0
       THEN valid_to - INTERVAL 1 DAY ELSE valid_to END::DATE AS valid_to) FROM dim)"""


@query(
    f"""WITH {q.DIM}, {_BROKEN_DIM}
    SELECT a.practice_id, a.version_num, a.valid_to, b.valid_from AS next_from
    FROM broken a JOIN broken b ON a.practice_id = b.practice_id AND b.version_num = a.version_num + 1
    WHERE a.valid_to IS DISTINCT FROM b.valid_from"""
)
def version_gap_check(spark, sf):
    """Gaps between versions, in a dimension with some planted."""
    number = F.substring("practice_id", 2, 20).cast("bigint")
    planted = (F.col("version_num") == 1) & (number % 10 == 0)
    dim = _dim(spark, sf).withColumn(
        "valid_to", F.when(planted, F.date_sub("valid_to", 1)).otherwise(F.col("valid_to"))
    )
    return practices.version_gap_check(dim)


_LANG_DRUG = "CASE drug WHEN 'en' THEN 'ECONOMY' WHEN 'fr' THEN 'SMALL' WHEN 'de' THEN 'LARGE' ELSE 'MEDIUM' END"


@query(
    f"""WITH {q.SILVER}, {q.SUMMARY}, {q.TOP_TERMS}
    SELECT s.drug, total_items, total_cost_gbp, avg_nic_per_item, term, frequency, page_type
    FROM summary s JOIN (SELECT * REPLACE ({_LANG_DRUG} AS drug) FROM top_terms) t ON s.drug = t.drug"""
)
def summary_terms_join(spark, sf):
    """Gold summary beside the terms of each medicine's pages."""
    drug = (
        F.when(F.col("drug") == "en", "ECONOMY").when(F.col("drug") == "fr", "SMALL")
        .when(F.col("drug") == "de", "LARGE").otherwise("MEDIUM")
    )
    found = terms.top_terms(sample_tables.sections(spark, sf)).withColumn("drug", drug)
    return terms.summary_terms_join(rollups.drug_summary(_silver(spark, sf)), found)


@query(
    f"""WITH {q.SILVER}, {q.LEADERBOARD} SELECT DISTINCT practice_id FROM leaderboard
    WHERE practice_id NOT IN (SELECT row_id FROM silver WHERE CAST(substr(row_id, 2) AS BIGINT) % 7 <> 0)"""
)
def subset_check(spark, sf):
    """Leaderboard practices missing from a Silver that lost some."""
    silver = _silver(spark, sf)
    lost = silver.filter(F.substring("row_id", 2, 20).cast("bigint") % 7 != 0)
    return rollups.subset_check(rollups.practice_leaderboard(silver), lost)


# --- aggregates, windows, top-k -----------------------------------------------------------


@query(f"WITH {q.SILVER}, {q.SUMMARY} SELECT * FROM summary")
def drug_summary(spark, sf):
    """Totals per medicine."""
    return rollups.drug_summary(_silver(spark, sf))


@query(f"WITH {q.SILVER}, {q.MONTHLY} SELECT * FROM monthly")
def drug_monthly_spend(spark, sf):
    """Totals per medicine and month."""
    return rollups.drug_monthly_spend(_silver(spark, sf))


@query(f"WITH {q.SILVER}, {q.TOTALS} SELECT * FROM totals")
def practice_totals(spark, sf):
    """Totals per medicine and practice."""
    return rollups.practice_totals(_silver(spark, sf))


@query(f"WITH {q.DIM} SELECT * FROM dim_versions")
def practice_versions(spark, sf):
    """First and last day of each version."""
    return practices.practice_versions(_silver(spark, sf))


@query(
    f"""WITH {q.BRONZE} SELECT drug, COUNT(*) AS rows, MIN(date) AS earliest, MAX(date) AS latest,
    COUNT(*) FILTER (WHERE actual_cost IS NULL) AS null_cost_rows FROM bronze GROUP BY drug"""
)
def bronze_profile(spark, sf):
    """Rows, dates and missing costs per medicine."""
    return rollups.bronze_profile(_bronze(spark, sf))


@query(
    f"""WITH {q.BRONZE} SELECT ccg AS icb_code, COUNT(*) AS rows, ROUND(SUM(actual_cost), 2) AS total_cost_gbp,
      CAST(SUM(items) AS BIGINT) AS total_items
    FROM bronze WHERE actual_cost IS NOT NULL GROUP BY ccg ORDER BY total_cost_gbp DESC, icb_code LIMIT 5"""
)
def icb_top_cost(spark, sf):
    """Commissioning bodies with the highest cost."""
    return rollups.icb_top_cost(_bronze(spark, sf))


@query(
    f"""WITH {q.BRONZE} SELECT drug, ROUND(AVG(actual_cost / NULLIF(items, 0)), 4) AS avg_cost_per_item_gbp,
      COUNT(*) FILTER (WHERE actual_cost IS NULL OR items IS NULL) AS null_rows
    FROM bronze GROUP BY drug"""
)
def avg_cost_per_item(spark, sf):
    """Mean of row ratios per medicine."""
    return rollups.avg_cost_per_item(_bronze(spark, sf))


def _report_sql(field: str) -> str:
    return f"""SELECT '{field}' AS field, COUNT(*) - COUNT({field}) AS null_count,
      ROUND((COUNT(*) - COUNT({field})) * 100.0::DOUBLE / COUNT(*), 2) AS null_pct,
      COUNT(DISTINCT {field}) + CAST(COUNT(*) > COUNT({field}) AS BIGINT) AS unique_count FROM bronze"""


@query(
    f"WITH {q.BRONZE} "
    + " UNION ALL ".join(_report_sql(f) for f in ("actual_cost", "items", "quantity", "setting"))
)
def veracity_report(spark, sf):
    """NULLs and distinct values per field."""
    return quality.veracity_report(_bronze(spark, sf))


def _gate_sql(field: str, limit: float) -> str:
    return f"""SELECT '{field}' AS field, pct AS null_pct, {limit}::DOUBLE AS threshold, pct > {limit} AS violated
      FROM (SELECT ROUND((COUNT(*) - COUNT({field})) * 100.0::DOUBLE / COUNT(*), 2) AS pct FROM silver)"""


@query(
    f"WITH {q.SILVER} "
    + " UNION ALL ".join(_gate_sql(f, v) for f, v in (("actual_cost", 5.0), ("items", 3.0), ("setting", 1.0)))
)
def null_rate_gate(spark, sf):
    """Null shares of Silver against their limits."""
    return quality.null_rate_gate(_silver(spark, sf))


@query(
    f"WITH {q.SILVER} "
    + " UNION ALL ".join(_gate_sql(f, v) for f, v in (("actual_cost", 5.0), ("items", 3.0), ("setting", 1.0)))
)
def null_rate_gate_by_write(spark, sf):
    """The same null shares from counts that the Silver write gathers, without a second scan."""
    written = tables.publish_silver(_silver(spark, sf), f"{_database(spark)}.prescribing")
    counts = F.array(
        *[F.struct(F.lit(f).alias("field"), F.lit(written.nulls[f]).alias("n"), F.lit(float(v)).alias("threshold")) for f, v in NULL_LIMITS.items()]
    )
    share = casting.round_half_away(F.col("n") * F.lit(100.0) / F.lit(written.rows), 2)
    rows = spark.range(1).select(F.inline(counts)).select("field", share.alias("null_pct"), "threshold")
    return rows.withColumn("violated", F.col("null_pct") > F.col("threshold"))


def _near_sql(field: str) -> str:
    return f"""SELECT '{field}' AS field, COUNT(*) - COUNT({field}) AS null_count,
      ROUND((COUNT(*) - COUNT({field})) * 100.0::DOUBLE / COUNT(*), 2) AS null_pct,
      COUNT(DISTINCT {field}) + CAST(COUNT(*) > COUNT({field}) AS BIGINT) AS unique_count, true AS near FROM silver"""


@query(
    f"WITH {q.SILVER} " + " UNION ALL ".join(_near_sql(f) for f in ("actual_cost", "items", "quantity", "setting"))
)
def veracity_report_sketched(spark, sf):
    """The report from monthly sketches kept as a table, some months replaced; estimates stand within 5 % of exact counts."""
    table = f"{_database(spark)}.sketches"
    silver = _silver(spark, sf)
    tables.publish(quality.month_sketches(silver.withColumn("items", F.lit(1).cast("bigint"))), table, [tables.MONTH])
    for first, last in (("0000-00", "1996-12"), ("1997-01", "9999-99")):
        tables.replace_months(quality.month_sketches(silver_ops.month_range(silver, first, last)), table, first, last)
    rough = quality.approx_report(spark.table(table)).withColumnRenamed("unique_count", "estimate")
    exact = quality.veracity_report(silver).select("field", "unique_count")
    near = F.abs(F.col("estimate") - F.col("unique_count")) <= F.col("unique_count") * 0.05
    return rough.join(exact, "field").select("field", "null_count", "null_pct", "unique_count", near.alias("near"))


@query(
    f"""WITH {q.DIM} SELECT COUNT(*) AS total_versions, COUNT(DISTINCT practice_id) AS unique_practices,
      COUNT(*) FILTER (WHERE is_current) AS current_versions,
      COUNT(*) FILTER (WHERE NOT is_current) AS historical_versions,
      COUNT(*) FILTER (WHERE version_num > 1) AS changed_versions FROM dim"""
)
def version_counts(spark, sf):
    """Versions of the dimension by kind."""
    return practices.version_counts(_dim(spark, sf))


@query(
    f"""WITH {q.DIM} SELECT practice_id, COUNT(*) FILTER (WHERE is_current OR
        (version_num = 1 AND CAST(substr(practice_id, 2) AS BIGINT) % 9 = 0)) AS current_rows
    FROM dim GROUP BY practice_id HAVING current_rows <> 1"""
)
def current_uniqueness(spark, sf):
    """Practices without exactly one current version, some planted."""
    planted = (F.col("version_num") == 1) & (F.substring("practice_id", 2, 20).cast("bigint") % 9 == 0)
    dim = _dim(spark, sf).withColumn("is_current", F.col("is_current") | planted)
    return practices.current_uniqueness(dim)


@query(
    f"""WITH {q.SILVER} SELECT CAST(SUM(items) AS BIGINT) AS silver_items,
    CAST(SUM(items) AS BIGINT) AS gold_items, true AS balanced FROM silver"""
)
def layer_reconcile(spark, sf):
    """Silver items against Gold items."""
    silver = _silver(spark, sf)
    return rollups.layer_reconcile(silver, rollups.drug_summary(silver))


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows FROM {cte}"
    for name, cte in (
        ("silver", "silver"), ("drug_summary", "summary"), ("drug_monthly_spend", "monthly"),
        ("practice_leaderboard", "leaderboard"), ("dim_practice", "dim"),
    )
)


@query(f"WITH {q.DIM}, {q.SUMMARY}, {q.MONTHLY}, {q.LEADERBOARD} {_COUNTS_SQL}")
def table_counts(spark, sf):
    """Row counts of the derived tables."""
    silver = _silver(spark, sf)
    return rollups.table_counts(
        {
            "silver": silver,
            "drug_summary": rollups.drug_summary(silver),
            "drug_monthly_spend": rollups.drug_monthly_spend(silver),
            "practice_leaderboard": rollups.practice_leaderboard(silver),
            "dim_practice": practices.dim_practice(silver),
        }
    )


@query(f"WITH {q.SILVER}, {q.LEADERBOARD} SELECT * FROM leaderboard")
def practice_leaderboard(spark, sf):
    """Top twenty practices per medicine."""
    return rollups.practice_leaderboard(_silver(spark, sf))


@query(f"WITH {q.DIM} SELECT * FROM dim")
def dim_practice(spark, sf):
    """Versioned practice dimension, records known by month dated to its first day."""
    return _dim(spark, sf)


@query(f"WITH {q.DIM_DAYS_ONLY} SELECT * FROM dim")
def dim_practice_days_only(spark, sf):
    """The dimension from dates as the source gives them: versions known by month only are undated."""
    return practices.dim_practice(_silver(spark, sf), impute_month_start=False)


@query(f"WITH {q.DIM} SELECT * FROM dim")
def dim_practice_partials(spark, sf):
    """The dimension from monthly partial aggregates instead of records."""
    return practices.dim_practice(rollups.month_partials(_silver(spark, sf)))


@query(
    f"""WITH {q.SILVER}, {q.SUMMARY} SELECT drug, total_items, ROUND(total_cost_gbp, 2) AS cost_gbp,
      ROUND(avg_nic_per_item, 4) AS cost_per_item FROM summary ORDER BY cost_gbp DESC, drug LIMIT 3"""
)
def top_cost_drugs(spark, sf):
    """Medicines with the highest cost."""
    return rollups.top_cost_drugs(rollups.drug_summary(_silver(spark, sf)))


@query(f"WITH {q.SILVER}, {q.SUMMARY} SELECT drug, ROUND(avg_nic_per_item, 2) AS cost_per_item FROM summary")
def cost_per_item_order(spark, sf):
    """Medicines by cost per item."""
    return rollups.cost_per_item_order(rollups.drug_summary(_silver(spark, sf)))


@query(
    f"""WITH {q.TERMS} SELECT term, frequency FROM terms WHERE drug = 'en'
    ORDER BY frequency DESC, term, page_type LIMIT 8"""
)
def chart_terms_feed(spark, sf):
    """Top terms of one medicine for a chart."""
    return rollups.chart_terms_feed(terms.term_counts(sample_tables.sections(spark, sf)), "en")


@query(
    f"""WITH {q.SILVER}, {q.MONTHLY} SELECT drug, year_month, total_cost_gbp FROM monthly
    WHERE drug IN ('SMALL', 'LARGE', 'UNKNOWN')"""
)
def chart_trend_feed(spark, sf):
    """Monthly cost series of chosen medicines."""
    monthly = rollups.drug_monthly_spend(_silver(spark, sf))
    return rollups.chart_trend_feed(monthly, ["SMALL", "LARGE", "UNKNOWN"])


# --- text ---------------------------------------------------------------------------------


@query(f"SELECT doc_id, array_to_string({q.tokens_sql('text')}, ' ') AS tokens FROM documents", name="tokenise")
def tokenise_text(spark, sf):
    """Tokens of every document, in order."""
    docs = sample_tables.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(tokenise(F.col("text")), " ").alias("tokens"))



@query(
    "SELECT doc_id, source || ' ' || text || ' ' || lang || ' ' || source AS full_text FROM documents",
    name="section_text",
)
def section_text_join(spark, sf):
    """Heading, text and bullets as one text."""
    rows = sample_tables.sections(spark, sf)
    return rows.select(
        "doc_id", section_text(F.col("heading"), F.col("text"), F.col("bullets")).alias("full_text")
    )



@query(f"WITH {q.TERMS} SELECT * FROM terms")
def term_counts(spark, sf):
    """Frequency of every term per medicine and page type."""
    return terms.term_counts(sample_tables.sections(spark, sf))


@query(f"WITH {q.TOP_TERMS} SELECT * FROM top_terms")
def top_terms(spark, sf):
    """Twenty most frequent terms per medicine."""
    return terms.top_terms(sample_tables.sections(spark, sf))


# --- contracts ----------------------------------------------------------------------------


def _checked_records(spark, sf):
    return contracts.contract_records(sample_tables.record_lines(spark, sf))


@query(
    f"""WITH {q.BRONZE}, {q.RECORD_CHECK} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reasons,
      CASE WHEN reasons = '' THEN actual_cost END AS actual_cost,
      CASE WHEN reasons = '' THEN items END AS items,
      CASE WHEN reasons = '' THEN quantity END AS quantity,
      CASE WHEN reasons = '' THEN setting END AS setting,
      CASE WHEN reasons = '' THEN date END AS date FROM checked"""
)
def contract_records(spark, sf):
    """Raw record lines checked; fields of valid ones."""
    valid = F.size("violations") == 0
    return _checked_records(spark, sf).select(
        *_ORDER,
        F.array_join("violations", "; ").alias("reasons"),
        *[F.when(valid, F.col(c)).alias(c) for c in ("actual_cost", "items", "quantity", "setting", "date")],
    )


def _headers(spark, sf):
    """Envelope fields of the sample batches, some at fault."""
    return _bronze(spark, sf).groupBy("drug", "resource").agg(F.count(F.lit(1)).alias("n")).select(
        "drug",
        "resource",
        F.concat(F.lit("SUB-"), "drug").alias("bnf_code"),
        F.when(F.col("drug") == "PROMO", "elsewhere").otherwise("nhsbsa_epd").alias("source"),
        F.when((F.col("drug") == "LARGE") & (F.col("resource") == "EPD_199612"), F.lit(-1)).otherwise(F.col("n")).alias("total_rows"),
    )


_HEADERS_SQL = """headers AS (
  SELECT drug, resource, 'SUB-' || drug AS bnf_code,
    CASE WHEN drug = 'PROMO' THEN 'elsewhere' ELSE 'nhsbsa_epd' END AS source,
    CASE WHEN drug = 'LARGE' AND resource = 'EPD_199612' THEN -1 ELSE COUNT(*) END AS total_rows
  FROM bronze GROUP BY drug, resource)"""


@query(
    f"""WITH {q.BRONZE}, {q.RECORD_CHECK}, {_HEADERS_SQL}, counts AS (
      SELECT batch_drug, batch_resource, COUNT(*) AS record_rows, COUNT(*) FILTER (WHERE reasons <> '') AS bad_records
      FROM checked GROUP BY ALL)
    SELECT drug, resource, record_rows, bad_records, concat_ws('; ',
        CASE WHEN source <> 'nhsbsa_epd' THEN 'source: not the ledger' END,
        CASE WHEN total_rows < 0 THEN 'total_rows: negative' END,
        CASE WHEN bad_records > 0 THEN 'records: contract broken' END) AS reasons,
      source = 'nhsbsa_epd' AND total_rows >= 0 AND bad_records = 0 AS accepted
    FROM headers JOIN counts ON drug = batch_drug AND resource = batch_resource"""
)
def contract_batch(spark, sf):
    """Verdict per medicine and file: one bad record refuses the batch."""
    headers = _headers(spark, sf)
    verdicts = contracts.contract_batch(headers, _checked_records(spark, sf))
    return verdicts.select(
        "drug", "resource", "record_rows", "bad_records",
        F.array_join("violations", "; ").alias("reasons"), "accepted",
    )


@query(
    """WITH docs AS (SELECT doc_id, lang AS drug, text,
      CASE doc_id % 5 WHEN 0 THEN 'side_effects' WHEN 1 THEN 'contraindications' WHEN 2 THEN 'interactions'
        WHEN 3 THEN 'dosage' END AS page_type,
      CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE 'nhs_pages' END AS type FROM documents)
    SELECT doc_id, drug, page_type, '' AS heading, text,
      CASE WHEN doc_id % 3 = 0 THEN '' ELSE drug END AS bullets,
      concat_ws('; ', CASE WHEN type = 'other' THEN 'type: not one of nhs_pages' END,
        CASE WHEN page_type IS NULL OR page_type = 'dosage'
          THEN 'page_type: not one of side_effects, contraindications, interactions' END) AS reasons
    FROM docs"""
)
def contract_pages(spark, sf):
    """Page documents checked section by section."""
    docs = sample_tables.table(spark, sf, "documents")
    kind = (
        F.when(F.col("doc_id") % 5 == 0, "side_effects").when(F.col("doc_id") % 5 == 1, "contraindications")
        .when(F.col("doc_id") % 5 == 2, "interactions").when(F.col("doc_id") % 5 == 3, "dosage")
    )
    section = F.struct(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        kind.alias("page_type"),
        F.col("text"),
        F.when(F.col("doc_id") % 3 != 0, F.array("lang")).alias("bullets"),
        F.lit(1).alias("extra"),
    )
    line = F.to_json(
        F.struct(
            F.col("lang").alias("drug"),
            F.when(F.col("doc_id") % 7 == 0, "other").otherwise("nhs_pages").alias("type"),
            F.array(section).alias("pages"),
        )
    )
    checked = contracts.contract_pages(docs.select("doc_id", line.alias("value")))
    return _joined_bullets(checked).select(
        "doc_id", "drug", "page_type", "heading", "text", "bullets",
        F.array_join("violations", "; ").alias("reasons"),
    )


@query(
    f"""WITH {q.BRONZE}, {q.RECORD_CHECK} SELECT CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS status,
    batch_drug, batch_resource, reasons, COUNT(*) AS rows FROM checked GROUP BY ALL"""
)
def quarantine_split(spark, sf):
    """Valid and rejected rows counted per batch and reason."""
    valid, rejected = contracts.write_quarantine(_checked_records(spark, sf), new_scratch(spark, "quarantine"))
    both = valid.select(F.lit("valid").alias("status"), "batch_drug", "batch_resource", F.lit("").alias("reasons")).unionByName(
        rejected.select(
            F.lit("rejected").alias("status"), "batch_drug", "batch_resource",
            F.array_join("violations", "; ").alias("reasons"),
        )
    )
    return both.groupBy("status", "batch_drug", "batch_resource", "reasons").agg(F.count(F.lit(1)).alias("rows"))


_GOLD_SQL = """SELECT 'drug_summary' AS table_name, drug AS key, '' AS sub_key, total_items, total_cost_gbp FROM summary
    UNION ALL SELECT 'drug_monthly_spend', drug, COALESCE(year_month, ''), total_items, total_cost_gbp FROM monthly
    UNION ALL SELECT 'practice_leaderboard', drug, rank || ' ' || practice_id, total_items, total_cost_gbp FROM leaderboard
    UNION ALL SELECT 'dim_practice', practice_id, version_num || ' ' || setting || ' ' || ccg,
      CAST(strftime(valid_from, '%Y%m%d') AS BIGINT), CAST(strftime(valid_to, '%Y%m%d') AS DOUBLE) FROM dim"""


def _gold_rows(spark, gold):
    """Content of the published Gold tables and dimension in one shape."""
    def rows(name, key, sub_key, items=F.col("total_items"), cost=F.col("total_cost_gbp")):
        return spark.table(f"{gold}.{name}").select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), sub_key.alias("sub_key"),
            items.cast("bigint").alias("total_items"), cost.cast("double").alias("total_cost_gbp"),
        )

    def day(name):
        return F.date_format(name, "yyyyMMdd")

    return (
        rows("drug_summary", "drug", F.lit(""))
        .unionByName(rows("drug_monthly_spend", "drug", F.coalesce("year_month", F.lit(""))))
        .unionByName(rows("practice_leaderboard", "drug", F.concat_ws(" ", "rank", "practice_id")))
        .unionByName(rows("dim_practice", "practice_id", F.concat_ws(" ", "version_num", "setting", "ccg"), day("valid_from"), day("valid_to")))
    )


# --- ingest -------------------------------------------------------------------------------

# a first run over all batches; a second one brings fewer rows of one batch, and another under a foreign label
_AGAIN, _FOREIGN = ("SMALL", "EPD_199912"), ("LARGE", "EPD_199912")
_VALID = "CASE WHEN reasons = '' THEN"
_INGEST_FIELDS = ", ".join(
    f"{_VALID} {c} END AS {name}"
    for c, name in (("date", "date"), ("actual_cost", "actual_cost"), ("items", "items"), ("quantity", "quantity"),
                    ("row_id", "row_id"), ("setting", "setting"), ("ccg", "ccg"), ("batch_drug", "drug"))
)


@query(
    f"""WITH {q.BRONZE}, {q.RECORD_CHECK}, {_HEADERS_SQL}, first_run AS (
      SELECT c.*, concat_ws('; ', CASE WHEN source <> 'nhsbsa_epd' THEN 'source: not the ledger' END,
          CASE WHEN total_rows < 0 THEN 'total_rows: negative' END,
          CASE WHEN COUNT(*) FILTER (WHERE reasons <> '') OVER (PARTITION BY batch_drug, batch_resource) > 0
            THEN 'records: contract broken' END) AS batch_reasons
      FROM checked c JOIN headers ON drug = batch_drug AND resource = batch_resource),
    runs AS (
      SELECT 1 AS run, * FROM first_run
      UNION ALL SELECT 2, * REPLACE ('' AS batch_reasons) FROM first_run
        WHERE batch_drug = '{_AGAIN[0]}' AND batch_resource = '{_AGAIN[1]}' AND l_linenumber = 1
      UNION ALL SELECT 2, * REPLACE ('source: not the ledger' AS batch_reasons) FROM first_run
        WHERE batch_drug = '{_FOREIGN[0]}' AND batch_resource = '{_FOREIGN[1]}')
    SELECT CASE WHEN batch_reasons = '' THEN 'bronze' ELSE 'rejected' END AS state, batch_resource AS resource,
      l_orderkey, l_linenumber, l_partkey, l_suppkey, {_INGEST_FIELDS}, reasons, batch_reasons
    FROM runs WHERE batch_reasons <> '' OR run = 2 OR NOT (batch_drug = '{_AGAIN[0]}' AND batch_resource = '{_AGAIN[1]}')"""
)
def ingest_run(spark, sf):
    """Deliveries checked, written and committed by batch: all rows of Bronze, and of refused batches with their reasons."""
    base = new_scratch(spark, "ingest")
    lines, headers = sample_tables.record_lines(spark, sf), write_scratch(_headers(spark, sf), "headers")
    ingest.ingest_lines(lines, headers, base)
    def named(batch):
        return (F.col("batch_drug") == batch[0]) & (F.col("batch_resource") == batch[1])

    more = lines.filter((named(_AGAIN) & (F.col("l_linenumber") == 1)) | named(_FOREIGN))
    foreign = F.when(F.col("drug") == _FOREIGN[0], "elsewhere").otherwise(F.col("source"))
    later = headers.withColumn("source", foreign).join(
        more.select(F.col("batch_drug").alias("drug"), F.col("batch_resource").alias("resource")).distinct(), ["drug", "resource"], "left_semi"
    )
    ingest.ingest_lines(more, later.withColumn("total_rows", F.lit(1).cast("bigint")), base)
    fields = ("date", "actual_cost", "items", "quantity", "row_id", "setting", "ccg", "drug")
    kept = ingest.read_committed(spark, base).select(
        F.lit("bronze").alias("state"), "resource", *_ORDER, *fields, F.lit("").alias("reasons"), F.lit("").alias("batch_reasons")
    )
    valid = F.size("violations") == 0
    refused = ingest.read_rejects(spark, base).select(
        F.lit("rejected").alias("state"), F.col("batch_resource").alias("resource"), *_ORDER,
        *[F.when(valid, F.col(c)).alias(c) for c in fields],
        F.array_join("violations", "; ").alias("reasons"), F.array_join("batch_reasons", "; ").alias("batch_reasons"),
    )
    return kept.unionByName(refused)


_PAGE_TYPE = "CASE doc_id % 3 WHEN 0 THEN 'side_effects' WHEN 1 THEN 'contraindications' ELSE 'interactions' END"


@query(
    f"""WITH {q.DIRTY}, bronze AS (SELECT {_CSV_FIELDS}, resource FROM dirty WHERE {_CSV_KEPT}),
    {q.silver_cte(promoted="'economy', 'small', 'large'")}, {q.SUMMARY}, {q.MONTHLY}, {q.LEADERBOARD}, {q.dim_cte()},
    terms AS (SELECT drug, term, page_type, COUNT(*) AS frequency FROM (
      SELECT lang AS drug, {_PAGE_TYPE} AS page_type,
        unnest({q.tokens_sql("source || ' ' || text || ' ' || lang || ' ' || source")}) AS term
      FROM documents WHERE lang <> 'es') GROUP BY ALL)
    {_GOLD_SQL}
    UNION ALL SELECT * FROM (SELECT 'top_terms', drug, term || ' ' || page_type, frequency, NULL::DOUBLE FROM terms QUALIFY ROW_NUMBER() OVER (
      PARTITION BY drug ORDER BY frequency DESC, term, page_type) <= 20)"""
)
def medallion_from_files(spark, sf):
    """The refresh from source CSV and page documents on, one medicine's pages refused; content of the published tables."""
    path, database = new_scratch(spark, "csv"), _database(spark)
    rows = sample_tables.ledger_csv(spark, sf, by_file=True).drop(*_ORDER)
    rows.write.partitionBy("resource").option("header", True).option("escape", '"').csv(path)
    kind = F.when(F.col("doc_id") % 3 == 0, "side_effects").when(F.col("doc_id") % 3 == 1, "contraindications").otherwise("interactions")
    section = F.struct(
        "url", F.when((F.col("drug") == "es") & (F.col("doc_id") % 2 == 0), "dosage").otherwise(kind).alias("page_type"), "heading", "text", "bullets"
    )
    line = F.to_json(F.struct("drug", F.lit("nhs_pages").alias("type"), F.array(section).alias("pages")))
    pages = sample_tables.sections(spark, sf).select(F.col("drug").alias("batch_drug"), line.alias("value"))
    refresh.medallion_from_files(
        spark, f"{path}/*", pages, new_scratch(spark, "bronze"), database, database, new_scratch(spark, "log"),
        drug_code_table(spark, _CSV_CODES), promoted_table(spark, ["economy", "small", "large"]), {"actual_cost": 50.0, "items": 50.0},
    )
    found = spark.table(f"{database}.top_terms")
    return _gold_rows(spark, database).unionByName(
        found.select(
            F.lit("top_terms").alias("table_name"), F.col("drug").alias("key"), F.concat_ws(" ", "term", "page_type").alias("sub_key"),
            F.col("frequency").cast("bigint").alias("total_items"), F.lit(None).cast("double").alias("total_cost_gbp"),
        )
    )


# --- table maintenance --------------------------------------------------------------------

_FROM, _TO = "1994-06", "1996-12"


def _stale_silver(spark, sf):
    """A Silver with wrong costs, undated rows, and a month that Bronze no longer has."""
    rows = _silver(spark, sf)
    old = rows.withColumns(
        {
            "actual_cost": F.col("actual_cost") + 1,
            "year_month": F.when(F.col("quantity") != 7, F.col("year_month")),
            "ingested_at": F.lit("2001-01-01").cast("timestamp"),
        }
    )
    gone = old.filter("year_month = '1995-02'").withColumn("year_month", F.lit("1994-07"))
    return old.unionByName(gone)


_STALE_SQL = """stale AS (SELECT * REPLACE (actual_cost + 1 AS actual_cost,
  CASE WHEN quantity <> 7 THEN year_month END AS year_month) FROM silver)"""


@query(
    f"""WITH {q.SILVER}, {_STALE_SQL}
    {_SILVER_SQL} silver WHERE year_month BETWEEN '{_FROM}' AND '{_TO}'
    UNION ALL {_SILVER_SQL} stale WHERE year_month IS NULL OR year_month NOT BETWEEN '{_FROM}' AND '{_TO}'"""
)
def silver_backfill(spark, sf):
    """A month range of a stale Silver re-derived; the rest is left as it was."""
    table = f"{_database(spark)}.prescribing"
    tables.publish_silver(_stale_silver(spark, sf), table)
    tables.backfill(_bronze(spark, sf), table, _FROM, _TO, _promoted(spark))
    return _silver_out(spark.table(table))


@query(
    f"""WITH {q.SILVER}, {_STALE_SQL}, gone AS (SELECT * FROM stale WHERE year_month = '1995-02'),
    good AS (SELECT COUNT(*) AS n FROM silver WHERE year_month BETWEEN '{_FROM}' AND '{_TO}'),
    was AS (SELECT COUNT(*) AS n FROM (SELECT year_month FROM stale UNION ALL SELECT '1994-07' FROM gone)
      WHERE year_month BETWEEN '{_FROM}' AND '{_TO}'),
    total AS (SELECT (SELECT COUNT(*) FROM stale) + (SELECT COUNT(*) FROM gone) AS n)
    SELECT total.n AS total_before, was.n AS window_before, good.n AS inserted_first, good.n AS inserted_second,
      total.n - was.n + good.n AS total_after, good.n AS window_after, true AS idempotent FROM total, was, good"""
)
def backfill_proof(spark, sf):
    """Counts around a backfill run twice."""
    table = f"{_database(spark)}.prescribing"
    tables.publish_silver(_stale_silver(spark, sf), table)
    return tables.backfill_proof(_bronze(spark, sf), table, _FROM, _TO, _promoted(spark))


@query(
    f"""WITH {q.BRONZE}, {q.silver_cte(name='fresh')}, old AS (SELECT * REPLACE (actual_cost + 1 AS actual_cost,
        items + 1 AS items) FROM fresh),
      silver AS (SELECT * FROM fresh WHERE year_month BETWEEN '{_FROM}' AND '{_TO}'
        UNION ALL SELECT * FROM old WHERE year_month IS NULL OR year_month NOT BETWEEN '{_FROM}' AND '{_TO}'),
      {q.SUMMARY}, {q.MONTHLY}, {q.LEADERBOARD}, {q.dim_cte()} {_GOLD_SQL}"""
)
def gold_after_backfill(spark, sf):
    """Gold of a stale Silver, after a backfill of some months that aggregates only these again."""
    database = _database(spark)
    table = f"{database}.prescribing"
    stale = _silver(spark, sf).withColumns({"actual_cost": F.col("actual_cost") + 1, "items": F.col("items") + 1})
    tables.publish_silver(stale, table)
    refresh.build_gold(spark, table, database)
    refresh.backfill_gold(_bronze(spark, sf), table, database, _FROM, _TO, _promoted(spark))
    return _gold_rows(spark, database)


@query(
    f"""WITH {q.SILVER}, {q.silver_cte(name='wider', promoted=q.PROMOTED + ", 'MEDIUM'")}
    {_SILVER_SQL} silver UNION ALL
    {_SILVER_SQL} wider WHERE drug = 'MEDIUM' AND year_month BETWEEN '{_FROM}' AND '{_TO}'"""
)
def late_promotion(spark, sf):
    """One more medicine promoted and backfilled over a month range."""
    table = f"{_database(spark)}.prescribing"
    tables.publish_silver(_silver(spark, sf), table)
    tables.backfill(_bronze(spark, sf), table, _FROM, _TO, _promoted(spark, ["MEDIUM"]))
    return _silver_out(spark.table(table))


@query(
    f"""WITH {q.SILVER}, injected AS (
      SELECT row_id, setting, ccg, date, year_month FROM silver
      UNION ALL SELECT 'S1', '4', 'OLD001', DATE '1991-06-01', '1991-06'), {q.dim_cte('injected')}
    SELECT * FROM dim"""
)
def history_injection(spark, sf):
    """A practice given an earlier version, and the dimension rebuilt."""
    return practices.dim_practice(tables.inject_history(_silver(spark, sf), "S1", "OLD001", "1991-06-01"))


@query(
    f"""WITH {q.DIM}, {q.SUMMARY}, {q.MONTHLY}, {q.LEADERBOARD}, {q.TOP_TERMS} {_COUNTS_SQL}
    UNION ALL SELECT 'veracity_report', 4 UNION ALL SELECT 'top_terms', COUNT(*) FROM top_terms"""
)
def medallion_run(spark, sf):
    """The whole refresh, run over the sample tables."""
    database = _database(spark)
    return refresh.medallion_run(
        _bronze(spark, sf), sample_tables.sections(spark, sf), database, database,
        new_scratch(spark, "log"), _promoted(spark),
    )


# --- streaming ----------------------------------------------------------------------------

_BATCH = 500
_STREAMED = """streamed AS (SELECT * FROM bronze WHERE drug = 'ECONOMY'
  AND resource = (SELECT MAX(resource) FROM bronze WHERE drug = 'ECONOMY'))"""
_NUMBERED = f"""{_STREAMED}, numbered AS (SELECT *, CAST((ROW_NUMBER() OVER (
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // {_BATCH} + 1 AS INTEGER) AS batch_num FROM streamed)"""
_SINK_FIELDS = "date, actual_cost, items, quantity, row_id, setting, ccg, drug"


def _streamed(spark, sf):
    """Records of the newest file of one medicine, with their keys."""
    one = _bronze(spark, sf).filter("drug = 'ECONOMY'")
    return ledger_csv.latest_months(one, 1)


def _numbered(spark, sf):
    """The same records with their batch numbers, as a stream."""
    path = new_scratch(spark, "numbered")
    replay.number_batches(_streamed(spark, sf), _ORDER, _BATCH).select(
        *[F.col(c).cast("string") for c in RAW_RECORD.names], "batch_num"
    ).write.option("ignoreNullFields", False).json(path)
    return spark.readStream.schema(replay.NUMBERED).json(path)


_sinks: dict = {}


def _sink(spark, sf) -> str:
    """A sink filled by streaming the numbered batches, once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _sinks:
        sink = new_scratch(spark, "sink")
        replay.run_stream(_numbered(spark, sf), sink, new_scratch(spark, "progress"))
        _sinks[key] = sink
    return _sinks[key]


@query(f"WITH {q.BRONZE}, {_STREAMED} SELECT {_SINK_FIELDS} FROM streamed")
def stream_source(spark, sf):
    """The newest file of one medicine replayed from the lake into a sink."""
    sink = new_scratch(spark, "sink")
    stream = replay.replay_stream(spark, _lake(spark, sf), "ECONOMY")
    replay.run_stream(stream, sink, new_scratch(spark, "progress"))
    return replay.read_sink(spark, sink).drop("batch_num", "arrived_at")


@query(f"WITH {q.BRONZE}, {_NUMBERED} SELECT batch_num, COUNT(*) AS rows FROM numbered GROUP BY batch_num")
def micro_batches(spark, sf):
    """Records of each batch of a fixed size, as the sink holds them."""
    sink = new_scratch(spark, "sink")
    replay.run_stream(_numbered(spark, sf), sink, new_scratch(spark, "progress"))
    return replay.read_sink(spark, sink).groupBy("batch_num").agg(F.count(F.lit(1)).alias("rows"))


@query(
    f"""WITH {q.BRONZE} SELECT drug, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((ROW_NUMBER() OVER (
      PARTITION BY drug ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // {_BATCH} + 1 AS INTEGER) AS batch_num
    FROM bronze"""
)
def batch_numbering(spark, sf):
    """Batch number of every record of every medicine."""
    rows = _bronze(spark, sf).select("drug", *_ORDER)
    return replay.number_batches(rows, _ORDER, _BATCH)


@query(f"WITH {q.BRONZE}, {_NUMBERED} SELECT {_SINK_FIELDS}, batch_num FROM numbered")
def stream_sink(spark, sf):
    """Numbered batches streamed into the sink, replayed once more without a trace."""
    sink, stream = new_scratch(spark, "sink"), _numbered(spark, sf)
    for _ in range(2):
        replay.run_stream(stream, sink, new_scratch(spark, "progress"))
    return replay.read_sink(spark, sink).drop("arrived_at")


_STREAM_TOTALS = """SELECT drug, COUNT(*) AS total_records, CAST(SUM(items) AS BIGINT) AS total_items,
  ROUND(SUM(actual_cost), 2) AS total_cost_gbp FROM streamed GROUP BY drug"""


@query(f"WITH {q.BRONZE}, {_STREAMED} {_STREAM_TOTALS}")
def stream_reset(spark, sf):
    """A stream run, reset and run again: nothing is doubled."""
    sink, progress = new_scratch(spark, "sink"), new_scratch(spark, "progress")
    base = _lake(spark, sf)
    for _ in range(2):
        replay.reset_stream(spark, sink, "ECONOMY", progress)
        totals = replay.run_stream(replay.replay_stream(spark, base, "ECONOMY"), sink, progress)
    return totals


@query(f"WITH {q.BRONZE}, {_STREAMED} {_STREAM_TOTALS}")
def stream_totals(spark, sf):
    """Running totals kept by the stream itself."""
    stream = replay.replay_stream(spark, _lake(spark, sf), "ECONOMY")
    return replay.run_totals(stream, new_scratch(spark, "totals"), new_scratch(spark, "progress"))


@query(
    f"""WITH {q.BRONZE}, {_NUMBERED} SELECT batch_num, COUNT(*) AS records_in_batch,
    ROUND(SUM(actual_cost), 2) AS batch_cost_gbp FROM numbered GROUP BY batch_num ORDER BY batch_num LIMIT 10"""
)
def batch_snapshot(spark, sf):
    """First batches of a sink."""
    return replay.batch_snapshot(replay.read_sink(spark, _sink(spark, sf))).drop("first_arrived")


@query(f"WITH {q.BRONZE}, {_NUMBERED} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT batch_num) AS total_batches FROM numbered")
def stream_overview(spark, sf):
    """Rows and batches of a sink."""
    return replay.stream_overview(replay.read_sink(spark, _sink(spark, sf))).drop("first_arrived", "last_arrived")


# --- lineage log --------------------------------------------------------------------------


def _events(spark, sf):
    path = new_scratch(spark, "events")
    sample_tables.run_events(spark, sf).write.json(path)
    return event_log.read_events(spark, path)


def _time_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query(
    f"""WITH {q.EVENTS} SELECT event_type, event_time, 'run-' || o_orderkey AS run_id, o_orderpriority AS job_name,
      'layer' || (o_orderkey % 5) || '.' || (o_custkey % 7) AS inputs,
      CASE WHEN o_custkey % 11 = 0 THEN '' ELSE 'layer' || (o_orderkey % 5 + 1) || '.' || (o_custkey % 3) END AS outputs
    FROM events_log"""
)
def lineage_events(spark, sf):
    """The event log as a typed table."""

    def names(column):
        return F.array_join(F.transform(column, lambda d: d["name"]), ",").alias(column)

    return _events(spark, sf).select(
        "event_type", _time_text("event_time").alias("event_time"), "run_id", "job_name", names("inputs"), names("outputs")
    )


@query(
    """SELECT 'run-' || o_orderkey AS run_id, o_orderpriority AS job_name,
      CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'P' THEN 'FAIL' ELSE 'START' END AS state,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at,
      CASE WHEN o_orderstatus IN ('F', 'P') THEN o_custkey % 3600 END AS seconds FROM orders"""
)
def lineage_runs(spark, sf):
    """Final state and duration per run."""
    return event_log.lineage_runs(_events(spark, sf)).select(
        "run_id", "job_name", "state", _time_text("started_at").alias("started_at"), "seconds"
    )


@query(f"WITH {q.EVENTS} SELECT * FROM edges")
def lineage_edges(spark, sf):
    """Dataset to dataset edges of finished runs."""
    return event_log.lineage_edges(_events(spark, sf))


@query(
    f"""WITH RECURSIVE {q.EVENTS}, up(dataset, distance) AS (
      SELECT 'layer5.1', 0 UNION
      SELECT input, distance + 1 FROM up JOIN edges ON output = dataset)
    SELECT dataset, CAST(MIN(distance) AS INTEGER) AS distance FROM up WHERE distance > 0 GROUP BY dataset"""
)
def lineage_upstream(spark, sf):
    """Everything one dataset derives from."""
    return event_log.upstream(event_log.lineage_edges(_events(spark, sf)), "layer5.1")


