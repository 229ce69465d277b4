"""Building blocks of the comparison SQL (DuckDB): the same derived tables, written independently."""

from __future__ import annotations

PROMOTED = "'ECONOMY', 'SMALL', 'LARGE'"

_LINES = """
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
"""
_COMMON = """
    CASE WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%Y%m')
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    'S' || l_suppkey AS row_id,
    '4' AS setting,
    CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'C' || s_nationkey
         ELSE 'I' || (s_nationkey % 5) END AS ccg,
    'Board ' || s_nationkey AS icb_name,
    p_type AS drug,
    'EPD_' || strftime(l_shipdate, '%Y') || '12' AS resource,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
"""
_MISSING = "l_orderkey % 53 = 0 OR (l_orderkey % 37 = 0 AND l_linenumber = 1)"

BRONZE = f"""bronze AS (
  SELECT {_COMMON},
    CASE WHEN l_orderkey % 37 <> 0 THEN l_extendedprice END AS actual_cost,
    CASE WHEN {_MISSING} THEN NULL WHEN l_orderkey % 41 = 0 THEN 0
         ELSE CAST(l_quantity AS BIGINT) END AS items,
    l_quantity AS quantity
  {_LINES})"""

DIRTY = f"""dirty AS (
  SELECT {_COMMON},
    CASE WHEN l_orderkey % 29 = 0 THEN 'n/a' WHEN l_orderkey % 31 = 0 THEN ''
         WHEN l_orderkey % 43 = 0 THEN 'NULL' WHEN l_orderkey % 37 = 0 THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS actual_cost,
    CASE WHEN l_orderkey % 23 = 0 THEN 'twelve'
         WHEN l_orderkey % 19 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5'
         WHEN {_MISSING} THEN NULL WHEN l_orderkey % 41 = 0 THEN '0'
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS items,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS quantity
  {_LINES})"""

MONTH_KEY = (
    "COALESCE(strftime(try_strptime(date, '%Y%m'), '%Y-%m'), "
    "strftime(TRY_CAST(date AS DATE), '%Y-%m'))"
)


def silver_cte(source: str = "bronze", name: str = "silver", promoted: str = PROMOTED) -> str:
    return f"""{name} AS (
  SELECT TRY_CAST(date AS DATE) AS date, actual_cost, items, quantity, row_id, setting, ccg, drug,
    ROUND(actual_cost / NULLIF(items, 0), 4) AS nic_per_item,
    {MONTH_KEY} AS year_month
  FROM {source}
  WHERE drug IN ({promoted}) AND NOT (actual_cost IS NULL AND items IS NULL))"""


SILVER = f"{BRONZE}, {silver_cte()}"

SUMMARY = """summary AS (
  SELECT drug, CAST(SUM(items) AS BIGINT) AS total_items, ROUND(SUM(actual_cost), 2) AS total_cost_gbp,
    ROUND(SUM(actual_cost) / NULLIF(SUM(items), 0), 4) AS avg_nic_per_item,
    COUNT(DISTINCT row_id) AS unique_practices, COUNT(DISTINCT year_month) AS months_of_data
  FROM silver GROUP BY drug)"""

MONTHLY = """monthly AS (
  SELECT drug, year_month, CAST(SUM(items) AS BIGINT) AS total_items,
    ROUND(SUM(actual_cost), 2) AS total_cost_gbp
  FROM silver GROUP BY drug, year_month)"""

TOTALS = """totals AS (
  SELECT drug, row_id AS practice_id, CAST(SUM(items) AS BIGINT) AS total_items,
    ROUND(SUM(actual_cost), 2) AS total_cost_gbp
  FROM silver GROUP BY drug, row_id)"""

LEADERBOARD = f"""{TOTALS}, leaderboard AS (
  SELECT *, CAST(ROW_NUMBER() OVER (
    PARTITION BY drug ORDER BY total_items DESC, practice_id) AS INTEGER) AS rank
  FROM totals QUALIFY rank <= 20)"""


# a record dated by month only counts as of the month's first day
AS_OF = "COALESCE(date, TRY_CAST(year_month || '-01' AS DATE))"


def dim_cte(source: str = "silver", name: str = "dim", as_of: str = AS_OF) -> str:
    return f"""{name}_versions AS (
  SELECT row_id AS practice_id, setting, ccg, MIN({as_of}) AS first_seen, MAX({as_of}) AS last_seen
  FROM {source} GROUP BY row_id, setting, ccg),
{name} AS (
  SELECT *, valid_to IS NULL AS is_current FROM (
    SELECT practice_id, setting, ccg, first_seen AS valid_from,
      LEAD(first_seen) OVER w AS valid_to,
      CAST(ROW_NUMBER() OVER w AS INTEGER) AS version_num
    FROM {name}_versions
    WINDOW w AS (PARTITION BY practice_id ORDER BY first_seen, setting, ccg)))"""


DIM = f"{SILVER}, {dim_cte()}"
# dates as the source gives them, so records known by month only have none
DIM_DAYS_ONLY = f"{SILVER}, {dim_cte(as_of='date')}"


def stop_list() -> str:
    from doseledger.functions.text import STOP_WORDS

    return ", ".join(f"'{w}'" for w in STOP_WORDS)


def tokens_sql(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '[a-z]{{4,}}'), "
        f"lambda w: w NOT IN ({stop_list()}))"
    )


TERMS = f"""terms AS (
  SELECT drug, term, page_type, COUNT(*) AS frequency FROM (
    SELECT lang AS drug, source AS page_type,
      unnest({tokens_sql("source || ' ' || text || ' ' || lang || ' ' || source")}) AS term
    FROM documents)
  GROUP BY drug, term, page_type)"""

TOP_TERMS = f"""{TERMS}, top_terms AS (
  SELECT * FROM terms QUALIFY ROW_NUMBER() OVER (
    PARTITION BY drug ORDER BY frequency DESC, term, page_type) <= 20)"""

EVENTS = """events_log AS (
  SELECT 'START' AS event_type, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_time, o.*
    FROM orders o
  UNION ALL
  SELECT CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' ELSE 'FAIL' END,
    strftime(o_orderdate + to_seconds(o_custkey % 3600), '%Y-%m-%d %H:%M:%S'), o.*
    FROM orders o WHERE o_orderstatus IN ('F', 'P')),
edges AS (
  SELECT DISTINCT
    'layer' || (o_orderkey % 5) || '.' || (o_custkey % 7) AS input,
    o_orderpriority AS job_name,
    'layer' || (o_orderkey % 5 + 1) || '.' || (o_custkey % 3) AS output
  FROM events_log WHERE event_type = 'COMPLETE' AND o_custkey % 11 <> 0)"""

RECORD_CHECK = f"""checked AS (
  SELECT * EXCLUDE (k, f, yr, cost, whole),
    CASE WHEN f % 59 = 0 THEN 'not a JSON object' ELSE concat_ws('; ',
      CASE WHEN f % 23 = 0 THEN 'actual_cost: not a number' END,
      CASE WHEN f % 19 = 0 THEN 'items: not a whole number' END,
      CASE WHEN k % 13 <> 0 AND (f % 17 = 0 OR f % 61 = 0) THEN 'setting: not text' END,
      CASE WHEN f % 31 = 0 THEN 'drug: text required' END) END AS reasons,
    CASE WHEN f % 23 <> 0 THEN CASE WHEN k % 29 = 0 THEN COALESCE(cost, 1) ELSE cost END END AS actual_cost,
    whole AS items,
    CASE WHEN k % 13 = 0 THEN '' ELSE '4' END AS setting
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date, row_id, ccg, drug AS batch_drug,
      resource AS batch_resource, quantity, l_orderkey AS k, CASE WHEN resource < 'EPD_1998' THEN l_orderkey ELSE 1 END AS f, substr(resource, 5, 4) AS yr,
      CASE WHEN l_orderkey % 37 <> 0 THEN actual_cost END AS cost, items AS whole
    FROM bronze))"""


def html_sections_sql(html: str) -> str:
    """Sections of ``pages``, by walking the tags of each page with a stack in a recursive query.

    Decodes the entities that occur in the supplied pages.
    """
    tag = r"""<(/?[a-zA-Z][^\s/>]*)(?:[^"''>]|"[^"]*"|''[^'']*'')*>"""
    raw = (
        r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>|![^>]*>)"
    )
    text = "t"
    for pattern, plain in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{pattern}', '{plain}', 'g')"
    void = "'area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'wbr'"
    return rf"""WITH RECURSIVE tokens AS (
  SELECT page_id, url, regexp_extract_all(clean, '{tag}') AS tags,
    list_transform(string_split_regex(clean, '{tag}'),
      lambda t: regexp_replace({text}, '^\s+|\s+$', '', 'g')) AS texts
  FROM (SELECT page_id, url, regexp_replace({html}, '{raw}', '<br>', 'g') AS clean FROM pages)),
marks AS (
  SELECT page_id, list_append(list_transform(
      list_transform(tags, lambda t: lower(regexp_extract(t, '^<(/?[^\s/>]+)', 1))),
      lambda n: CASE WHEN n IN ({void}) THEN '' ELSE n END), '/*') AS marks FROM tokens),
walk(page_id, i, marks, names, firsts, parents, done) AS (
  SELECT page_id, 0, marks, []::VARCHAR[], []::INTEGER[], []::INTEGER[],
    []::STRUCT(name VARCHAR, first INTEGER, last INTEGER, parent INTEGER)[] FROM marks
  UNION ALL
  SELECT page_id, i + 1, marks,
    CASE WHEN m = '' OR k = 0 THEN names WHEN k > 0 THEN names[:k - 1] ELSE list_append(names, m) END,
    CASE WHEN m = '' OR k = 0 THEN firsts WHEN k > 0 THEN firsts[:k - 1] ELSE list_append(firsts, i) END,
    CASE WHEN m = '' OR k = 0 THEN parents WHEN k > 0 THEN parents[:k - 1]
         ELSE list_append(parents, COALESCE(firsts[len(firsts)], -1)) END,
    CASE WHEN m <> '' AND k > 0 THEN list_concat(done, list_transform(range(k, len(names) + 1),
        lambda j: {{'name': names[j], 'first': firsts[j], 'last': i, 'parent': parents[j]}})) ELSE done END
  FROM (SELECT *, CASE WHEN m = '/*' THEN 1 WHEN NOT starts_with(m, '/') THEN -1
      WHEN NOT list_contains(names, m[2:]) THEN 0
      ELSE len(names) - list_position(list_reverse(names), m[2:]) + 1 END AS k
    FROM (SELECT *, marks[i + 1] AS m FROM walk WHERE i < len(marks)))),
elements AS (
  SELECT page_id, unnest(done, recursive := true) FROM walk WHERE i = len(marks)),
main AS (SELECT page_id, arg_min(first, first) AS first, arg_min(last, first) AS last
  FROM elements WHERE name = 'main' GROUP BY page_id),
inside AS (
  SELECT e.*, array_to_string(list_filter(t.texts[e.first + 2:e.last + 1], lambda x: x <> ''), ' ') AS text
  FROM elements e JOIN tokens t USING (page_id) LEFT JOIN main m USING (page_id)
  WHERE m.page_id IS NULL OR (e.first > m.first AND e.first < m.last)),
heads AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY first) - 1 AS pos,
    COALESCE(LEAD(first) OVER (PARTITION BY page_id, parent ORDER BY first), 2147483647) AS until
  FROM inside WHERE name IN ('h2', 'h3')),
paragraphs AS (
  SELECT h.page_id, h.pos, string_agg(p.text, ' ' ORDER BY p.first) AS text
  FROM heads h JOIN inside p ON p.page_id = h.page_id AND p.name = 'p' AND p.parent = h.parent
    AND p.first > h.first AND p.first < h.until GROUP BY ALL),
bullets AS (
  SELECT page_id, pos, string_agg(text, '|' ORDER BY first) AS bullets FROM (
    SELECT DISTINCT h.page_id, h.pos, i.first, i.text
    FROM heads h JOIN inside u ON u.page_id = h.page_id AND u.name IN ('ul', 'ol') AND u.parent = h.parent
        AND u.first > h.first AND u.first < h.until
      JOIN inside i ON i.page_id = u.page_id AND i.name = 'li' AND i.first > u.first AND i.first < u.last)
  GROUP BY ALL),
sections AS (
  SELECT page_id, pos, h.text AS heading, p.text, b.bullets
  FROM heads h LEFT JOIN paragraphs p USING (page_id, pos) LEFT JOIN bullets b USING (page_id, pos)
  UNION ALL
  SELECT page_id, 0, '', string_agg(i.text, ' ' ORDER BY i.first) FILTER (WHERE i.name = 'p'),
    string_agg(i.text, '|' ORDER BY i.first) FILTER (WHERE i.name = 'li')
  FROM tokens LEFT JOIN inside i USING (page_id)
  WHERE page_id NOT IN (SELECT page_id FROM heads) GROUP BY page_id)
SELECT page_id, url, CASE WHEN contains(slug, 'side-effects') THEN 'side_effects'
    WHEN contains(slug, 'who-can') THEN 'contraindications' ELSE 'interactions' END AS page_type,
  CAST(pos AS INTEGER) AS pos, heading, COALESCE(text, '') AS text, COALESCE(bullets, '') AS bullets
FROM sections JOIN (SELECT page_id, url, split_part(rtrim(url, '/'), '/', -1) AS slug FROM tokens) USING (page_id)"""
