"""SQL twins of the registered queries, for an engine other than Spark.

They are written from the meaning of the rows rather than from the Spark code: an event
time is taken from the timestamp column instead of being parsed back from text, and an
amount from the numeric column instead of from its spelling.
"""

from __future__ import annotations

_WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '"
    "||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)"
    "||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)"
    "||chr(8239)||chr(8287)||chr(12288)"
)
_NULLS = "('', 'na', 'n/a', 'none', 'null', 'nil', '-', '--', '—')"


def iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN '' "
        f"ELSE '.' || strftime({ts}, '%f') END || '+00:00'"
    )


def _hash(source_id: str, ts: str, category: str, value: str) -> str:
    return (
        f"sha256('{{\"category\":\"' || {category} || '\",\"event_time\":\"' || {iso(ts)} || "
        f"'\",\"source_id\":\"' || {source_id} || '\",\"value\":\"' || "
        f"replace({value}, '€', '\\u20ac') || '\"}}')"
    )


_VALUE = """CASE event_id % 20 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN 'abc'
  WHEN 3 THEN '-' || v WHEN 4 THEN '$' || v WHEN 5 THEN ' ' || v || ' '
  WHEN 6 THEN '€1.234,' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')
  WHEN 7 THEN '--' WHEN 8 THEN '1e7' WHEN 9 THEN 'nan' ELSE v END"""
_CATEGORY = """CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
  WHEN 2 THEN ' ' || event_type || ' ' WHEN 3 THEN chr(9) || event_type
  ELSE CASE WHEN event_id % 25 = 24 THEN 'N/A' ELSE event_type END END"""
# What the value means as money and as a float; NULL where it means nothing.
_MONEY = """CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
  WHEN 3 THEN -d WHEN 6 THEN 1234 + (event_id % 100) / 100.0 WHEN 7 THEN NULL
  WHEN 8 THEN 17 WHEN 9 THEN NULL ELSE d END"""
_NUMBER = """CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
  WHEN 3 THEN -value WHEN 4 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL
  WHEN 8 THEN 1e7 WHEN 9 THEN CAST('nan' AS DOUBLE) ELSE value END"""

BATCH = f"""
ev AS (SELECT *, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v,
  CAST(value AS DECIMAL(18,2)) AS d FROM events),
spelled AS (SELECT event_id, event_type, event_id + 1 AS row_num,
  CAST(user_id AS VARCHAR) AS source_id, ts, {_CATEGORY} AS category_raw, {_VALUE} AS value_raw,
  CAST({_MONEY} AS DECIMAL(18,4)) AS money, {_NUMBER} AS number FROM ev),
batch AS (
  SELECT 1 AS file_ord, row_num, 'events' AS source, source_id, ts, category_raw, value_raw,
    money, number FROM spelled
  UNION ALL
  SELECT 2, o_orderkey + 1, 'orders', CAST(o_custkey AS VARCHAR), o_orderdate, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(o_totalprice AS DECIMAL(18,4)),
    o_totalprice FROM orders
  UNION ALL
  SELECT 3, row_num, 'events', source_id, ts, upper(category_raw), '  ' || value_raw || ' ',
    money, number FROM spelled WHERE event_type = 'purchase'
  UNION ALL
  SELECT 4, row_num, 'mirror', source_id, ts, category_raw, value_raw, money, number
  FROM spelled WHERE event_type = 'signup'
),
keyed0 AS (SELECT *, source || '-' || file_ord || '-' || row_num AS id,
  lower(trim(category_raw, {_WS})) AS category, trim(value_raw, {_WS}) AS value FROM batch),
keyed AS (SELECT *, {_hash('source_id', 'ts', 'category', 'value')} AS record_hash FROM keyed0)
"""


def _bronze(name: str, files: str) -> str:
    return f"""{name} AS (SELECT * FROM keyed WHERE file_ord IN ({files})
  QUALIFY row_number() OVER (PARTITION BY source, record_hash ORDER BY file_ord, row_num) = 1)"""


def _silver(name: str, bronze: str) -> str:
    return f"""{name} AS (SELECT *,
  CASE WHEN lower(trim(category_raw, {_WS})) IN {_NULLS} THEN category
    ELSE trim(category_raw, {_WS}) END AS silver_category,
  CASE WHEN lower(trim(value_raw, {_WS})) IN {_NULLS} THEN NULL ELSE value_raw END AS value_text
  FROM {bronze})"""


BRONZE = _bronze("bronze", "1,2,3,4")
SILVER = _silver("silver", "bronze")


def _rollup(table: str, name: str, unit: str, record: str, category: str, where: str = "") -> str:
    return f"""SELECT CAST(date_trunc('{unit}', ts) AS DATE) AS {name},
  count(*) AS total_records, count(DISTINCT {record}) AS distinct_records,
  count(DISTINCT source_id) AS distinct_source_ids, count(DISTINCT source) AS distinct_sources,
  count(DISTINCT {category}) AS distinct_categories FROM {table} {where} GROUP BY 1"""


_MONTHLY = _rollup("silver", "month_start", "month", "record_hash", "silver_category")
_DAILY = _rollup("bronze", "day_date", "day", "source || record_hash", "category")
_SILVER_WITH = f"WITH {BATCH}, {BRONZE}, {SILVER}"
_BRONZE_WITH = f"WITH {BATCH}, {BRONZE}"
_TREND_DAYS = f"""{_BRONZE_WITH}, daily AS ({_DAILY}),
days AS (SELECT * FROM daily WHERE day_date >= DATE '1997-01-15' AND day_date < DATE '2024-01-25')"""


def _trend(unit: str, metric: str) -> str:
    return f"""{_TREND_DAYS} SELECT CAST(date_trunc('{unit}', day_date) AS DATE) AS bucket_start,
  CAST(sum({metric}) AS BIGINT) AS value FROM days GROUP BY 1"""


_FLAGS = f"""WITH {BATCH},
counted AS (SELECT *, count(*) OVER (PARTITION BY source, source_id, ts, category, value) AS copies
  FROM keyed),
fired AS (SELECT *,
  value = '' OR lower(value) IN ('null', 'none', 'na', 'n/a', 'nil', '-') AS x1,
  number IS NULL AND NOT (value = '' OR lower(value) IN ('null', 'none', 'na', 'n/a', 'nil', '-'))
    AS x2,
  ts > TIMESTAMP '2024-01-20 00:05:00' AS x4, ts < TIMESTAMP '2023-12-21 00:00:00' AS x5,
  coalesce(NOT isnan(number) AND number <= 0, false) AS x6a,
  coalesce(NOT isnan(number) AND number > 1000000, false) AS x6b,
  copies > 1 AS x7 FROM counted),
flagged AS (SELECT *,
  least(100, 40 * x1::INT + 40 * x2::INT + 25 * x4::INT + 15 * x5::INT
    + 35 * (x6a OR x6b)::INT + 30 * x7::INT) AS severity,
  concat_ws('|', CASE WHEN x1 THEN 'VALUE_EMPTY_OR_NULLISH' END,
    CASE WHEN x2 THEN 'VALUE_NOT_NUMERIC' END, CASE WHEN x4 THEN 'FUTURE_EVENT_TIME' END,
    CASE WHEN x5 THEN 'STALE_EVENT_TIME' END, CASE WHEN x6a OR x6b THEN 'VALUE_OUT_OF_RANGE' END,
    CASE WHEN x7 THEN 'POSSIBLE_DUPLICATE_FINGERPRINT' END) AS flag_codes,
  concat_ws(' || ',
    CASE WHEN x1 THEN 'VALUE_EMPTY_OR_NULLISH: value=''' || value || ''' is empty or null-ish' END,
    CASE WHEN x2 THEN 'VALUE_NOT_NUMERIC: value=''' || value
      || ''' cannot be parsed as float' END,
    CASE WHEN x4 THEN 'FUTURE_EVENT_TIME: event_time=' || {iso('ts')}
      || ' is in the future vs now=2024-01-20T00:00:00+00:00' END,
    CASE WHEN x5 THEN 'STALE_EVENT_TIME: event_time=' || strftime(ts, '%Y-%m-%d')
      || ' is older than 30 days' END,
    CASE WHEN x6a THEN 'VALUE_OUT_OF_RANGE: value=' || CAST(number AS VARCHAR) || ' must be > 0'
      WHEN x6b THEN 'VALUE_OUT_OF_RANGE: value=' || CAST(number AS VARCHAR)
      || ' exceeds 1,000,000' END,
    CASE WHEN x7 THEN 'POSSIBLE_DUPLICATE_FINGERPRINT: Fingerprint appears ' || copies
      || ' times in this batch' END) AS flag_messages
  FROM fired WHERE x1 OR x2 OR x4 OR x5 OR x6a OR x6b OR x7)"""

_JSON_TEXT = """array_to_string(list_transform(string_split(text, ''), lambda c:
  CASE WHEN c = '"' THEN chr(92) || '"' WHEN c = chr(92) THEN chr(92) || chr(92)
    WHEN unicode(c) BETWEEN 32 AND 126 THEN c
    WHEN c = chr(10) THEN chr(92) || 'n' WHEN c = chr(13) THEN chr(92) || 'r'
    WHEN c = chr(9) THEN chr(92) || 't' WHEN c = chr(8) THEN chr(92) || 'b'
    WHEN c = chr(12) THEN chr(92) || 'f'
    WHEN unicode(c) > 65535 THEN
      chr(92) || 'u' || format('{:04x}', 55296 + ((unicode(c) - 65536) // 1024))
      || chr(92) || 'u' || format('{:04x}', 56320 + ((unicode(c) - 65536) % 1024))
    ELSE chr(92) || 'u' || format('{:04x}', unicode(c)) END), '')"""

_LINES = """WITH li AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)"""
_FLOAT_CASE = """CASE l_linenumber % 6 WHEN {grouped} WHEN 1 THEN -CAST(p AS DOUBLE)
  WHEN 2 THEN CAST(CAST(p AS VARCHAR) || 'e2' AS DOUBLE) WHEN 3 THEN NULL
  WHEN 4 THEN 1000 + CAST(l_quantity AS INT) ELSE NULL END"""
_GROUPED_OK = "0 THEN CAST(p AS DOUBLE)"
_GROUPED_STRICT = "0 THEN CASE WHEN p < 1000 THEN CAST(p AS DOUBLE) END"

_RUNS = """WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, min(ts) AS started_at,
  max(ts) AS finished_at, count(*) AS records_in,
  count(*) FILTER (value > 50) AS records_out FROM events GROUP BY 1, 2),
runs AS (SELECT *, CAST(day AS VARCHAR) || '|' || event_type AS id,
  CASE event_type WHEN 'click' THEN 'ingest' WHEN 'view' THEN 'flags' WHEN 'signup' THEN 'clean'
    WHEN 'purchase' THEN 'metrics' ELSE 'demo' END AS pipeline,
  CASE WHEN records_in % 5 = 0 THEN 'failed' ELSE 'succeeded' END AS status,
  (epoch_us(finished_at) - epoch_us(started_at)) // 1000 AS duration_ms,
  CASE WHEN records_in % 5 = 0 THEN 'stopped after ' || records_out END AS error_summary
  FROM daily)"""

_MESSY = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN -o_orderkey ELSE o_orderkey END
  AS views0, 'Order ' || o_orderkey AS title0,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
    WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS category0,
  CASE WHEN o_orderkey % 3 = 0 THEN 0.5::DOUBLE END AS score0 FROM orders)"""


def _field(name: str, before: str, after: str) -> str:
    return f"SELECT o_orderkey, '{name}' AS field, {before} AS before, {after} AS after FROM o"


def _date(day_first: bool) -> str:
    swapped = "dayofmonth(ts) <= 12"
    last = (
        f"CASE WHEN {swapped} THEN make_date(year(ts), dayofmonth(ts), month(ts)) END"
        if day_first
        else "CAST(ts AS DATE)"
    )
    slashed = (
        "CAST(ts AS DATE)"
        if day_first
        else f"CASE WHEN {swapped} THEN make_date(year(ts), dayofmonth(ts), month(ts)) END"
    )
    return f"""SELECT event_id, CASE event_id % 8 WHEN 1 THEN {slashed} WHEN 7 THEN {last}
  ELSE CAST(ts AS DATE) END AS day FROM events"""


ORACLE: dict[str, str] = {
    "monthly_metrics": f"{_SILVER_WITH} {_MONTHLY}",
    "daily_metrics": f"{_BRONZE_WITH} {_DAILY}",
    "monthly_metrics_raw": f"{_BRONZE_WITH} "
    + _rollup("bronze", "month_start", "month", "source || record_hash", "category"),
    "monthly_slice": f"""{_SILVER_WITH}, monthly AS ({_MONTHLY}) SELECT * FROM monthly
  WHERE month_start >= DATE '1996-03-15' AND month_start < DATE '2001-01-01'""",
    "latest_month": f"""{_SILVER_WITH}, monthly AS ({_MONTHLY}) SELECT * FROM monthly
  ORDER BY month_start DESC LIMIT 1""",
    "trend_day": _trend("day", "total_records"),
    "trend_week": _trend("week", "distinct_source_ids"),
    "trend_month": _trend("month", "distinct_records"),
    "trend_share_of_max": f"""SELECT bucket_start, value,
  CAST(CASE WHEN max(value) OVER () = 0 THEN 0
    ELSE floor(value / max(value) OVER () * 100 + 0.5) END AS BIGINT) AS share
  FROM ({_trend('month', 'total_records')})""",
    "scan_csv_contract": f"""WITH {BATCH} SELECT source_id, {iso('ts')} AS event_time, category,
  value, record_hash FROM keyed WHERE file_ord IN (1, 2)""",
    "latest_n_raw": f"""{_BRONZE_WITH} SELECT id, source, record_hash, row_num FROM bronze
  ORDER BY file_ord DESC, source, record_hash LIMIT 5000""",
    "invalid_event_time_rows": """WITH t AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN ''
  WHEN 1 THEN NULL WHEN 2 THEN 'not-a-date' WHEN 3 THEN '2024-02-30T00:00:00Z'
  WHEN 4 THEN '2024-13-01' WHEN 5 THEN '2026' WHEN 6 THEN 'T06:00'
  ELSE CAST(ts AS VARCHAR) END AS event_time FROM events)
  SELECT event_id, event_time FROM t WHERE try_cast(event_time AS TIMESTAMP) IS NULL""",
    "parse_event_time": f"WITH {BATCH} SELECT id, {iso('ts')} AS event_time FROM keyed0",
    "extract_keys": f"""WITH {BATCH} SELECT id, source_id, {iso('ts')} AS event_time, category,
  value FROM keyed0""",
    "record_hash": f"WITH {BATCH} SELECT id, record_hash FROM keyed",
    "record_hash_text": f"""SELECT doc_id, sha256('{{"category":"' || lang
  || '","event_time":"2024-01-20T00:00:00+00:00","source_id":"' || doc_id || '","value":"'
  || {_JSON_TEXT} || '"}}') AS record_hash FROM documents""",
    "ingest_counts": f"""WITH {BATCH}, placed AS (SELECT file_ord, row_number() OVER
  (PARTITION BY source, record_hash ORDER BY file_ord, row_num) AS rn FROM keyed)
  SELECT coalesce(CAST(file_ord AS VARCHAR), 'all') AS file, count(*) AS total_records,
  count(*) FILTER (rn = 1) AS inserted_records, count(*) FILTER (rn > 1) AS deduped_records
  FROM placed GROUP BY ROLLUP (file_ord)""",
    "dedupe_keep_first": f"{_BRONZE_WITH} SELECT source, record_hash, file_ord, row_num FROM bronze",
    "ingest_new_only": f"""{_BRONZE_WITH}, {_bronze('stored', '1,2')}
  SELECT source, record_hash, file_ord, row_num FROM bronze b WHERE NOT EXISTS
  (SELECT 1 FROM stored s WHERE s.source = b.source AND s.record_hash = b.record_hash)""",
    "ingest_idempotent_replay": f"""{_BRONZE_WITH} SELECT source, count(*) AS first_inserted,
  CAST(0 AS BIGINT) AS replay_inserted FROM bronze GROUP BY source""",
    "backfill_keys": f"""WITH {BATCH} SELECT id, source, source_id, {iso('ts')} AS event_time,
  category, value, record_hash FROM keyed""",
    "project_allowed_keys": """SELECT event_id, 'value' AS key,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS text FROM events
  UNION ALL SELECT event_id, 'category', event_type FROM events""",
    "null_literals": f"""WITH {BATCH} SELECT id,
  CAST(lower(value) IN {_NULLS} AS INT) AS value_is_null,
  CASE WHEN lower(value) NOT IN {_NULLS} THEN value_raw END AS value,
  CASE WHEN category NOT IN {_NULLS} THEN category_raw END AS category FROM keyed0""",
    "normalize_text": f"""WITH t AS (SELECT 'doc-' || doc_id AS id, text FROM documents
  UNION ALL SELECT 'turn-' || conv_id || '-' || turn, text FROM conversations)
  SELECT id, CASE WHEN lower(trim(text, {_WS})) IN {_NULLS} THEN NULL
    ELSE regexp_replace(trim(text, {_WS}), '[' || {_WS} || ']+', ' ', 'g') END AS text FROM t""",
    "normalize_category": f"""WITH {BATCH} SELECT id, CASE category WHEN 'click' THEN 'Click'
  WHEN 'view' THEN 'Page view' WHEN 'purchase' THEN 'Sale' WHEN 'o' THEN 'open'
  WHEN 'f' THEN 'filled' WHEN 'p' THEN 'partial' WHEN 'n/a' THEN NULL
  ELSE trim(category_raw, {_WS}) END AS category FROM keyed0""",
    "map_categories": """SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN r_name
  ELSE n_name || ' (old)' END AS category FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "normalize_date_dayfirst": _date(True),
    "normalize_date_monthfirst": _date(False),
    "normalize_currency": f"""{_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE WHEN l_linenumber % 5 = 4 THEN NULL
    WHEN l_linenumber % 5 = 1 AND p < 1000 THEN p * 100 ELSE p END AS DECIMAL(18,4)) AS amount
  FROM li""",
    "normalize_int": f"""{_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(trunc({_FLOAT_CASE.format(grouped=_GROUPED_OK)}) AS BIGINT) AS whole FROM li""",
    "normalize_float": f"""{_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {_FLOAT_CASE.format(grouped=_GROUPED_OK)} AS number FROM li""",
    "parse_value_float": f"""{_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {_FLOAT_CASE.format(grouped=_GROUPED_STRICT)} AS number FROM li""",
    "outlier_bounds": """SELECT o_orderkey,
  CASE WHEN o_totalprice BETWEEN 1000 AND 300000 THEN o_totalprice END AS both,
  CASE WHEN o_totalprice <= 300000 THEN o_totalprice END AS upper,
  CASE WHEN o_totalprice >= 1000 THEN o_totalprice END AS lower FROM orders""",
    "clean_row_e2e": f"""{_MESSY} SELECT o_orderkey, title0 AS title, category0 AS category,
  CAST(o_orderdate AS DATE) AS published_at,
  CAST(CASE WHEN o_totalprice <= 450000 THEN CAST(o_totalprice AS DECIMAL(18,2)) END
    AS DECIMAL(18,4)) AS price,
  CASE WHEN views0 >= 0 THEN views0 END AS views, score0 AS score FROM o""",
    "clean_before_after": f"{_MESSY} " + " UNION ALL ".join([
        _field("title", "'  Order ' || chr(9) || ' ' || o_orderkey || '  '", "title0"),
        _field("category", "o_orderpriority", "category0"),
        _field("published_at", "strftime(o_orderdate, '%d/%m/%Y')",
               "strftime(o_orderdate, '%Y-%m-%d')"),
        _field("views", "CAST(CASE WHEN o_orderkey = 0 THEN '-0' ELSE views0::VARCHAR END "
               "AS VARCHAR)", "CASE WHEN views0 >= 0 THEN CAST(views0 AS VARCHAR) END"),
        _field("score", "CASE o_orderkey % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1.5' "
               "ELSE 'none' END", "CAST(score0 AS VARCHAR)"),
    ]),
    "silver_upsert": f"""{_SILVER_WITH}, {_bronze('stored', '1,2')}
  SELECT sha256(CASE WHEN EXISTS (SELECT 1 FROM stored t WHERE t.source = s.source
      AND t.record_hash = s.record_hash) THEN 'first' ELSE 'second' END
    || '|' || source || '|' || record_hash) AS id,
  source, record_hash, id AS raw_id, source_id, {iso('ts')} AS event_time,
  silver_category AS category, value_text, money AS value_decimal,
  CASE WHEN category NOT IN {_NULLS} THEN silver_category END AS payload_category
  FROM silver s""",
    "gold_upsert": f"""{_BRONZE_WITH}, {_bronze('stored', '1,2')},
  old AS ({_DAILY.replace('FROM bronze', 'FROM stored')}), fresh AS ({_DAILY})
  SELECT * FROM fresh WHERE day_date >= DATE '2024-01-10'
  UNION ALL SELECT * FROM old WHERE day_date < DATE '2024-01-10'""",
    "fingerprint_counts": f"""WITH {BATCH} SELECT id, count(*) OVER
  (PARTITION BY source, source_id, ts, category, value) AS copies FROM keyed0""",
    "flags_report": f"""{_FLAGS} SELECT id, 'run-' || source AS run_id,
  CAST(row_num AS VARCHAR) AS row_num, source, source_id, category,
  replace({iso('ts')}, 'T', ' ') AS event_time, value, record_hash,
  '2024-01-' || CAST(10 + file_ord AS VARCHAR) || ' 00:00:00+00:00' AS ingested_at,
  severity, flag_codes, flag_messages FROM flagged""",
    "flags_severity": f"""{_FLAGS} SELECT severity, flag_codes, count(*) AS records FROM flagged
  GROUP BY severity, flag_codes""",
    "flags_top10": f"""{_FLAGS} SELECT severity, id, source_id, flag_codes FROM flagged
  ORDER BY severity DESC, id LIMIT 10""",
    "flag_totals": f"""{_FLAGS} SELECT (SELECT count(*) FROM batch) AS scanned,
  (SELECT count(*) FROM flagged) AS flagged""",
    "control_totals": "",
    "dq_checks": "",
    "run_rollup": f"""{_RUNS} SELECT CAST(coalesce(sum(records_in), 0) AS BIGINT) AS records_in,
  CAST(coalesce(sum(records_out), 0) AS BIGINT) AS records_out FROM runs
  WHERE pipeline IN ('ingest', 'flags') AND started_at >= TIMESTAMP '2024-01-15'""",
    "recent_runs": f"""{_RUNS} SELECT pipeline, id AS run_id, status,
  {iso('started_at')} AS started_at, {iso('finished_at')} AS finished_at, duration_ms,
  records_in, records_out, error_summary FROM (SELECT * FROM runs
  ORDER BY started_at DESC, id LIMIT 10)""",
    "failed_run_steps": f"""{_RUNS}, latest AS (SELECT * FROM runs WHERE status = 'failed'
  ORDER BY started_at DESC, id LIMIT 1)
  SELECT id AS run_id, 'ValueError' AS error_type, error_summary AS error_message,
    0 AS position, 'parse' AS step, 'ok' AS status, records_in AS duration_ms FROM latest
  UNION ALL SELECT id, 'ValueError', error_summary, 1, 'upsert', 'failed', records_out
  FROM latest""",
}

_TOTALS = f"""{_SILVER_WITH}, {_bronze('stored', '1,2')},
summary AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, count(*) AS n
  FROM stored GROUP BY 1),
recount AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, count(*) AS n
  FROM silver GROUP BY 1),
totals AS (SELECT coalesce(s.month_start, r.month_start) AS month_start,
  coalesce(s.n, 0) AS summary_count, coalesce(r.n, 0) AS clean_count,
  coalesce(s.n, 0) - coalesce(r.n, 0) AS diff
  FROM summary s FULL OUTER JOIN recount r ON s.month_start = r.month_start)"""
ORACLE["control_totals"] = f"{_TOTALS} SELECT * FROM totals"
ORACLE["dq_checks"] = f"""{_TOTALS} SELECT 'control_totals' AS check_name,
  'monthly_metrics' AS check_scope, month_start,
  CASE WHEN diff = 0 THEN 'pass' ELSE 'fail' END AS status,
  clean_count AS expected, summary_count AS observed,
  '{{"diff":' || diff || '}}' AS details FROM totals"""


def flags_over(table: str) -> str:
    """The flag rules over another table of the batch's columns."""
    return _FLAGS.replace("FROM keyed)", f"FROM {table})", 1)


# An order's time as its file spells it.
ORDER_TEXT = """CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END"""


def text_time_flags() -> str:
    """The flag rules where some times can't be read: one more rule, and none about those times."""
    texted = f"""{BRONZE},
texted AS (SELECT * REPLACE (CASE WHEN left(record_hash, 1) >= '5' THEN ts END AS ts),
  CASE WHEN left(record_hash, 1) < '3' THEN 'soon' WHEN left(record_hash, 1) >= '5' THEN CAST(ts AS VARCHAR) END AS spelled_time
  FROM bronze),
counted AS"""
    sql = flags_over("texted").replace("counted AS", texted, 1)
    for old, new in (
        ("source_id, ts, category, value) AS copies", "source_id, spelled_time, category, value) AS copies"),
        ("ts > TIMESTAMP '2024-01-20 00:05:00' AS x4", "coalesce(ts > TIMESTAMP '2024-01-20 00:05:00', false) AS x4"),
        ("ts < TIMESTAMP '2023-12-21 00:00:00' AS x5", "coalesce(ts < TIMESTAMP '2023-12-21 00:00:00', false) AS x5"),
        ("copies > 1 AS x7", "copies > 1 AS x7, ts IS NULL AS x3"),
        ("40 * x2::INT", "40 * x2::INT + 40 * x3::INT"),
        ("CASE WHEN x4 THEN 'FUTURE_EVENT_TIME' END", "CASE WHEN x3 THEN 'EVENT_TIME_INVALID' END, CASE WHEN x4 THEN 'FUTURE_EVENT_TIME' END"),
        ("WHERE x1 OR x2", "WHERE x1 OR x2 OR x3"),
    ):
        assert old in sql, old
        sql = sql.replace(old, new, 1)
    return sql


def job_twins() -> dict[str, str]:
    """Twins of the queries that run whole jobs; stored keys are unique, so no fingerprint repeats."""
    flags_sql = flags_over("bronze").replace("counted AS", f"{BRONZE},\ncounted AS", 1)
    text_times = text_time_flags()
    by_month = _rollup("bronze", "month_start", "month", "source || record_hash", "category")
    gold = f"""{_SILVER_WITH}, m AS ({_MONTHLY}), d AS ({_DAILY}), b AS ({by_month})
  SELECT 'monthly_metrics' AS table_name, month_start AS day, * EXCLUDE (month_start) FROM m
  UNION ALL SELECT 'daily_metrics', day_date, * EXCLUDE (day_date) FROM d
  UNION ALL SELECT 'monthly_metrics_raw', month_start, * EXCLUDE (month_start) FROM b
  UNION ALL SELECT 'failed_checks', NULL, 0, 0, 0, 0, 0"""
    return {
        "job_ingest_bronze": f"""{_BRONZE_WITH} SELECT source, record_hash, source_id, {iso('ts')} AS event_time,
  category, value FROM bronze""",
        "job_silver_refresh": f"""{_SILVER_WITH} SELECT source, record_hash, source_id, {iso('ts')} AS event_time,
  silver_category AS category, value_text, money AS value_decimal FROM silver""",
        "job_gold_tables": gold,
        "job_gold_increments": gold,
        "job_row_numbers": f"""WITH {BATCH}, {_bronze('stored', '2')}
  SELECT source, count(*) AS stored, count(*) AS numbered, count(*) AS notes FROM stored GROUP BY source""",
        "job_ledger": f"""WITH {BATCH}, {_bronze('stored', '2')}, n AS (
  SELECT (SELECT count(*) FROM batch WHERE file_ord = 2) AS rows_in, (SELECT count(*) FROM stored) AS kept,
    (SELECT count(*) FROM stored WHERE ts < TIMESTAMP '2023-12-21 00:00:00' OR number <= 0 OR number > 1000000) AS bad)
  SELECT 'ingest' AS pipeline, 'succeeded' AS status, rows_in AS records_in, kept AS records_out, NULL AS error_type,
    NULL AS error_message, 'open,parse,upsert,file' AS steps FROM n
  UNION ALL SELECT 'flags', 'succeeded', kept, bad, NULL, NULL, 'fetch_raw_records,flag_records,write_flag_report_csv' FROM n
  UNION ALL SELECT 'demo', 'succeeded', rows_in + kept, kept + bad, NULL, NULL, 'ingest_samples,flags' FROM n
  UNION ALL SELECT 'clean', 'succeeded', kept, kept, NULL, NULL, 'losses,fetch_raw_records,upsert_clean_records' FROM n
  UNION ALL SELECT 'ingest', 'failed', NULL, NULL, 'IngestionError', 'Missing required columns: [''category'']', 'open'""",
        "contract_summary": f"""WITH {BATCH}, o AS (SELECT * FROM batch WHERE file_ord = 2)
  SELECT 'no_time' AS source, 'event_time is required (' || count(*) || ' rows have none)' AS message FROM o WHERE row_num % 10 = 0
  UNION ALL SELECT 'odd_time', 'Invalid event_time format: ''' || min('on ' || {ORDER_TEXT}) || ''' (' || count(*) || ' rows in all)'
    FROM orders WHERE (o_orderkey + 1) % 4 = 0
  UNION ALL SELECT 'long_id', 'source_id exceeds 100 characters in ' || count(*) || ' rows' FROM o WHERE row_num % 5 = 0
  UNION ALL SELECT 'long_category', 'category exceeds 100 characters in ' || count(*) || ' rows' FROM o WHERE row_num % 3 = 0
  UNION ALL SELECT 'stored', '0'""",
        "job_rows_set_aside": f"""WITH {BATCH}, o AS (SELECT * FROM keyed WHERE file_ord = 2), parts AS (
  SELECT 'no_time' AS batch, 10 AS k, 'event_time is required' AS reason
  UNION ALL SELECT 'odd_time', 4, 'Invalid event_time format: ''...'''
  UNION ALL SELECT 'long_id', 5, 'source_id exceeds 100 characters'
  UNION ALL SELECT 'long_category', 3, 'category exceeds 100 characters')
  SELECT batch, reason AS outcome, count(*) AS records FROM o, parts WHERE row_num % k = 0 GROUP BY batch, reason
  UNION ALL SELECT batch, 'stored', count(DISTINCT record_hash) FROM o, parts WHERE row_num % k <> 0 GROUP BY batch""",
        "stream_ingest": f"""WITH {BATCH}, {_bronze('stored', '1,3')} SELECT record_hash, source_id, category, value FROM stored""",
        "scan_workbook": """WITH o AS (SELECT *, o_orderkey % 7 AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
  SELECT CAST(o_custkey AS VARCHAR) AS source_id,
    CASE k WHEN 0 THEN '1e+16' WHEN 1 THEN '1.5e-05' WHEN 2 THEN ' $1,234.50 ' WHEN 3 THEN '1e+16' WHEN 4 THEN CAST(o_custkey AS VARCHAR)
      ELSE CAST(price AS VARCHAR) || '25' END AS value,
    k NOT IN (2, 3) AS is_number,
    CAST(CASE k WHEN 0 THEN 10000000000000000 WHEN 1 THEN 0.000015 WHEN 2 THEN 1234.5 WHEN 3 THEN 116
      WHEN 4 THEN o_custkey ELSE price + 0.0025 END AS DECIMAL(38,10)) AS amount FROM o""",
        "flags_text_times": f"{text_times} SELECT source, record_hash, severity, flag_codes FROM flagged",
        "job_flag_report_csv": f"""{flags_sql} SELECT source, source_id, record_hash,
  CAST(severity AS VARCHAR) AS severity, flag_codes, flag_messages FROM flagged""",
    }
