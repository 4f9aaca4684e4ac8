"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark operators: the split uses the literal
anti-join formulation (duplicate sets, ``NOT EXISTS``, and "rejected = rows
whose row_id is not among the valid ones"), distinct counts use
``count(DISTINCT ...)``, and the audit uses one aggregate per rule.
"""

from __future__ import annotations

from strata.contracts import (
    ALLOWED_SHIP_MODES,
    AUDIT_REQUIRED,
    AUDIT_UNIQUE,
    RULE_CHRONOLOGY,
    RULE_DATE_VALID,
    RULE_MODE_ALLOWED,
    RULE_NOT_NULL,
    RULE_UNIQUE,
    SHIP_MODE_CANONICAL,
    STATUS_FAIL,
    STATUS_PASS,
)
from strata.queries.fixed import (
    BRONZE_ROOT,
    BRONZE_TAG,
    GOLD_CUSTOMER_ROOT,
    GOLD_CUSTOMER_TAG,
    GOLD_SALES_ROOT,
    GOLD_SALES_TAG,
    RUN_TS,
    SILVER_ROOT,
    SILVER_TAG,
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def initcap(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE array_to_string(list_transform(string_split(lower({c}), ' '), "
        f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') END"
    )


def parts(date_expr: str) -> str:
    return (
        f"CAST(year({date_expr}) AS INTEGER) AS order_date_year, "
        f"CAST(month({date_expr}) AS INTEGER) AS order_date_month, "
        f"CAST(day({date_expr}) AS INTEGER) AS order_date_day"
    )


def mode_case(c: str) -> str:
    whens = " ".join(f"WHEN lower({c}) = {q(k)} THEN {q(v)}" for k, v in SHIP_MODE_CANONICAL.items())
    return f"CASE {whens} ELSE {c} END"


ALLOWED_SQL = ", ".join(q(m) for m in ALLOWED_SHIP_MODES)
RAW_COLS = "row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, country, city"

BASE = f"""
fs AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey),
geo AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
cust AS (SELECT c_custkey, c_name, c_mktsegment, n_name, r_name
         FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey),
src AS (SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS od, o.o_orderpriority AS prio,
               fs.first_ship, cust.*
        FROM orders o LEFT JOIN fs ON o.o_orderkey = fs.l_orderkey
                      LEFT JOIN cust ON o.o_custkey = cust.c_custkey),
raw AS (SELECT
    CASE WHEN k % 211 = 1 THEN k - 1 ELSE k END AS row_id,
    'ORD-' || CAST(CASE WHEN k % 223 = 1 THEN k - 1 ELSE k END AS VARCHAR) AS order_id,
    CASE WHEN k % 127 = 0 THEN 'bad-date' ELSE strftime(od, '%Y-%m-%d') END AS order_date,
    CASE WHEN k % 131 = 0 THEN 'bad-date'
         WHEN k % 3 = 0 THEN strftime(CAST(first_ship AS DATE), '%Y-%m-%d')
         ELSE strftime(od + CAST(k % 7 AS INTEGER), '%Y-%m-%d') END AS ship_date,
    CASE WHEN prio = '1-URGENT' THEN 'same day'
         WHEN prio = '2-HIGH' THEN '  First   Class '
         WHEN prio = '3-MEDIUM' THEN 'SECOND CLASS'
         WHEN prio = '5-LOW' THEN 'Standard Class'
         WHEN k % 5 = 0 THEN 'Express'
         ELSE 'standard class' END AS ship_mode,
    CASE WHEN k % 137 = 0 THEN '' ELSE 'C-' || CAST(c_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN k % 139 = 0 THEN '   ' ELSE replace(lower(c_name), '#', '   ') END AS customer_name,
    lower(c_mktsegment) AS segment,
    lower(n_name) AS country,
    ' ' || r_name || '  city ' AS city
  FROM src),
bronze AS (SELECT {RAW_COLS}, {q(BRONZE_TAG)} AS file_path, {q(RUN_TS)} AS execution_datetime,
                  {parts("TRY_CAST(order_date AS DATE)")} FROM raw),
std0 AS (SELECT row_id,
    {clean("order_id")} AS order_id,
    TRY_CAST({clean("order_date")} AS DATE) AS order_date,
    TRY_CAST({clean("ship_date")} AS DATE) AS shipment_date,
    {mode_case(clean("ship_mode"))} AS shipment_mode,
    {clean("customer_id")} AS customer_id,
    {initcap(clean("customer_name"))} AS customer_name,
    upper({clean("segment")}) AS segment,
    upper({clean("country")}) AS country,
    {clean("city")} AS city,
    {clean("file_path")} AS file_path,
    {clean("execution_datetime")} AS execution_datetime,
    order_date AS order_date_text, ship_date AS shipment_date_text
  FROM bronze),
texts AS (SELECT *, {parts("std0.order_date")} FROM std0),
std AS (SELECT * EXCLUDE (order_date_text, shipment_date_text) FROM texts),
dup_row AS (SELECT row_id FROM std GROUP BY row_id HAVING count(*) > 1),
dup_ord AS (SELECT order_id FROM std GROUP BY order_id HAVING count(*) > 1),
valid AS (SELECT * FROM std s
  WHERE NOT EXISTS (SELECT 1 FROM dup_row d WHERE d.row_id = s.row_id)
    AND NOT EXISTS (SELECT 1 FROM dup_ord d WHERE d.order_id = s.order_id)
    AND s.row_id IS NOT NULL AND s.order_id IS NOT NULL AND s.customer_id IS NOT NULL
    AND s.customer_name IS NOT NULL AND s.country IS NOT NULL AND s.segment IS NOT NULL
    AND s.city IS NOT NULL AND s.order_date IS NOT NULL AND s.shipment_date IS NOT NULL
    AND s.shipment_date >= s.order_date
    AND s.shipment_mode IN ({ALLOWED_SQL})),
rejected AS (SELECT * FROM std s WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.row_id = s.row_id)),
latest AS (SELECT max(order_date) AS latest_day FROM valid),
starts AS (SELECT latest_day,
    CAST(latest_day - 30 AS DATE) AS orders_last_month_start,
    CAST(date_trunc('month', latest_day) - INTERVAL 5 MONTH AS DATE) AS orders_last_6_months_start,
    CAST(date_trunc('month', latest_day) - INTERVAL 11 MONTH AS DATE) AS orders_last_12_months_start
  FROM latest),
named AS (SELECT v.*, string_split(customer_name, ' ')[1] AS customer_first_name,
                 string_split(customer_name, ' ')[-1] AS customer_last_name FROM valid v),
summary AS (SELECT customer_id, customer_first_name, customer_last_name, segment AS customer_segment, country,
    count(DISTINCT CASE WHEN order_date >= orders_last_month_start THEN order_id END) AS orders_last_month,
    count(DISTINCT CASE WHEN order_date >= orders_last_6_months_start AND order_date <= latest_day
                        THEN order_id END) AS orders_last_6_months,
    count(DISTINCT CASE WHEN order_date >= orders_last_12_months_start AND order_date <= latest_day
                        THEN order_id END) AS orders_last_12_months,
    count(DISTINCT order_id) AS total_orders,
    {parts("any_value(latest_day)")}
  FROM named, starts
  GROUP BY customer_id, customer_first_name, customer_last_name, segment, country)
"""


def with_base(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body.strip()}"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def audit_rules(layer: str) -> list[tuple[str, str, str]]:
    """(rule name, failure-count SQL, description) in report order."""

    def text(fixed: tuple[str, str], column: str = "") -> tuple[str, str]:
        return fixed[0].format(c=column), fixed[1].format(c=column)

    def rule(fixed, sql, column=""):
        name, desc = text(fixed, column)
        return name, sql, desc

    rules = [rule(RULE_NOT_NULL, f"count(*) FILTER (WHERE {blank(c)})", c) for c in AUDIT_REQUIRED]
    rules += [rule(RULE_UNIQUE, f"count({c}) - count(DISTINCT {c})", c) for c in AUDIT_UNIQUE]
    second = "ship_date" if layer == "bronze" else "shipment_date"
    rules += [rule(RULE_DATE_VALID, f"count(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NULL)", c)
              for c in ("order_date", second)]
    if layer == "silver":
        rules.append(rule(RULE_CHRONOLOGY, "count(*) FILTER (WHERE shipment_date < order_date)"))
        rules.append(rule(RULE_MODE_ALLOWED,
                          f"count(*) FILTER (WHERE shipment_mode IS NULL OR shipment_mode NOT IN ({ALLOWED_SQL}))"))
    return rules


def failures_sql(layer: str, source: str, keep=lambda name: True) -> str:
    """``(rule_name, checked_records, failed_records, rule_description)`` rows."""
    rules = [r for r in audit_rules(layer) if keep(r[0])]
    metrics = ", ".join(f"CAST({expr} AS BIGINT) AS m{i}" for i, (_, expr, _) in enumerate(rules))
    selects = " UNION ALL ".join(
        f"SELECT {q(name)} AS rule_name, checked_records, m{i} AS failed_records, {q(desc)} AS rule_description FROM m"
        for i, (name, _, desc) in enumerate(rules)
    )
    return f"(WITH m AS (SELECT CAST(count(*) AS BIGINT) AS checked_records, {metrics} FROM {source}) {selects})"


def report_sql(layer: str, source: str, file_path: str) -> str:
    return (
        f"SELECT {q(layer)} AS layer, rule_name, "
        f"CASE WHEN failed_records = 0 THEN {q(STATUS_PASS)} ELSE {q(STATUS_FAIL)} END AS status, "
        f"checked_records, failed_records, rule_description, {q(file_path)} AS file_path, "
        f"{q(RUN_TS)} AS execution_datetime FROM {failures_sql(layer, source)} f"
    )


def rule_rows(layer: str, source: str, keep) -> str:
    return f"SELECT rule_name, checked_records, failed_records FROM {failures_sql(layer, source, keep)} f"


# A CSV round trip reads every empty field back as null.
CSV_COLS = "row_id, " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLS.split(", ")[1:])

KEYS_AND = "customer_id, customer_first_name, customer_last_name, customer_segment, country"

SILVER_SELECT = ("row_id, order_id, order_date, shipment_date, shipment_mode, customer_id, customer_name, segment, "
                 "country, city, file_path, execution_datetime, order_date_year, order_date_month, order_date_day")

# Odd date texts, one form an order (the forms' order is part of the key).
DATE_FORMS = """[iso, y, y || '-' || m, y || '-' || m || '-' || d, '  ' || iso || chr(9), iso || ' 10:30', iso || 'T10:30:00Z',
  iso || ' any text', iso || 'x', '+' || iso, '-' || iso, '00' || iso, '0' || iso || ' ', '0000' || y || '-01-01',
  substr(iso, 2, 9), substr(iso, 3, 8), y || '-' || m || '-', y || '-', y || '/' || m || '/' || d,
  y || '-0' || m || '-' || d || '0', y || '-13-01', y || '-00-10', y || '-02-' || d, y || '-02-29', y || '-04-31',
  y || '-' || m || '-32', '', ' ', NULL, 'nan', y || '-' || m || 'T10', '+-' || iso, chr(10) || y || chr(13) || chr(10),
  y || ' ' || m, replace(iso, '-', '')]"""

# The date grammar: blanks around are dropped; a sign or none, a year of 4 to 7 digits, then maybe '-' and a month of
# one or two digits, then maybe '-' and a day of one or two, behind which a blank or 'T' starts a part that is not read.
# Missing month and day are 1. The numbers must be a day of the calendar. Days are counted from March of a year
# that 4000 cycles of 400 years are added to, so that no number is negative.
LENIENT_DATES = f"""
SELECT order_key, date_text, CASE WHEN y IS NOT NULL AND m BETWEEN 1 AND 12 AND d BETWEEN 1 AND
    CASE WHEN m = 2 THEN CASE WHEN y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0) THEN 29 ELSE 28 END
         WHEN m IN (4, 6, 9, 11) THEN 30 ELSE 31 END
  THEN TRY_CAST(365 * yy + yy // 4 - yy // 100 + yy // 400 + (153 * mm + 2) // 5 + d - 1 - 719468
                - 4000 * 146097 AS INTEGER) END AS epoch_day
FROM (
  SELECT *, 1600000 + y - CASE WHEN m <= 2 THEN 1 ELSE 0 END AS yy, (m + 9) % 12 AS mm
  FROM (
    SELECT order_key, date_text, CAST(nullif(f[1], '') AS BIGINT) AS y,
           CAST(coalesce(nullif(f[2], ''), '1') AS BIGINT) AS m, CAST(coalesce(nullif(f[3], ''), '1') AS BIGINT) AS d
    FROM (SELECT *, [regexp_extract(t, g, 1), regexp_extract(t, g, 2), regexp_extract(t, g, 3)] AS f
      FROM (SELECT *, regexp_replace(regexp_replace(coalesce(date_text, ''), '^[\\x00-\\x20\\x7F]+', ''),
                                     '[\\x00-\\x20\\x7F]+$', '') AS t,
                   '^([+-]?[0-9]{{4,7}})(?:-([0-9]{{1,2}})(?:-([0-9]{{1,2}})(?:[ T](?s:.*))?)?)?$' AS g
        FROM (SELECT o_orderkey AS order_key, ({DATE_FORMS})[(o_orderkey // 3) % 35 + 1] AS date_text
          FROM (SELECT o_orderkey, strftime(dd, '%Y-%m-%d') AS iso, CAST(year(dd) AS VARCHAR) AS y,
                       CAST(month(dd) AS VARCHAR) AS m, CAST(day(dd) AS VARCHAR) AS d
                FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dd FROM orders) a) b) c) d0) e) p) q"""

# Why a row is rejected: each rule by itself, in the audit's order of words.
REASONS = """
SELECT s.row_id, s.order_id, concat_ws(',',
    CASE WHEN s.row_id IS NULL THEN 'row_id_not_null' END, CASE WHEN s.order_id IS NULL THEN 'order_id_not_null' END,
    CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
    CASE WHEN customer_name IS NULL THEN 'customer_name_not_null' END,
    CASE WHEN country IS NULL THEN 'country_not_null' END, CASE WHEN segment IS NULL THEN 'segment_not_null' END,
    CASE WHEN city IS NULL THEN 'city_not_null' END, CASE WHEN order_date IS NULL THEN 'order_date_valid' END,
    CASE WHEN shipment_date IS NULL THEN 'shipment_date_valid' END,
    CASE WHEN s.row_id IN (SELECT row_id FROM dup_row) THEN 'row_id_unique' END,
    CASE WHEN s.order_id IN (SELECT order_id FROM dup_ord) THEN 'order_id_unique' END,
    CASE WHEN shipment_date < order_date THEN 'shipment_date_on_or_after_order_date' END,
    CASE WHEN shipment_mode IS NULL OR shipment_mode NOT IN (""" + ALLOWED_SQL + """) THEN 'shipment_mode_allowed' END
  ) AS failed_rules, order_date_text, shipment_date_text
FROM texts s WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.row_id = s.row_id)"""

ORACLE: dict[str, str] = {
    "src_csv_roundtrip": f"SELECT {CSV_COLS} FROM raw",
    "bronze_partition_read": "SELECT * FROM bronze",
    "src_header_check": (
        "SELECT CAST(count(*) AS BIGINT) AS conforming_rows, CAST(0 AS BIGINT) AS other_files FROM raw"
    ),
    "src_inventory": "SELECT count(*) > 0 AS non_empty, CAST(count(*) AS BIGINT) AS row_count FROM raw",
    "sink_bronze_roundtrip": (
        f"SELECT {CSV_COLS}, {q(BRONZE_ROOT)} AS file_path, {q(RUN_TS)} AS execution_datetime, "
        "order_date_year, order_date_month, order_date_day FROM bronze"
    ),
    "sink_silver_roundtrip": (
        "SELECT row_id, order_id, order_date, shipment_date, shipment_mode, customer_id, customer_name, segment, "
        f"country, city, {q(SILVER_TAG)} AS file_path, {q(RUN_TS)} AS execution_datetime, "
        "order_date_year, order_date_month, order_date_day FROM valid"
    ),
    "layer_row_counts": (
        "SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze "
        "UNION ALL SELECT 'silver', count(*) FROM valid HAVING count(*) > 0 "
        "UNION ALL SELECT 'rejected', count(*) FROM rejected HAVING count(*) > 0"
    ),
    "rename_columns": (
        "SELECT row_id, order_id, order_date, ship_date AS shipment_date, ship_mode AS shipment_mode, customer_id, "
        "customer_name, segment AS customer_segment, country, city FROM raw"
    ),
    "lineage_stamp": f"SELECT *, {q(BRONZE_TAG)} AS file_path, {q(RUN_TS)} AS execution_datetime FROM raw",
    "date_partitions": f"SELECT *, {parts('TRY_CAST(order_date AS DATE)')} FROM raw",
    "standardize_strings": (
        "SELECT row_id, "
        + ", ".join(f"{clean(c)} AS {c}" for c in RAW_COLS.split(", ")[1:])
        + " FROM raw"
    ),
    "canonicalize_modes": f"SELECT row_id, ship_mode, {mode_case(clean('ship_mode'))} AS shipment_mode FROM raw",
    "initcap_names": f"SELECT row_id, {initcap(clean('customer_name'))} AS customer_name FROM raw",
    "split_names": (
        "SELECT row_id, customer_name, string_split(customer_name, ' ')[1] AS customer_first_name, "
        "string_split(customer_name, ' ')[-1] AS customer_last_name FROM std"
    ),
    "parse_dates": (
        f"SELECT row_id, TRY_CAST({clean('order_date')} AS DATE) AS order_date, "
        f"TRY_CAST({clean('ship_date')} AS DATE) AS shipment_date FROM raw"
    ),
    "period_starts": "SELECT * FROM starts",
    "silver_standardized": f"SELECT {SILVER_SELECT} FROM std",
    "gold_sales": (
        f"SELECT order_id, order_date, shipment_date, shipment_mode, city, {q(GOLD_SALES_TAG)} AS file_path, "
        f"{q(RUN_TS)} AS execution_datetime, order_date_year, order_date_month, order_date_day FROM valid"
    ),
    "filter_required": (
        "SELECT * FROM std WHERE row_id IS NOT NULL AND order_id IS NOT NULL AND customer_id IS NOT NULL "
        "AND customer_name IS NOT NULL AND country IS NOT NULL AND segment IS NOT NULL AND city IS NOT NULL "
        "AND order_date IS NOT NULL AND shipment_date IS NOT NULL"
    ),
    "filter_chronology": "SELECT * FROM std WHERE shipment_date >= order_date",
    "filter_allow_list": f"SELECT * FROM std WHERE shipment_mode IN ({ALLOWED_SQL})",
    "duplicate_keys": (
        "SELECT 'row_id' AS key_column, CAST(row_id AS VARCHAR) AS key_value, count(*) AS copies FROM std "
        "GROUP BY row_id HAVING count(*) > 1 UNION ALL "
        "SELECT 'order_id', order_id, count(*) FROM std GROUP BY order_id HAVING count(*) > 1"
    ),
    "anti_duplicate_rows": "SELECT * FROM std s WHERE NOT EXISTS (SELECT 1 FROM dup_row d WHERE d.row_id = s.row_id)",
    "anti_duplicate_orders": (
        "SELECT * FROM std s WHERE NOT EXISTS (SELECT 1 FROM dup_ord d WHERE d.order_id = s.order_id)"
    ),
    "valid_rows": "SELECT * FROM valid",
    "rejected_rows": "SELECT * FROM rejected",
    "rejected_reasons": REASONS,
    "job_quarantine_reasons": REASONS,
    "lenient_dates": LENIENT_DATES,
    "customer_summary_refreshed": "SELECT * FROM summary",
    "dq_missing_counts": rule_rows("bronze", "bronze", lambda n: n.endswith("_not_null")),
    "dq_surplus_duplicates": rule_rows("silver", "std", lambda n: n.endswith("_unique")),
    "dq_date_validity": rule_rows("bronze", "bronze", lambda n: n.endswith("_date_valid")),
    "dq_chronology": rule_rows("silver", "std", lambda n: n == "shipment_date_on_or_after_order_date"),
    "dq_allow_list": rule_rows("silver", "std", lambda n: n == "shipment_mode_allowed"),
    "dq_report_bronze": report_sql("bronze", "bronze", BRONZE_TAG),
    "dq_report_silver": report_sql("silver", "std", SILVER_TAG),
    "dq_report_all": f"{report_sql('bronze', 'bronze', BRONZE_TAG)} UNION ALL {report_sql('silver', 'std', SILVER_TAG)}",
    "latest_order_date": "SELECT latest_day FROM latest",
    "customer_total_orders": f"SELECT {KEYS_AND}, total_orders FROM summary",
    "orders_last_month": f"SELECT {KEYS_AND}, orders_last_month FROM summary",
    "orders_last_6_months": f"SELECT {KEYS_AND}, orders_last_6_months FROM summary",
    "orders_last_12_months": f"SELECT {KEYS_AND}, orders_last_12_months FROM summary",
    "customer_order_summary": (
        f"SELECT *, {q(GOLD_CUSTOMER_TAG)} AS file_path, {q(RUN_TS)} AS execution_datetime FROM summary"
    ),
    # Tables written by the end-to-end job; file_path is relative to the lake's root.
    "job_sales_table": (
        f"SELECT order_id, order_date, shipment_date, shipment_mode, city, {q(GOLD_SALES_ROOT)} AS file_path, "
        f"{q(RUN_TS)} AS execution_datetime, order_date_year, order_date_month, order_date_day FROM valid"
    ),
    "job_customer_table": (
        f"SELECT *, {q(GOLD_CUSTOMER_ROOT)} AS file_path, {q(RUN_TS)} AS execution_datetime FROM summary"
    ),
    "job_quality_table": (
        f"{report_sql('bronze', 'bronze', BRONZE_ROOT)} UNION ALL {report_sql('silver', 'std', SILVER_ROOT)}"
    ),
    "job_quarantine_table": f"SELECT * REPLACE ({q(BRONZE_ROOT)} AS file_path) FROM rejected",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_base(body) for name, body in ORACLE.items()}
