"""DuckDB SQL for the fixture projections, used as CTEs by the oracle strings."""

from __future__ import annotations

from quarry.functions import vocab as V


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def pick(values, index_sql: str) -> str:
    return f"({sql_list(values)})[({index_sql}) + 1]"


_DEV = "event_id % 4 IN (0, 2)"

TRANSACTIONS = f"""
SELECT CAST(event_id AS VARCHAR) AS transaction_id,
       ts AS event_time,
       'cust_' || CAST(user_id AS VARCHAR) AS customer_id,
       'merch_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 AS VARCHAR) AS merchant_id,
       event_type AS merchant_category,
       {pick(V.PAYMENT_METHODS, 'event_id % 4')} AS payment_method,
       CAST(round(value * 100) * 1000 AS BIGINT) AS amount,
       CASE WHEN event_id % 20 = 0 THEN 'declined' ELSE 'approved' END AS status,
       {pick(V.COMMISSION_TYPES, 'event_id % 3')} AS commission_type,
       CAST(round(value * 100) * 1000 AS BIGINT) // 50 AS commission_amount,
       (CAST(round(value * 100) * 1000 AS BIGINT) * 9) // 100 AS vat_amount,
       CAST(round(value * 100) * 1000 AS BIGINT) + (CAST(round(value * 100) * 1000 AS BIGINT) * 9) // 100 AS total_amount,
       {pick(V.CUSTOMER_TYPES, 'user_id % 3')} AS customer_type,
       CAST(CASE WHEN event_id % 50 = 7 THEN 5 ELSE 1 + event_id % 3 END AS INTEGER) AS risk_level,
       CASE WHEN event_id % 20 = 0 THEN {pick(V.FAILURE_REASONS, '(event_id // 20) % 4')} END AS failure_reason,
       CAST({V.BASE_LAT} AS DOUBLE) + ((event_id * 7919) % 2000 - 1000) / 1000 AS location_lat,
       CAST({V.BASE_LNG} AS DOUBLE) + ((event_id * 104729) % 2000 - 1000) / 1000 AS location_lng,
       CASE WHEN {_DEV} THEN {pick([d['os'] for d in V.DEVICE_LIBRARY], 'event_id % 3')} END AS device_os,
       CASE WHEN {_DEV} THEN {pick([d['app_version'] for d in V.DEVICE_LIBRARY], 'event_id % 3')} END AS device_app_version,
       CASE WHEN {_DEV} THEN {pick([d['device_model'] for d in V.DEVICE_LIBRARY], 'event_id % 3')} END AS device_model
FROM events
"""

VIEWS: dict[str, str] = {"transactions": TRANSACTIONS}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named projection CTEs (in dependency order)."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"

RAW_FLAT = """
SELECT transaction_id,
       date_trunc('millisecond', event_time)
         - CASE WHEN CAST(transaction_id AS BIGINT) % 103 = 0 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS event_time,
       event_time AS ingest_time,
       customer_id, merchant_id, merchant_category, payment_method, amount, status, commission_type,
       commission_amount, vat_amount,
       total_amount + CASE WHEN CAST(transaction_id AS BIGINT) % 97 = 0 THEN 1 ELSE 0 END AS total_amount,
       customer_type, risk_level, failure_reason, location_lat, location_lng,
       CASE WHEN CAST(transaction_id AS BIGINT) % 101 = 0 AND device_os IS NOT NULL THEN 'Symbian' ELSE device_os END AS device_os,
       device_app_version, device_model
FROM transactions
"""

VALIDATED = """
SELECT *,
  CASE WHEN payment_method = 'mobile' AND coalesce(device_os IN ('iOS', 'Android'), false) = false THEN 'ERR_DEVICE'
       WHEN amount + vat_amount <> total_amount THEN 'ERR_AMOUNT'
       WHEN event_time > ingest_time OR event_time < ingest_time - INTERVAL 1 DAY THEN 'ERR_TIME'
  END AS error_code
FROM raw_flat
"""

PATIENTS = """
SELECT o.o_orderkey AS patient_id,
       CAST(150 + o.o_orderkey % 50 AS VARCHAR) || 'cm' AS height,
       50 + o.o_custkey % 60 AS weight,
       CAST(o.o_orderdate AS DATE) AS diagnosis_date,
       CAST(p.first_ship AS DATE) AS surgery_date,
       o.o_orderpriority AS stage,
       c.c_mktsegment AS segment,
       p.part_types AS symptoms,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS family_history
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l.l_orderkey, min(l.l_shipdate) AS first_ship,
                  string_agg(DISTINCT pt.p_type, ',' ORDER BY pt.p_type) AS part_types
           FROM lineitem l JOIN part pt ON l.l_partkey = pt.p_partkey GROUP BY l.l_orderkey) p
  ON o.o_orderkey = p.l_orderkey
"""

VIEWS.update({"raw_flat": RAW_FLAT, "validated": VALIDATED, "patients": PATIENTS})

LISTINGS = "SELECT s_suppkey AS listing_id, s_name AS name, s_acctbal AS price, s_nationkey AS neighbourhood_id FROM supplier"
NEIGHBOURHOODS = """
SELECT n_nationkey AS neighbourhood_id, n_name AS neighbourhood, r_name AS neighbourhood_group,
       CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""
VIEWS.update({"listings": LISTINGS, "neighbourhoods": NEIGHBOURHOODS})

OUTCOMES = """
SELECT event_id, event_type AS grp, CAST(round(value * 100) AS BIGINT) - 5000 AS x,
       1 + user_id % 10 AS rounds, user_id FROM events
"""
POLLS = """
SELECT CAST(l_shipdate AS DATE) AS date, round(l_discount * 1000) AS share_a, round(l_tax * 1000) AS share_b,
       l_quantity AS n, l_returnflag AS pollster, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
"""
TRIAL = """
SELECT l.doc_id, l.quality AS grp, CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(l.toxic AS DOUBLE) AS toxic
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""
DAYS = """
SELECT date, CAST(quarter(date) AS INTEGER) AS season_id, CAST(year(date) % 2 AS INTEGER) AS year,
       CAST(month(date) AS INTEGER) AS month, CAST((dayofweek(date) + 6) % 7 AS INTEGER) AS weekday,
       q / total_users AS temperature, d / total_users AS feels_like_temp, t / total_users AS humidity,
       p / total_users / 100000 AS wind_speed, total_users
FROM (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS total_users, sum(l_quantity) AS q,
             sum(CAST(round(l_discount * 100) AS BIGINT)) AS d, sum(CAST(round(l_tax * 100) AS BIGINT)) AS t,
             sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS p
      FROM lineitem GROUP BY 1)
"""
VIEWS.update({"outcomes": OUTCOMES, "polls": POLLS, "trial": TRIAL, "days": DAYS})


def _holidays_sql() -> str:
    from quarry.functions.holidays import FIXED, JUNETEENTH_FROM, NTH

    parts = []
    for name, month, day in FIXED:
        where = f" WHERE y >= {JUNETEENTH_FROM}" if name == "Juneteenth" else ""
        nm = name.replace(chr(39), chr(39) * 2)
        parts.append(f"SELECT make_date(y, {month}, {day}) AS date, '{nm}' AS name FROM yrs{where}")
        # observed days: Friday before a Saturday (New Year's: in the old year), Monday after a Sunday
        first = f"make_date(y + 1, {month}, {day})" if (month, day) == (1, 1) else f"make_date(y, {month}, {day})"
        also = where.replace("WHERE", "AND")
        parts.append(f"SELECT CAST({first} - 1 AS DATE), '{nm} (observed)' FROM yrs WHERE dayofweek({first}) = 6{also}")
        parts.append(f"SELECT CAST(make_date(y, {month}, {day}) + 1 AS DATE), '{nm} (observed)' FROM yrs WHERE dayofweek(make_date(y, {month}, {day})) = 0{also}")
    for name, month, weekday, n in NTH:
        wd = weekday - 1  # DuckDB dayofweek: 0 = Sunday
        nm = name.replace("'", "''")
        if n > 0:
            first = f"make_date(y, {month}, 1)"
            expr = f"{first} + CAST(({wd} - dayofweek({first}) + 7) % 7 + {7 * (n - 1)} AS INTEGER)"
        else:
            last = f"last_day(make_date(y, {month}, 1))"
            expr = f"{last} - CAST((dayofweek({last}) - {wd} + 7) % 7 AS INTEGER)"
        parts.append(f"SELECT CAST({expr} AS DATE) AS date, '{nm}' AS name FROM yrs")
    return (
        "SELECT * FROM (WITH yrs AS (SELECT unnest(range(CAST(min(year(date)) AS INTEGER) - 1, "
        "CAST(max(year(date)) AS INTEGER) + 2)) AS y FROM days)\n" + "\nUNION ALL\n".join(parts) + ")"
    )


VIEWS["holidays"] = _holidays_sql()

RATINGS = """
SELECT user_id, CAST(20 * (user_id // 100) + CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS INTEGER) AS item_id,
       1 + (max(event_id) % 9) / 2 AS label
FROM events GROUP BY 1, 2
"""
TRUST = """
SELECT DISTINCT user_id AS trustor, CAST(user_id + 1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS BIGINT) AS trustee
FROM events
"""
REACH = """
SELECT src, dst, min(hops) AS hops FROM (
  WITH RECURSIVE e AS (SELECT DISTINCT trustor AS src, trustee AS dst FROM trust WHERE trustor <> trustee),
  walk(src, dst, hops) AS (
    SELECT src, dst, 1 FROM e
    UNION
    SELECT w.src, e.dst, w.hops + 1 FROM walk w JOIN e ON w.dst = e.src WHERE w.hops < 9)
  SELECT * FROM walk WHERE src <> dst AND src IN (SELECT user_id FROM ratings))
GROUP BY src, dst
"""
VIEWS.update({"ratings": RATINGS, "trust": TRUST, "reach": REACH})
