"""Independent ANSI SQL (DuckDB dialect) for every batch-checkable query.

Written from the dataset definitions, not generated from the Spark plans:
latest-per-key is ROW_NUMBER() or QUALIFY, history is LEAD(), the fraud gold
counts payments per booking and sums products. Tables are the given parquet files.
"""

from __future__ import annotations


def _avg2(x: str) -> str:
    """ROUND(AVG(x), 2) for non-negative x with two decimals, exactly:
    half-up on integer cents, independent of summation order."""
    cents = f"CAST(ROUND({x} * 100) AS BIGINT)"
    return f"((2 * SUM({cents}) + COUNT({x})) // (2 * COUNT({x}))) / 100.0"


_TX = """tx AS (
  SELECT p.{product} AS product, l.l_quantity AS quantity, l.l_extendedprice AS totalPrice,
         o.o_custkey AS customerID, l.l_suppkey AS franchiseID
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

_STATS = f"""stats AS (
  SELECT product, COUNT(*) AS txn_count, SUM(quantity) AS units_sold,
         ROUND(SUM(totalPrice), 2) AS gross_revenue, {_avg2('totalPrice')} AS avg_txn_value,
         COUNT(DISTINCT customerID) AS unique_customers,
         COUNT(DISTINCT franchiseID) AS franchises_selling
  FROM tx GROUP BY product)"""

SALES_STATS = f"""WITH {_TX.format(product='p_type')}, {_STATS}
SELECT * FROM stats WHERE coalesce(gross_revenue >= 0, false)"""

SALES_BY_BRAND_DROP = f"""WITH {_TX.format(product='p_brand')}, {_STATS}
SELECT * FROM stats
WHERE coalesce(gross_revenue >= 0, false) AND coalesce(avg_txn_value >= 53000.0, false)"""

_CHECKS = [
    ("reasonable_avg_value", "log", "avg_txn_value BETWEEN 1 AND 1000"),
    ("nonneg_revenue", "drop", "gross_revenue >= 0"),
    ("known_product", "fail", "product IS NOT NULL"),
]
SALES_EXPECTATIONS = f"""WITH {_TX.format(product='p_type')}, {_STATS},
m AS (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE NOT coalesce(gross_revenue >= 0, false)) AS dropped,
         {", ".join(f"COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS {n}" for n, _, p in _CHECKS)}
  FROM stats)
""" + "\nUNION ALL\n".join(
    f"SELECT 'sales_stats' AS dataset, '{n}' AS expectation, '{a}' AS action, n AS input_rows, "
    f"{n} AS failed_rows, n - dropped AS output_rows, dropped AS dropped_rows, "
    f"round(100.0 * (n - dropped) / n, 2)::DOUBLE AS written_pct, "
    f"round(100.0 * dropped / n, 2)::DOUBLE AS dropped_pct FROM m"
    for n, a, _ in _CHECKS)

SALES_INCREMENTAL = f"""
SELECT o_orderpriority, COUNT(*) AS price_rows, ROUND(SUM(o_totalprice), 2) AS price_sum,
       {_avg2('o_totalprice')} AS price_avg, MIN(o_totalprice) AS price_min,
       MAX(o_totalprice) AS price_max
FROM orders GROUP BY o_orderpriority"""

_BOOKINGS = """bookings AS (
  SELECT booking_id, update_line, update_part, update_supp, quantity, amount, guests_count FROM (
    SELECT l_orderkey AS booking_id, l_linenumber AS update_line, l_partkey AS update_part,
           l_suppkey AS update_supp, l_quantity AS quantity, l_extendedprice AS amount,
           CAST(l_quantity % 6 AS INTEGER) + 1 AS guests_count,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                                       l_quantity DESC, l_extendedprice DESC) AS rn
    FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_partkey IS NOT NULL
      AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)
  WHERE rn = 1)"""

# 3 % of the ids by a selection hash below 0.03 * 2147483647; columns by another hash
_PICKED = """picked AS (
  SELECT booking_id FROM (SELECT DISTINCT l_orderkey AS booking_id FROM lineitem)
  WHERE ((booking_id % 2147483647) + 2147483647) % 2147483647 * 1220703125 % 2147483647 < 64424510)"""

_FLAG_COLUMNS = """
  SELECT booking_id, 'fraud' AS flag,
         ['velocity_check_failed', 'stolen_card_report', 'unusual_location',
          'device_fingerprint_mismatch', 'suspicious_pattern'][CAST(h % 5 AS INTEGER) + 1] AS reason,
         strftime(TIMESTAMP '2026-05-17 13:34:00' - to_days(CAST(h % 90 AS INTEGER)),
                  '%Y-%m-%dT%H:%M:%SZ') AS flagged_at,
         ROUND(0.70 + (h % 3000) / 10000.0, 4) AS confidence FROM hashed"""

_FLAGS = f"""{_PICKED},
hashed AS (SELECT booking_id, (((booking_id % 1000003) + 1000003) % 1000003) * 7919 % 1000003 AS h
           FROM picked),
flags AS ({_FLAG_COLUMNS})"""


def _murmur3(source: str, key: str) -> str:
    """CTEs ending in ``hashed`` (key, h): abs of the 32-bit murmur3 of a
    BIGINT with seed 42, in unsigned 64-bit arithmetic."""
    m = 4294967295
    rot = lambda x, r: f"((({x} << {r}) | ({x} >> {32 - r})) & {m})"
    steps = []
    for half in ("lo", "hi"):
        steps += [f"h, ({half} * 3432918353) & {m} AS k",
                  f"h, ({rot('k', 15)} * 461845907) & {m} AS k",
                  "xor(h, k) AS h, k",
                  f"({rot('h', 13)} * 5 + 3864292196) & {m} AS h, k"]
    steps += ["xor(h, 8) AS h, k", "xor(h, h >> 16) AS h, k", f"(h * 2246822507) & {m} AS h, k",
              "xor(h, h >> 13) AS h, k", f"(h * 3266489909) & {m} AS h, k", "xor(h, h >> 16) AS h, k"]
    out = [f"""m0 AS (SELECT {key}, ({key} & {m})::UBIGINT AS lo, (({key} >> 32) & {m})::UBIGINT AS hi,
                 42::UBIGINT AS h, 0::UBIGINT AS k FROM {source})"""]
    out += [f"m{i + 1} AS (SELECT {key}, lo, hi, {step} FROM m{i})" for i, step in enumerate(steps)]
    return ", ".join(out) + f""",
hashed AS (SELECT {key}, abs(CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296 ELSE h::BIGINT END) AS h
           FROM m{len(steps)})"""


SEED_MARKERS = f"WITH {_PICKED}, {_murmur3('picked', 'booking_id')} {_FLAG_COLUMNS}"

# flagged and unflagged bookings apart
_BWF = f"""{_BOOKINGS}, {_FLAGS},
bwf AS (
  SELECT b.*, true AS is_fraud, f.confidence AS fraud_confidence, f.reason AS fraud_reason
  FROM flags f, bookings b WHERE f.booking_id = b.booking_id
  UNION ALL
  SELECT b.*, false, NULL, NULL FROM bookings b
  WHERE b.booking_id NOT IN (SELECT booking_id FROM flags))"""

# payments counted per booking, then weighted sums
_GOLD = f"""{_BWF},
paid AS (SELECT o_orderkey AS booking_id, o_orderpriority AS payment_method, count(*) AS np
         FROM orders GROUP BY ALL),
party AS (SELECT booking_id, guests_count AS party_size, count(*) AS nb,
                 count(*) FILTER (is_fraud) AS nf FROM bwf GROUP BY ALL),
gold AS (
  SELECT party_size, payment_method, sum(nb * np)::BIGINT AS total_bookings,
         sum(nf * np)::BIGINT AS fraud_count,
         round(100.0 * sum(nf * np) / sum(nb * np), 2)::DOUBLE AS fraud_rate_pct
  FROM party JOIN paid USING (booking_id) GROUP BY ALL)"""


def _one_way(dim: str) -> str:
    return f"""WITH {_GOLD}
SELECT {dim}, CAST(SUM(total_bookings) AS BIGINT) AS total_bookings,
       CAST(SUM(fraud_count) AS BIGINT) AS fraud_count,
       CAST(ROUND(SUM(fraud_count) * 100.0 / SUM(total_bookings), 2) AS DOUBLE) AS fraud_rate_pct
FROM gold GROUP BY {dim}"""


CHI2 = f"""WITH {_GOLD},
t AS (SELECT SUM(total_bookings) AS n, SUM(fraud_count) AS f FROM gold),
e AS (SELECT g.*, g.total_bookings * (t.f / t.n) AS ef,
             g.total_bookings * (1.0 - t.f / t.n) AS eo FROM gold g, t)
SELECT ROUND(SUM(CASE WHEN ef > 0 THEN (fraud_count - ef) ^ 2 / ef ELSE 0 END
               + CASE WHEN eo > 0 THEN ((total_bookings - fraud_count) - eo) ^ 2 / eo ELSE 0 END), 6)
         AS chi2,
       CAST(GREATEST(COUNT(*) - 1, 0) AS BIGINT) AS dof, COUNT(*) AS cells
FROM e"""

# the incomplete gamma function term by term, over lgamma
SIGNIFICANCE = f"""WITH {_GOLD},
levels AS (
  SELECT 'party_size' AS dimension, party_size::VARCHAR AS level, total_bookings AS n, fraud_count AS f FROM gold
  UNION ALL SELECT 'payment_method', payment_method, total_bookings, fraud_count FROM gold
  UNION ALL SELECT 'party_size x payment_method', party_size || '/' || payment_method,
                   total_bookings, fraud_count FROM gold),
cells AS (SELECT dimension, level, sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f FROM levels GROUP BY ALL),
rated AS (SELECT *, sum(f) OVER w / sum(n) OVER w AS p FROM cells WINDOW w AS (PARTITION BY dimension)),
tests AS (SELECT dimension, sum((f - n * p) ^ 2 / (n * p) + (n * p - f) ^ 2 / (n * (1 - p))) AS s,
                 (count(*) - 1)::INT AS dof FROM rated GROUP BY dimension)
SELECT dimension, round(s, 6) AS statistic, dof,
       round(greatest(1 - list_sum([exp((dof / 2.0 + i) * ln(s / 2) - s / 2 - lgamma(dof / 2.0 + i + 1))
                                    FOR i IN range(0, 1000)]), 0), 6) AS p_value
FROM tests"""

_READINGS = """readings AS (
  SELECT CAST(event_id % 25 AS INTEGER) AS sensor_id, ROUND(18 + value % 12, 2) AS temperature_c,
         CASE WHEN ROUND(18 + value % 12, 2) > 28 THEN 'HOT' ELSE 'OK' END AS status,
         ts AS event_ts, event_id AS reading_seq
  FROM events)"""

# every event reports its tick, the last report is current
_REGISTRY = """registry AS (
  SELECT CAST((event_id // 5) % 25 AS INTEGER) AS sensor_id,
         ['Zone-North', 'Zone-South', 'Zone-East', 'Zone-West']
           [CAST((((event_id // 5) % 25) + (event_id // 500)) % 4 AS INTEGER) + 1] AS zone,
         ts AS updated_ts, event_id // 5 AS registry_seq, event_id AS registry_event
  FROM events)"""

_SILVERS = f"""{_READINGS}, {_REGISTRY},
state AS (SELECT sensor_id, temperature_c, status, event_ts, reading_seq FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY reading_seq DESC) AS rn
  FROM readings) WHERE rn = 1),
zones AS (SELECT * FROM registry
          QUALIFY registry_event = max(registry_event) OVER (PARTITION BY sensor_id)),
gold AS (
  SELECT z.zone, COUNT(*) AS sensor_count,
         CAST(SUM(CASE WHEN s.status = 'HOT' THEN 1 ELSE 0 END) AS BIGINT) AS hot_sensors,
         {_avg2('s.temperature_c')} AS avg_temp_c, ROUND(MIN(s.temperature_c), 2) AS min_temp_c,
         ROUND(MAX(s.temperature_c), 2) AS max_temp_c
  FROM state s JOIN zones z ON s.sensor_id = z.sensor_id GROUP BY z.zone)"""

ROW_COUNTS = f"""WITH {_SILVERS}
SELECT 'sensor_readings_bronze' AS dataset, COUNT(*) AS row_count FROM readings
UNION ALL SELECT 'sensor_registry_bronze', COUNT(*) FROM registry
UNION ALL SELECT 'sensor_state_silver', COUNT(*) FROM state
UNION ALL SELECT 'sensor_zone_silver', COUNT(*) FROM zones
UNION ALL SELECT 'zone_stats_gold', COUNT(*) FROM gold"""

EVENTS_SCD2 = """
SELECT event_id, ts, user_id, event_type, value, props, event_id AS __START_AT,
       LEAD(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS __END_AT
FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL"""

EVENTS_AS_OF = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events
  WHERE user_id IS NOT NULL AND event_id <= (SELECT max(event_id) // 2 FROM events))
WHERE rn = 1"""

_MEAS = """measurements AS (
  SELECT DISTINCT CAST(e.event_id AS VARCHAR) AS id, n.n_name AS city,
         CAST(CAST(e.value AS FLOAT) AS DOUBLE) AS temperature, e.event_type AS comment
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

OWNER_SLUG = """
SELECT c_custkey, email, lower(translate(split_part(email, '@', 1), '.-', '__')) AS owner_slug
FROM (SELECT c_custkey, concat(replace(c_name, '#', '.'), '-', c_mktsegment, '@example.com') AS email
      FROM customer)"""

SALES_ROW_COUNTS = f"""WITH {_TX.format(product='p_type')}, {_STATS}
SELECT 'sales_transactions' AS dataset, COUNT(*) AS row_count FROM tx
UNION ALL SELECT 'sales_stats', COUNT(*) FROM stats WHERE coalesce(gross_revenue >= 0, false)"""

FRAUD_ROW_COUNTS = f"""WITH {_GOLD}
SELECT 'booking_updates' AS dataset, COUNT(*) AS row_count FROM lineitem
UNION ALL SELECT 'bookings', COUNT(*) FROM bookings
UNION ALL SELECT 'fraud_flags', COUNT(*) FROM flags
UNION ALL SELECT 'payments', COUNT(*) FROM orders
UNION ALL SELECT 'bookings_with_fraud', COUNT(*) FROM bwf
UNION ALL SELECT 'fraud_by_party_and_method', COUNT(*) FROM gold"""

ORACLE_SQL = {
    "sales_stats": SALES_STATS,
    "sales_stats_expectations": SALES_EXPECTATIONS,
    "sales_stats_by_brand_drop": SALES_BY_BRAND_DROP,
    "sales_stats_incremental": SALES_INCREMENTAL,
    "sales_row_counts": SALES_ROW_COUNTS,
    "fraud_row_counts": FRAUD_ROW_COUNTS,
    "bookings_scd1": f"WITH {_BOOKINGS} SELECT * FROM bookings",
    "fraud_flags": f"WITH {_FLAGS} SELECT * FROM flags",
    "fraud_flags_preview": f"WITH {_FLAGS} SELECT * FROM flags ORDER BY booking_id LIMIT 5",
    "bookings_with_fraud": f"WITH {_BWF} SELECT * FROM bwf",
    "fraud_by_party_and_method": f"WITH {_GOLD} SELECT * FROM gold",
    "fraud_rate_by_party_size": _one_way("party_size"),
    "fraud_rate_by_payment_method": _one_way("payment_method"),
    "fraud_independence_chi2": CHI2,
    "fraud_significance": SIGNIFICANCE,
    "seed_fraud_markers": SEED_MARKERS,
    "sensor_readings_bronze": f"WITH {_READINGS} SELECT * FROM readings",
    "sensor_registry_bronze": f"WITH {_REGISTRY} SELECT * FROM registry",
    "sensor_state_silver": f"WITH {_SILVERS} SELECT * FROM state",
    "sensor_zone_silver": f"WITH {_SILVERS} SELECT * FROM zones",
    "zone_stats_gold": f"WITH {_SILVERS} SELECT * FROM gold",
    "medallion_row_counts": ROW_COUNTS,
    "zone_stats_gold_sorted": f"WITH {_SILVERS} SELECT * FROM gold ORDER BY zone",
    "events_scd2": EVENTS_SCD2,
    "events_as_of": EVENTS_AS_OF,
    "measurements": f"WITH {_MEAS} SELECT * FROM measurements",
    "measurements_sorted": f"WITH {_MEAS} SELECT * FROM measurements ORDER BY city, temperature DESC",
    "measurements_sorted_asc": f"WITH {_MEAS} SELECT * FROM measurements ORDER BY city, temperature",
    "measurements_after_delete":
        f"WITH {_MEAS} SELECT * FROM measurements WHERE NOT coalesce(id = '42', false)",
    "owner_slug": OWNER_SLUG,
    "sales_stats_sql": f"WITH {_TX.format(product='p_type')}, {_STATS} SELECT * FROM stats",
    "fraud_by_party_and_method_sql": f"WITH {_GOLD} SELECT * FROM gold",
}

READINGS_EXPECTATIONS = f"""WITH {_READINGS}
SELECT 'sensor_readings_bronze' AS dataset, 'valid_temperature' AS expectation, 'log' AS action,
       COUNT(*) AS input_rows,
       COUNT(*) FILTER (WHERE NOT coalesce(temperature_c BETWEEN -20 AND 60, false)) AS failed_rows,
       COUNT(*) AS output_rows, CAST(0 AS BIGINT) AS dropped_rows,
       100.0::DOUBLE AS written_pct, 0.0::DOUBLE AS dropped_pct
FROM readings"""

MEASUREMENTS_EXPECTATIONS = f"""WITH {_MEAS},
n AS (SELECT 2 * count(*) AS landed FROM measurements)
SELECT 'measurements' AS dataset, unnest(['line_parsed', 'city_present', 'temperature_parsed']) AS expectation,
       'drop' AS action, landed AS input_rows, CAST(0 AS BIGINT) AS failed_rows, landed AS output_rows,
       CAST(0 AS BIGINT) AS dropped_rows, 100.0::DOUBLE AS written_pct, 0.0::DOUBLE AS dropped_pct
FROM n"""

MEASUREMENT_LOOKUP = f"WITH {_MEAS} SELECT * FROM measurements WHERE id = '42'"
