"""DuckDB SQL for every registered query, written against the same tables.

Averages, shares and ratios are divided in integers (half-up at four decimals), so they
are exact on both sides. Sums are cast to BIGINT, dates to text.
"""

from __future__ import annotations


def _half_up(total: str, count: str) -> str:
    return f"CAST((2 * 10000 * {total} + {count}) // (2 * {count}) AS DOUBLE) / 10000"


_RAW = """
WITH base AS (
  SELECT event_id AS e, ts, user_id AS u, value AS v,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
steps AS (
  SELECT *,
    ['ORBT','KELP','FJRD','QUAY','MOSQ','VANE','TARN','ZEPH'][u % 8 + 1] AS sym,
    ([31200,9800,14350,27600,45150,12075,58800,20640][u % 8 + 1]
      * (9700 + (e * 7919) % 601)) // 10000 AS und_c,
    10 + (e * 37) % 5000 AS bid_c,
    CAST(ts AS DATE) + CAST(7 + e % 54 AS INTEGER) AS ex
  FROM base
),
struck AS (
  SELECT *, ((und_c + ((e * 31) % 17) * 500 - 4000) // 500) * 500 AS strike_c FROM steps
),
raw AS (
  SELECT e,
    'evt_' || e AS event_id,
    CASE WHEN e % 107 = 0 THEN NULL ELSE sym END AS symbol,
    sym || '_' || strftime(ex, '%Y%m%d') || '_'
      || lpad(CAST(strike_c * 10 AS VARCHAR), 8, '0') || '_'
      || CASE WHEN e % 2 = 0 THEN 'C' ELSE 'P' END AS contract_symbol,
    CASE WHEN e % 101 = 0 THEN '2024-02-30' ELSE strftime(ex, '%Y-%m-%d') END AS expiration_date,
    CAST(CASE WHEN e % 113 = 0 THEN 0 ELSE strike_c / 100.0 END AS DOUBLE) AS strike,
    CASE WHEN e % 61 = 0 THEN 'SELL' WHEN e % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS option_type,
    CAST(CASE WHEN e % 137 = 0 THEN -0.01 ELSE bid_c / 100.0 END AS DOUBLE) AS bid,
    CAST(CASE WHEN e % 131 = 0 THEN -0.02 WHEN e % 71 = 0 THEN (bid_c - 5) / 100.0
         ELSE (bid_c + 1 + e % 75) / 100.0 END AS DOUBLE) AS ask,
    CAST(CASE WHEN e % 109 = 0 THEN -0.01 ELSE bid_c / 100.0 END AS DOUBLE) AS last_price,
    CASE WHEN e % 53 = 0 THEN -1 ELSE CAST(floor(v * 40) AS INTEGER) END AS volume,
    CAST(CASE WHEN e % 97 = 0 THEN 0 WHEN e % 83 = 0 THEN -5
         ELSE 50 + (e * 7919 + k * 131) % 15000 END AS INTEGER) AS open_interest,
    CAST(CASE WHEN e % 89 = 0 THEN 0 ELSE (1500 + (e * 104729) % 10501) / 10000.0 END AS DOUBLE)
      AS implied_volatility,
    CAST(((e * 13) % 181 - 90) / 100.0 AS DOUBLE) AS delta,
    CAST(CASE WHEN e % 127 = 0 THEN 0 ELSE und_c / 100.0 END AS DOUBLE) AS underlying_price,
    CASE WHEN e % 103 = 0 THEN 'not-a-timestamp'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_timestamp,
    'events' AS source
  FROM struck
),
checked AS (
  SELECT *,
    CASE WHEN symbol IS NULL THEN 'Missing required field: symbol'
    ELSE concat_ws(';',
      CASE WHEN option_type NOT IN ('CALL', 'PUT')
           THEN 'option_type must be one of {''CALL'', ''PUT''}' END,
      CASE WHEN volume < 0 THEN 'volume cannot be negative' END,
      CASE WHEN open_interest < 0 THEN 'open_interest cannot be negative' END,
      CASE WHEN bid < 0 THEN 'bid cannot be negative' END,
      CASE WHEN ask < 0 THEN 'ask cannot be negative' END,
      CASE WHEN bid > ask THEN 'bid cannot be greater than ask' END,
      CASE WHEN last_price < 0 THEN 'last_price cannot be negative' END,
      CASE WHEN strike <= 0 THEN 'strike must be positive' END,
      CASE WHEN underlying_price <= 0 THEN 'underlying_price must be positive' END,
      CASE WHEN implied_volatility <= 0 THEN 'implied_volatility must be positive' END,
      CASE WHEN TRY_CAST(event_timestamp AS TIMESTAMP) IS NULL
           THEN 'event_timestamp must be a valid ISO datetime' END,
      CASE WHEN TRY_CAST(expiration_date AS DATE) IS NULL
           THEN 'expiration_date must be a valid ISO date' END)
    END AS validation_errors
  FROM raw
)"""

_ENRICHED_OF = """
  SELECT *,
    CASE WHEN open_interest <> 0
         THEN CAST((CAST(volume AS BIGINT) * 20000 + open_interest)
              // (2 * CAST(open_interest AS BIGINT)) AS DOUBLE) / 10000
    END AS volume_open_interest_ratio,
    concat_ws('|',
      CASE WHEN volume >= 5000 THEN 'HIGH_VOLUME' END,
      CASE WHEN open_interest > 0 AND volume >= open_interest
           THEN 'VOLUME_EXCEEDS_OPEN_INTEREST' END,
      CASE WHEN implied_volatility >= CAST(0.8 AS DOUBLE) THEN 'HIGH_IV' END
    ) AS unusual_activity_flags,
    CAST(CAST(volume >= 5000 AS INTEGER)
      + CAST(open_interest > 0 AND volume >= open_interest AS INTEGER)
      + CAST(implied_volatility >= CAST(0.8 AS DOUBLE) AS INTEGER) AS INTEGER
    ) AS unusual_activity_score"""

_ENRICHED = f"""{_RAW},
enriched AS ({_ENRICHED_OF}
  FROM checked WHERE validation_errors = ''
),
typed AS (
  SELECT * EXCLUDE (event_timestamp),
    CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
    CAST(CAST(event_timestamp AS TIMESTAMP) AS DATE) AS event_day
  FROM enriched
),
activity AS (
  SELECT event_id, contract_symbol, symbol,
         unnest(string_split(unusual_activity_flags, '|')) AS flag, event_timestamp
  FROM typed WHERE unusual_activity_score > 0
)"""

# The lines of `dirty_lines` that a reader can use, with what is wrong with the others.
_DIRTY = f"""{_RAW},
dirty AS (
  SELECT * EXCLUDE (event_id, source, validation_errors),
    CASE WHEN e % 19 = 4 THEN 'evt_' || (e - 1) ELSE event_id END AS event_id,
    CASE WHEN e % 31 = 7 THEN NULL ELSE source END AS source,
    CASE WHEN e % 11 IN (1, 6) THEN 'malformed JSON'
         WHEN symbol IS NULL THEN validation_errors
         WHEN e % 11 = 4 THEN 'volume has invalid type'
         WHEN e % 11 = 5 THEN 'strike has invalid type'
         ELSE validation_errors END AS validation_errors
  FROM checked
),
dirty_typed AS (
  SELECT * EXCLUDE (event_timestamp),
    CAST(event_timestamp AS TIMESTAMP)
      + CASE WHEN e % 7 = 3 THEN INTERVAL '-150 minutes' WHEN e % 29 = 5 THEN INTERVAL '1395 minutes'
             ELSE INTERVAL '0 minutes' END AS event_timestamp
  FROM dirty WHERE validation_errors = ''
)"""

# Two deliveries, merged first-wins table by table.
_REPLAY = f"""{_ENRICHED},
second_base AS (
  SELECT * EXCLUDE (event_id, contract_symbol, volume, strike, volume_open_interest_ratio,
                    unusual_activity_flags, unusual_activity_score),
    CASE WHEN volume % 2 = 0 THEN event_id || '_b' ELSE event_id END AS event_id,
    CASE WHEN volume % 2 = 0 THEN contract_symbol || '_ADJ' ELSE contract_symbol END
      AS contract_symbol,
    volume + 5000 AS volume, strike + 1.0 AS strike
  FROM typed
),
second AS ({_ENRICHED_OF}
  FROM second_base
),
both_loads AS (
  SELECT 1 AS load, event_id, contract_symbol, symbol, option_type, strike, expiration_date,
         volume, unusual_activity_flags, unusual_activity_score, event_timestamp FROM typed
  UNION ALL
  SELECT 2, event_id, contract_symbol, symbol, option_type, strike, expiration_date,
         volume, unusual_activity_flags, unusual_activity_score, event_timestamp FROM second
),
merged_events AS (
  SELECT * FROM both_loads
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY load) = 1
),
merged_contracts AS (
  SELECT * FROM both_loads
  QUALIFY row_number() OVER (PARTITION BY contract_symbol
                             ORDER BY load, event_timestamp, event_id) = 1
),
merged_flags AS (
  SELECT * FROM (
    SELECT load, event_id, contract_symbol, symbol,
           unnest(string_split(unusual_activity_flags, '|')) AS flag, event_timestamp
    FROM both_loads WHERE unusual_activity_score > 0)
  QUALIFY row_number() OVER (PARTITION BY event_id, flag ORDER BY load) = 1
)"""


def _raw(body: str) -> str:
    return f"{_RAW}\n{body}"


def _enriched(body: str) -> str:
    return f"{_ENRICHED}\n{body}"


def _replay(body: str) -> str:
    return f"{_REPLAY}\n{body}"


_ENRICHED_COLUMNS = """event_id, symbol, contract_symbol, expiration_date, strike, option_type,
  bid, ask, last_price, volume, open_interest, implied_volatility, delta, underlying_price,
  event_timestamp, source, unusual_activity_flags, unusual_activity_score,
  volume_open_interest_ratio"""

_IV_SUM = "CAST(SUM(CAST(round(implied_volatility * 10000) AS BIGINT)) AS BIGINT)"
_MEAN_IV = f"CAST((2 * {_IV_SUM} + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10000"
_UNUSUAL = "COUNT(*) FILTER (WHERE unusual_activity_score > 0)"


def _summary(keys: str, source: str = "typed", score: bool = True) -> str:
    mean_score = _half_up("CAST(SUM(unusual_activity_score) AS BIGINT)", "COUNT(*)")
    return f"""SELECT {keys}, COUNT(*) AS total_events, {_UNUSUAL} AS unusual_events,
  {_half_up(_UNUSUAL, "COUNT(*)")} AS unusual_event_pct,
  CAST(SUM(volume) AS BIGINT) AS total_volume,
  {_MEAN_IV} AS avg_implied_volatility
  {f", {mean_score} AS avg_unusual_activity_score" if score else ""}
FROM {source} GROUP BY ALL"""


_CONTRACT_COLUMNS = """contract_symbol, symbol, option_type, strike, expiration_date, volume,
  open_interest, volume_open_interest_ratio, implied_volatility, unusual_activity_score"""
_TOP = """FROM typed WHERE unusual_activity_score > 0
ORDER BY unusual_activity_score DESC, volume DESC,
  COALESCE(volume_open_interest_ratio, 0) DESC, event_id
LIMIT 25"""
_RATIO_TOP = """FROM typed WHERE volume_open_interest_ratio IS NOT NULL
ORDER BY volume_open_interest_ratio DESC, volume DESC, event_id LIMIT 25"""

_QUARANTINE = "SELECT event_id, validation_errors FROM checked WHERE validation_errors <> ''"
_FLAG_COUNTS = "SELECT flag, COUNT(*) AS {name} FROM activity GROUP BY flag"
_CONTRACTS = """SELECT contract_symbol, symbol, option_type, strike, expiration_date FROM typed
QUALIFY row_number() OVER (PARTITION BY contract_symbol ORDER BY event_timestamp, event_id) = 1"""
_ACTIVITY_TYPED = "SELECT event_id, contract_symbol, symbol, flag, event_timestamp FROM activity"
_FACTS = """SELECT event_id, contract_symbol, symbol, option_type, strike, expiration_date, bid, ask,
  last_price, volume, open_interest, volume_open_interest_ratio, implied_volatility, delta,
  underlying_price, unusual_activity_score, event_timestamp, source FROM typed"""
_DAY = "event_timestamp >= TIMESTAMP '2024-01-10' AND event_timestamp < TIMESTAMP '2024-01-11'"
_SYMBOL_SUMMARY = _summary("symbol") + " ORDER BY unusual_events DESC, total_volume DESC, symbol"
_HOURS = f"""SELECT date_trunc('hour', event_timestamp) AS event_hour, COUNT(*) AS {{name}}
FROM typed WHERE unusual_activity_score > 0 GROUP BY 1"""
_RATES = f"""SELECT date_trunc('hour', TRY_CAST(event_timestamp AS TIMESTAMP)) AS window_start, symbol,
  COUNT(*) AS events, COUNT(*) FILTER (WHERE validation_errors <> '') AS invalid,
  COUNT(*) FILTER (WHERE validation_errors = '' AND unusual_activity_score > 0) AS alerts,
  COUNT(*) FILTER (WHERE validation_errors <> '') * 1000000 // COUNT(*) AS invalid_per_million
FROM ({_ENRICHED_OF} FROM checked) GROUP BY ALL"""
_TIME = "TRY_CAST(event_timestamp AS TIMESTAMP)"


def _binned(field: str, edges: str) -> str:
    number = f"CAST((SELECT COUNT(*) FROM unnest({edges}) AS t(edge) WHERE edge <= {field}) AS VARCHAR)"
    return f"""SELECT CAST({_TIME} AS DATE) AS d, '{field}' AS field,
  CASE WHEN {field} IS NULL THEN NULL ELSE {number} END AS bin FROM checked"""


# every bin of a field on every day, so that bins which a day lacks are counted as they are
_CHECKS = f""", binned AS (
  {_binned("volume", "[0, 1, 10, 50, 100, 500, 1000, 5000, 10000, 50000]")}
  UNION ALL {_binned("open_interest", "[0, 1, 100, 500, 1000, 5000, 10000, 50000]")}
  UNION ALL {_binned("implied_volatility", "[0::DOUBLE, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0, 2.0]::DOUBLE[]")}
  UNION ALL {_binned("strike", "[0, 10, 50, 100, 200, 500, 1000]::DOUBLE[]")}
  UNION ALL SELECT CAST({_TIME} AS DATE), 'symbol', symbol FROM checked
  UNION ALL SELECT CAST({_TIME} AS DATE), 'option_type', option_type FROM checked
),
counted AS (SELECT d, field, bin, COUNT(*) AS n FROM binned WHERE d IS NOT NULL GROUP BY ALL),
grid AS (
  SELECT * FROM (SELECT DISTINCT d, field FROM counted) JOIN (SELECT DISTINCT field, bin FROM counted) USING (field)
),
sides AS (
  SELECT g.d, g.field, g.bin,
    COALESCE(SUM(c.n) FILTER (WHERE c.d = g.d), 0) AS a, COALESCE(SUM(c.n) FILTER (WHERE c.d < g.d), 0) AS b
  FROM grid g LEFT JOIN counted c ON c.field = g.field AND c.bin IS NOT DISTINCT FROM g.bin
    AND c.d <= g.d AND c.d >= g.d - 3
  GROUP BY ALL
),
totals AS (SELECT *, SUM(a) OVER (PARTITION BY d, field) AS ra, SUM(b) OVER (PARTITION BY d, field) AS rb FROM sides),
checks AS (
  SELECT d, field, CAST(ra AS BIGINT) AS rows, CAST(COALESCE(SUM(a) FILTER (WHERE bin IS NULL), 0) AS BIGINT) AS nulls,
    CAST(rb AS BIGINT) AS base_rows,
    CASE WHEN rb > 0 THEN CAST(SUM(abs(a * rb - b * ra)) * 1000000 // (2 * ra * rb) AS BIGINT) END AS distance
  FROM totals GROUP BY d, field, ra, rb
)
SELECT strftime(d, '%Y-%m-%d') AS event_date, field, rows, nulls, nulls * 1000000 // rows AS nulls_per_million,
  base_rows, distance AS distance_per_million,
  COALESCE(distance >= 100000 AND rows >= 20 AND base_rows >= 20, FALSE) AS drifted
FROM checks"""
_CORRECTED = """, corrected AS (
  SELECT event_id, contract_symbol, CASE WHEN volume % 10 = 7 THEN volume + 1000 ELSE volume END AS volume,
    strftime(CASE WHEN volume % 10 = 3 THEN event_day + 1 ELSE event_day END, '%Y-%m-%d') AS event_date
  FROM typed WHERE volume % 10 <> 5
)"""
_STATUS = """'event_id=' || event_id || ' symbol=' || COALESCE(symbol, 'None') || ' status='
  || CASE WHEN validation_errors = '' THEN 'valid' ELSE 'invalid' END
  || ' unusual_activity_score=' || CASE WHEN validation_errors = ''
       THEN CAST(unusual_activity_score AS VARCHAR) ELSE '0' END
  || ' flags=' || CASE WHEN validation_errors = '' AND unusual_activity_flags <> ''
       THEN unusual_activity_flags ELSE 'NONE' END AS status_line"""


def _baseline(keys: list[str], days: int, min_events: int, limit: float) -> str:
    """Every event joined with the events of its key in the days before, and summed up."""
    names = ", ".join(keys)
    same = " AND ".join(f"past.{key} = days.{key}" for key in keys)
    exact = "CAST({} AS HUGEINT)"
    spread = f"({exact.format('base_n')} * squares - total * total)"
    above = f"({exact.format('base_n')} * volume - total)"
    return f""", days AS (SELECT DISTINCT {names}, event_day FROM typed),
history AS (
  SELECT {", ".join(f"days.{key}" for key in keys)}, days.event_day, COUNT(past.event_id) AS base_n,
    CAST(SUM(past.volume) AS HUGEINT) AS total,
    CAST(SUM(CAST(past.volume AS BIGINT) * past.volume) AS HUGEINT) AS squares
  FROM days LEFT JOIN typed past ON {same} AND past.event_day < days.event_day
    AND past.event_day >= days.event_day - {days}
  GROUP BY ALL
),
scored AS (
  SELECT event_id, base_n, {spread} AS spread, {above} AS above,
    CASE WHEN {spread} > 0 THEN floor(
      CAST({above} AS DOUBLE) / sqrt(CAST({spread} AS DOUBLE)) * 10000 + 0.5) / 10000 END AS z_score
  FROM typed JOIN history USING ({names}, event_day)
)
SELECT event_id, base_n, z_score, COALESCE(base_n >= {min_events} AND
  CASE WHEN spread = 0 THEN above > 0 ELSE z_score >= {limit} END, FALSE) AS above_baseline
FROM scored"""


ORACLE_SQL: dict[str, str] = {
    # validation and enrichment
    "validation_errors": _raw("SELECT event_id, validation_errors FROM checked"),
    "validation_error_counts": _raw(
        """SELECT error, COUNT(*) AS events FROM (
  SELECT unnest(string_split(validation_errors, ';')) AS error
  FROM checked WHERE validation_errors <> '') GROUP BY error"""
    ),
    "validity": _raw("SELECT event_id, validation_errors = '' AS is_valid FROM checked"),
    "quarantine": _raw(_QUARANTINE),
    "columnar_quarantine": _raw(_QUARANTINE),
    "enrich": _enriched(f"SELECT {_ENRICHED_COLUMNS} FROM enriched"),
    "typed_events": _enriched(
        """SELECT event_id, event_timestamp, expiration_date,
  strftime(event_day, '%Y-%m-%d') AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour, volume, open_interest,
  implied_volatility, unusual_activity_score, volume_open_interest_ratio, underlying_price, strike
FROM typed"""
    ),
    "event_log_lines": _raw(
        f""", scored AS ({_ENRICHED_OF} FROM checked)
SELECT event_id,
  'event_id=' || event_id || ' symbol=' || COALESCE(symbol, 'None') || ' contract_symbol='
  || contract_symbol || ' volume=' || volume || ' open_interest=' || open_interest
  || ' implied_volatility=' || CAST(implied_volatility AS VARCHAR) AS event_line,
  {_STATUS}
FROM scored"""
    ),
    "run_metrics": _enriched(
        """SELECT 'records_read' AS metric, COUNT(*) AS value FROM checked
UNION ALL SELECT 'valid_records', COUNT(*) FROM checked WHERE validation_errors = ''
UNION ALL SELECT 'invalid_records', COUNT(*) FROM checked WHERE validation_errors <> ''
UNION ALL SELECT 'unusual_records', COUNT(*) FROM enriched WHERE unusual_activity_score > 0"""
    ),
    "flags_text": _enriched(
        """SELECT event_id, CASE WHEN unusual_activity_flags = '' THEN 'NONE'
  ELSE unusual_activity_flags END AS flags FROM enriched"""
    ),
    # reports and marts
    "symbol_summary": _enriched(_SYMBOL_SUMMARY),
    "flag_distribution": _enriched(_FLAG_COUNTS.format(name='"count"')),
    "option_type_summary": _enriched(_summary("option_type") + " ORDER BY option_type"),
    "top_unusual_contracts_report": _enriched(
        f"SELECT {_CONTRACT_COLUMNS}, unusual_activity_flags {_TOP}"
    ),
    "unusual_events": _enriched(
        f"""SELECT {_ENRICHED_COLUMNS}, strftime(event_day, '%Y-%m-%d') AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour
FROM typed WHERE unusual_activity_score > 0"""
    ),
    "symbol_daily_summary": _enriched(
        f"""SELECT * REPLACE (strftime(event_date, '%Y-%m-%d') AS event_date)
FROM ({_summary("symbol, event_day AS event_date")})"""
    ),
    "csv_reports": _enriched(_SYMBOL_SUMMARY),
    "report_rows": _enriched(
        """SELECT 'flag_distribution' AS report, COUNT(DISTINCT flag) AS rows FROM activity
UNION ALL SELECT 'option_type_summary', COUNT(DISTINCT option_type) FROM typed
UNION ALL SELECT 'symbol_summary', COUNT(DISTINCT symbol) FROM typed
UNION ALL SELECT 'top_unusual_contracts', least(25, COUNT(*)) FROM typed
  WHERE unusual_activity_score > 0"""
    ),
    "mart_rows": _enriched(
        """SELECT 'flag_summary' AS mart, COUNT(DISTINCT flag) AS rows FROM activity
UNION ALL SELECT 'option_type_summary', COUNT(DISTINCT option_type) FROM typed
UNION ALL SELECT 'symbol_daily_summary', COUNT(*) FROM
  (SELECT DISTINCT symbol, event_day FROM typed)
UNION ALL SELECT 'unusual_events', COUNT(*) FROM typed WHERE unusual_activity_score > 0"""
    ),
    "batch_layer": _enriched(f"SELECT {_ENRICHED_COLUMNS} FROM enriched"),
    "json_roundtrip": _enriched(f"SELECT {_ENRICHED_COLUMNS} FROM enriched"),
    "parquet_roundtrip": _enriched(f"SELECT {_ENRICHED_COLUMNS} FROM enriched"),
    # warehouse
    "distinct_symbols": _enriched("SELECT DISTINCT symbol FROM enriched"),
    "unique_contracts": _enriched(_CONTRACTS),
    "unusual_activity_rows": _enriched(
        """SELECT event_id, contract_symbol, symbol,
  unnest(string_split(unusual_activity_flags, '|')) AS flag, event_timestamp
FROM enriched WHERE unusual_activity_score > 0"""
    ),
    "dim_symbol": _enriched("SELECT DISTINCT symbol FROM enriched"),
    "dim_option_contract": _enriched(_CONTRACTS),
    "fact_options_event": _enriched(_FACTS),
    "fact_unusual_activity": _enriched(_ACTIVITY_TYPED),
    "dirty_error_counts": f"""{_DIRTY}
SELECT validation_errors, COUNT(*) AS lines FROM dirty WHERE validation_errors <> '' GROUP BY validation_errors""",
    "dirty_quarantine": f"""{_DIRTY}
SELECT event_id, validation_errors FROM dirty WHERE validation_errors NOT IN ('', 'malformed JSON')""",
    "dirty_typed_events": f"""{_DIRTY}
SELECT event_id, event_timestamp, strftime(event_timestamp, '%Y-%m-%d') AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour, volume, strike, source FROM dirty_typed""",
    "dirty_facts": f"""{_DIRTY}
SELECT event_id, contract_symbol, volume, strike, event_timestamp, source FROM dirty_typed
WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY e) = 1""",
    "dirty_rejects": f"""{_DIRTY}
SELECT event_id, 'source does not fit fact_options_event' AS reasons FROM dirty_typed WHERE source IS NULL""",
    "contracts_in_input_order": _enriched(
        """SELECT contract_symbol, symbol, option_type, strike + e % 7 AS strike, expiration_date
FROM enriched QUALIFY row_number() OVER (PARTITION BY contract_symbol ORDER BY e DESC) = 1"""
    ),
    "warehouse_merge_events": _replay(
        """SELECT event_id, contract_symbol, volume, strike, unusual_activity_score
FROM merged_events"""
    ),
    "warehouse_merge_contracts": _replay(
        """SELECT contract_symbol, symbol, option_type, strike, expiration_date
FROM merged_contracts"""
    ),
    "warehouse_merge_flags": _replay(
        "SELECT event_id, contract_symbol, symbol, flag, event_timestamp FROM merged_flags"
    ),
    "warehouse_insert_counts": _replay(
        """, first_symbols AS (
  SELECT symbol, MIN(load) AS load FROM both_loads GROUP BY symbol
),
rows_by_load AS (
  SELECT load, 'dim_symbol' AS table_name FROM first_symbols
  UNION ALL SELECT load, 'dim_option_contract' FROM merged_contracts
  UNION ALL SELECT load, 'fact_options_event' FROM merged_events
  UNION ALL SELECT load, 'fact_unusual_activity' FROM merged_flags
),
grid AS (
  SELECT l.load, t.table_name FROM (VALUES (1), (2), (3)) AS l(load),
    (VALUES ('dim_symbol'), ('dim_option_contract'), ('fact_options_event'),
            ('fact_unusual_activity')) AS t(table_name)
)
SELECT 'load' || g.load AS load, g.table_name, COUNT(r.load) AS rows_inserted
FROM grid g LEFT JOIN rows_by_load r ON r.load = g.load AND r.table_name = g.table_name
GROUP BY ALL"""
    ),
    "events_of_a_day": _enriched(f"{_FACTS} WHERE {_DAY}"),
    "flags_of_a_day": _enriched(f"{_ACTIVITY_TYPED} WHERE {_DAY}"),
    "concurrent_load_events": _replay(
        """, raced AS (
  SELECT * FROM both_loads
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY load DESC) = 1
)
SELECT event_id, contract_symbol, volume, strike, CASE load WHEN 1 THEN 'slow' ELSE 'quick' END AS load_id
FROM raced"""
    ),
    "concurrent_load_contracts": _replay(
        """SELECT contract_symbol, symbol, option_type, strike, expiration_date FROM both_loads
QUALIFY row_number() OVER (PARTITION BY contract_symbol
                           ORDER BY load DESC, event_timestamp, event_id) = 1"""
    ),
    "concurrent_load_flags": _replay(
        """SELECT event_id, contract_symbol, symbol, flag, event_timestamp FROM (
  SELECT load, event_id, contract_symbol, symbol,
         unnest(string_split(unusual_activity_flags, '|')) AS flag, event_timestamp
  FROM both_loads WHERE unusual_activity_score > 0)
QUALIFY row_number() OVER (PARTITION BY event_id, flag ORDER BY load DESC) = 1"""
    ),
    # analytics
    "symbol_activity": _enriched(_SYMBOL_SUMMARY),
    "unusual_count_by_symbol": _enriched(
        """SELECT symbol, COUNT(*) AS unusual_event_count FROM typed
WHERE unusual_activity_score > 0 GROUP BY symbol"""
    ),
    "flag_distribution_fact": _enriched(_FLAG_COUNTS.format(name="flag_count")),
    "call_put_activity": _enriched(_summary("option_type", score=False)),
    "call_put_unusual": _enriched(
        """SELECT option_type, COUNT(*) AS unusual_event_count,
  CAST(SUM(volume) AS BIGINT) AS total_volume
FROM typed WHERE unusual_activity_score > 0 GROUP BY option_type"""
    ),
    "avg_iv_by_symbol": _enriched(
        f"SELECT symbol, {_MEAN_IV} AS avg_implied_volatility FROM typed GROUP BY symbol"
    ),
    "intraday_unusual": _enriched(_HOURS.format(name="unusual_events")),
    "intraday_unusual_script": _enriched(_HOURS.format(name="unusual_event_count")),
    "top_unusual_contracts": _enriched(f"SELECT {_CONTRACT_COLUMNS}, event_timestamp {_TOP}"),
    "top_unusual_contracts_script": _enriched(f"SELECT {_CONTRACT_COLUMNS} {_TOP}"),
    "highest_ratio": _enriched(
        f"""SELECT contract_symbol, symbol, option_type, volume, open_interest,
  volume_open_interest_ratio, unusual_activity_score {_RATIO_TOP}"""
    ),
    "highest_ratio_script": _enriched(
        f"""SELECT contract_symbol, symbol, volume, open_interest,
  volume_open_interest_ratio, unusual_activity_score {_RATIO_TOP}"""
    ),
    "top_symbols_by_volume": _enriched(
        f"""SELECT symbol, CAST(SUM(volume) AS BIGINT) AS total_volume, COUNT(*) AS total_events,
  {_half_up("CAST(SUM(volume) AS BIGINT)", "COUNT(*)")} AS avg_volume_per_event
FROM typed GROUP BY symbol ORDER BY total_volume DESC, total_events DESC, symbol LIMIT 25"""
    ),
    "top_symbols_by_volume_script": _enriched(
        """SELECT symbol, CAST(SUM(volume) AS BIGINT) AS total_volume
FROM typed GROUP BY symbol ORDER BY total_volume DESC, symbol LIMIT 25"""
    ),
    # history
    "contract_moments": _enriched(
        """SELECT contract_symbol, strftime(event_day, '%Y-%m-%d') AS event_date, COUNT(*) AS n,
  CAST(SUM(volume) AS BIGINT) AS total,
  CAST(SUM(CAST(volume AS BIGINT) * volume) AS BIGINT) AS squares
FROM typed GROUP BY ALL"""
    ),
    "contract_baseline": _enriched(_baseline(["contract_symbol"], 20, 3, 3.0)),
    "symbol_baseline": _enriched(_baseline(["symbol", "option_type"], 5, 10, 1.5)),
    "backfilled_events": _enriched(f"{_CORRECTED} SELECT * FROM corrected"),
    "backfilled_moments": _enriched(
        f"""{_CORRECTED} SELECT contract_symbol, event_date, COUNT(*) AS n, CAST(SUM(volume) AS BIGINT) AS total,
  CAST(SUM(CAST(volume AS BIGINT) * volume) AS BIGINT) AS squares
FROM corrected GROUP BY ALL"""
    ),
    "daily_checks": _raw(_CHECKS),
    "source_freshness": _raw(
        f"""SELECT symbol, MAX({_TIME}) AS latest,
  epoch_us(TIMESTAMP '2024-01-31' - MAX({_TIME})) // 1000000 AS age_seconds,
  COALESCE(epoch_us(TIMESTAMP '2024-01-31' - MAX({_TIME})) // 1000000 > 3600, TRUE) AS stale
FROM checked GROUP BY symbol"""
    ),
    # streaming
    "stream_route": _raw(
        f""", scored AS ({_ENRICHED_OF} FROM checked)
SELECT event_id, CASE WHEN validation_errors <> '' THEN 'invalid'
  WHEN unusual_activity_score > 0 THEN 'alert' ELSE 'normal' END AS route FROM scored"""
    ),
    "stream_alerts": _enriched(
        f"SELECT {_ENRICHED_COLUMNS} FROM enriched WHERE unusual_activity_score > 0"
    ),
    "stream_quarantine": _raw(_QUARANTINE),
    "stream_log": _raw(f""", scored AS ({_ENRICHED_OF} FROM checked)
SELECT {_STATUS} FROM scored"""),
    "compacted_alerts": _enriched(
        f"SELECT {_ENRICHED_COLUMNS} FROM enriched WHERE unusual_activity_score > 0"
    ),
    "compacted_log": _raw(f""", scored AS ({_ENRICHED_OF} FROM checked)
SELECT {_STATUS} FROM scored"""),
    "stream_quarantine_rates": _raw(_RATES),
    "quarantine_rates": _raw(_RATES),
    "quarantine_spikes": _raw(
        f""", rates AS ({_RATES}),
based AS (
  SELECT r.*, CAST(SUM(p.events) AS BIGINT) AS base_events, CAST(SUM(p.invalid) AS BIGINT) AS base_invalid
  FROM rates r JOIN rates p ON p.symbol IS NOT DISTINCT FROM r.symbol
    AND p.window_start < r.window_start AND p.window_start >= r.window_start - INTERVAL 48 HOUR
  GROUP BY ALL
)
SELECT * FROM based WHERE invalid >= 1 AND invalid * base_events >= 2 * base_invalid * events"""
    ),
    "replayed_alerts": _enriched(
        f"SELECT {_ENRICHED_COLUMNS} FROM enriched WHERE unusual_activity_score > 0"
    ),
    "distinct_alerts": _enriched(
        "SELECT event_id, epoch_us(event_timestamp) AS event_micros FROM typed WHERE unusual_activity_score > 0"
    ),
}

# what the written files hold is what the queries of the same content return
ORACLE_SQL |= {
    f"report_file_{name}": ORACLE_SQL[query]
    for name, query in {
        "top_unusual_contracts": "top_unusual_contracts_report",
        "symbol_summary": "symbol_summary",
        "flag_distribution": "flag_distribution",
        "option_type_summary": "option_type_summary",
    }.items()
}
ORACLE_SQL |= {
    f"mart_file_{name}": ORACLE_SQL[query]
    for name, query in {
        "unusual_events": "unusual_events",
        "symbol_daily_summary": "symbol_daily_summary",
        "flag_summary": "flag_distribution_fact",
        "option_type_summary": "option_type_summary",
    }.items()
}
