"""SQL that computes the same results in another way, for comparison.

Runs are found here by marking each qualifying day whose predecessor is not the day
before and summing the marks, where the library subtracts a rank from the day number.
"""

from __future__ import annotations

from checks.queries import (
    EVENT_COLD, EVENT_HEAT, ORDER_COLD, ORDER_DEAR, ORDER_HEAT, ORDER_START_YEAR, ORDER_STATION,
    PROSE_FIELDS, PROSE_KEY, PROSE_MARK, QUALITY_STATION, TEXT_COLUMNS,
)
from checks.damaged import CHUNK, KINDS
from checks.render import FILLED, HEADERLESS, REVERSED, SPARSE, STANDARD
from tempspan.rules import WaveRule
from tempspan.schema import OBSERVATION_FIELDS

EVENTS = """SELECT user_id AS station, CAST(ts AS DATE) AS day, value AS tx, value AS tn
    FROM events"""
GAPPY = """SELECT user_id AS station, event_type,
    CASE WHEN value < 3 OR value >= 4 THEN CAST(ts AS DATE) END AS day,
    CASE WHEN event_type <> 'error' THEN value END AS tx,
    CASE WHEN value > 10 THEN value END AS tn FROM events"""
ORDERS = """SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS day,
    o_totalprice AS tx, o_totalprice AS tn FROM orders"""
ORDERS_HERE = f"SELECT * FROM ({ORDERS}) WHERE station = '{ORDER_STATION}'"
# The observations that the rendered files hold.
RENDERED = """SELECT event_id, ts, event_type,
    CASE WHEN value >= 2 AND value < 3 THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS dtg,
    CASE WHEN value < 2 THEN '' ELSE CAST(user_id AS VARCHAR) END AS location,
    coalesce(event_type, '') AS name,
    event_type IN ('click', 'view', 'error', 'purchase') AS complete,
    CASE WHEN event_type = 'view' THEN 'NaN' ELSE '' END AS wet,
    CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS humid,
    value AS tx,
    CASE WHEN event_type IS NOT DISTINCT FROM 'signup' THEN NULL ELSE value END AS tn
    FROM events"""
TEXT_OBSERVATIONS = f"""SELECT location AS station,
    CASE WHEN NOT (tx >= 2 AND tx < 3) THEN CAST(ts AS DATE) END AS day, tx, tn
    FROM ({RENDERED}) WHERE location <> ''"""


def daily(source: str, paired: bool, start_year: int = 2003) -> str:
    """Daily maximum (and minimum over paired readings) per station."""
    usable = "tx IS NOT NULL AND tn IS NOT NULL" if paired else "tx IS NOT NULL"
    minimum = ", min(tn) AS tn" if paired else ""
    return f"""SELECT station, day, max(tx) AS tx{minimum} FROM ({source})
        WHERE {usable} AND year(day) >= {start_year} GROUP BY station, day"""


def periods(source: str, rule: WaveRule, start_year: int = 2003) -> str:
    """All runs of qualifying days."""
    if rule.warm:
        qualifies, extreme = f"tx >= {rule.temp_threshold}", f"tx >= {rule.extreme_temp_threshold}"
        temperature = "max(tx)"
    else:
        qualifies, extreme = f"tx < {rule.temp_threshold}", f"tn < {rule.extreme_temp_threshold}"
        temperature = "min(tn)"
    return f"""SELECT station, min(day) AS start_date, max(day) AS end_date,
        count(*) AS duration, count(*) FILTER (WHERE {extreme}) AS extreme_days,
        {temperature} AS temperature
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY station ORDER BY day) AS run
            FROM (SELECT *, CASE WHEN lag(day) OVER (PARTITION BY station ORDER BY day)
                                      = day - 1 THEN 0 ELSE 1 END AS fresh
                  FROM ({daily(source, not rule.warm, start_year)}) WHERE {qualifies}))
      GROUP BY station, run"""


def waves(source: str, rule: WaveRule, start_year: int = 2003) -> str:
    return f"""SELECT * FROM ({periods(source, rule, start_year)})
      WHERE duration >= {rule.min_duration} AND extreme_days >= {rule.extreme_days_required}"""


def result(source: str, rule: WaveRule, station: str | None, start_year: int = 2003,
           where: str = "TRUE") -> str:
    key = f"station AS {station}," if station else ""
    return f"""SELECT {key} strftime(start_date, '%d %b %Y') AS start_date_formatted,
        strftime(end_date, '%d %b %Y') AS end_date_formatted, duration,
        extreme_days AS {rule.extreme_days_column}, temperature AS {rule.temperature_column}
      FROM ({waves(source, rule, start_year)}) WHERE {where}"""


def both(source: str, hot: WaveRule, cold: WaveRule, start_year: int = 2003) -> str:
    return f"""SELECT *, 'heatwaves' AS kind FROM ({waves(source, hot, start_year)})
      UNION ALL SELECT *, 'coldwaves' AS kind FROM ({waves(source, cold, start_year)})"""


def all_runs(source: str, rule: WaveRule) -> str:
    return f"""SELECT station AS user_id,
        CAST(start_date - DATE '1970-01-01' - 1 - (
            SELECT count(*) FROM ({daily(source, not rule.warm)}) AS d
            WHERE d.station = p.station AND d.day < p.start_date AND
                  {'d.tx >= ' if rule.warm else 'd.tx < '}{rule.temp_threshold}) AS INTEGER)
          AS group_id,
        start_date, end_date, duration, extreme_days,
        temperature AS {rule.temperature_column}
      FROM ({periods(source, rule)}) AS p"""


DOCUMENT_LINES = """SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no,
      unnest(parts) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""
DOCUMENT_HEADERS = f"""SELECT doc_id, list_filter(string_split(text, chr(10)),
      lambda l: starts_with(l, '{PROSE_MARK}') AND contains(l, '{PROSE_KEY}'))[1] AS header
    FROM documents"""
FIELD_LIST = ", ".join(f"'{f}'" for f in PROSE_FIELDS)

SUMMARY = f"""SELECT kind, CAST(year(start_date) AS INTEGER) AS year, count(*) AS count,
      CASE WHEN kind = 'heatwaves' THEN max(temperature) ELSE min(temperature) END
        AS extreme_temperature
    FROM ({both(ORDERS, ORDER_HEAT, ORDER_COLD, ORDER_START_YEAR)})
    GROUP BY kind, year(start_date)"""


def yearly(rule: WaveRule) -> str:
    pick = "max" if rule.warm else "min"
    return f"""SELECT CAST(year(start_date) AS INTEGER) AS year, count(*) AS count,
        {pick}(temperature) AS {rule.temperature_column}
      FROM ({waves(ORDERS, rule, ORDER_START_YEAR)}) GROUP BY 1"""


def json_object(rule: WaveRule) -> str:
    return f"""(SELECT coalesce('{{' || string_agg('"' || year || '":{{"count":' || count ||
        ',"{rule.temperature_column}":' || extreme_temperature || '}}', ',' ORDER BY
        CAST(year AS VARCHAR)) || '}}', '{{}}') FROM ({SUMMARY}) WHERE kind = '{rule.kind}')"""


VIEW = f"event_type = '{QUALITY_STATION}'"
QUALITY_REPORT = f"""
    WITH here AS (SELECT * FROM ({GAPPY}) WHERE {VIEW}),
    t AS (SELECT count(*) AS n FROM events), h AS (SELECT count(*) AS n FROM here)
    SELECT 'Total Records' AS metric, n AS count, NULL::DOUBLE AS percentage,
        NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS avg FROM t
    UNION ALL SELECT 'View Station Records', h.n, round(100.0 * h.n / t.n, 6), NULL, NULL, NULL
        FROM h, t
    UNION ALL SELECT 'event_type - Null Values', 0, 0, NULL, NULL, NULL
    UNION ALL SELECT 'tx - Null Values', count(*) - count(tx),
        round(100.0 * (count(*) - count(tx)) / count(*), 6), NULL, NULL, NULL FROM here
    UNION ALL SELECT 'tx - Statistics', NULL, NULL, min(tx), max(tx), round(avg(tx), 6) FROM here
    UNION ALL SELECT 'tn - Null Values', count(*) - count(tn),
        round(100.0 * (count(*) - count(tn)) / count(*), 6), NULL, NULL, NULL FROM here
    UNION ALL SELECT 'tn - Statistics', NULL, NULL, min(tn), max(tn), round(avg(tn), 6) FROM here
    UNION ALL SELECT 'day - Null Values', count(*) - count(day),
        round(100.0 * (count(*) - count(day)) / count(*), 6), NULL, NULL, NULL FROM here"""

# The text cells of the rendered files; a field that the layout lacks is NULL.
CELLS = {
    "DTG": "dtg", "LOCATION": "location", "NAME": "name", "ALTITUDE": "CAST(event_id AS VARCHAR)",
    "T_WETB_10": "wet", "U_10": "humid", "TX_DRYB_10": "CAST(tx AS VARCHAR)",
    "TN_DRYB_10": "coalesce(CAST(tn AS VARCHAR), '')",
    **{name: f"CASE WHEN event_id % {every} <> 0 THEN CAST(event_id % {modulus} AS VARCHAR) ELSE '' END"
       for name, (modulus, every) in FILLED.items()},
}
SHORT = {name for name, _ in SPARSE}
PARSED = {
    name: CELLS[name] if name in SHORT else f"CASE WHEN complete THEN {CELLS[name]} END"
    for name in TEXT_COLUMNS
}
TYPED = {
    name: f"nullif({PARSED[name]}, '')" if kind == "string"
    else f"CASE WHEN {PARSED[name]} <> 'NaN' THEN TRY_CAST({PARSED[name]} AS DOUBLE) END"
    for name, kind in OBSERVATION_FIELDS.items()
}
TYPED_LIST = ", ".join(f"{cell} AS {name}" for name, cell in TYPED.items())


def line_of(layout: list[tuple[str, int]]) -> str:
    return " || ".join(f"rpad({CELLS[name]}, {width}, ' ')" for name, width in layout)


def folder_lines(folder: str, layout: list[tuple[str, int]], where: str) -> str:
    return f"SELECT '{folder}' AS folder, {line_of(layout)} AS value FROM ({RENDERED}) WHERE {where}"


DIRECTORY = " UNION ALL ".join([
    folder_lines("standard", STANDARD, "event_type IN ('click', 'view')"),
    folder_lines("reversed", REVERSED, "event_type IN ('error', 'purchase')"),
    folder_lines("sparse", SPARSE, "NOT complete"),
    folder_lines(HEADERLESS, STANDARD, "TRUE"),
])
THREE_KINDS = f"""{both(ORDERS, ORDER_HEAT, ORDER_COLD, ORDER_START_YEAR)}
    UNION ALL SELECT *, 'dear' AS kind FROM ({waves(ORDERS, ORDER_DEAR, ORDER_START_YEAR)})"""
THREE_SUMMARY = f"""SELECT kind, CAST(year(start_date) AS INTEGER) AS year, count(*) AS count,
      CASE WHEN kind = 'coldwaves' THEN min(temperature) ELSE max(temperature) END
        AS extreme_temperature
    FROM ({THREE_KINDS}) GROUP BY kind, year(start_date)"""

ORACLE_SQL: dict[str, str] = {
    "explode_lines": DOCUMENT_LINES,
    "header_detect": f"SELECT * FROM ({DOCUMENT_HEADERS}) WHERE header IS NOT NULL",
    "header_reject": f"SELECT doc_id FROM ({DOCUMENT_HEADERS}) WHERE header IS NULL",
    "header_offsets": f"""
        WITH h AS (SELECT * FROM ({DOCUMENT_HEADERS}) WHERE header IS NOT NULL),
        f AS (SELECT doc_id, header, field, CASE WHEN field = '{PROSE_FIELDS[0]}' THEN 1
                ELSE nullif(strpos(header, field), 0) END AS start
              FROM h, (SELECT unnest([{FIELD_LIST}]) AS field)),
        b AS (SELECT doc_id, start, lead(start) OVER (PARTITION BY doc_id ORDER BY start) AS next
              FROM (SELECT DISTINCT doc_id, start FROM f WHERE start IS NOT NULL))
        SELECT f.doc_id, field, CAST(f.start AS INTEGER) AS start,
            CAST(coalesce(next, length(header) + 1) - f.start AS INTEGER) AS length
        FROM f LEFT JOIN b ON f.doc_id = b.doc_id AND f.start = b.start""",
    "line_filter": f"""SELECT * FROM ({DOCUMENT_LINES})
        WHERE NOT starts_with(line, '{PROSE_MARK}') AND trim(line) <> ''""",
    "directory_scan": DIRECTORY,
    "fixed_width_parse": "SELECT " + ", ".join(
        f"{cell} AS {name}" for name, cell in PARSED.items()) + f" FROM ({RENDERED})",
    "typed_cast": f"SELECT {TYPED_LIST} FROM ({RENDERED})",
    "required_keys": f"SELECT {TYPED_LIST} FROM ({RENDERED}) WHERE location <> ''",
    "derive_date": f"""SELECT {TYPED_LIST},
        CASE WHEN length(dtg) > 10 THEN CAST(ts AS DATE) END AS DATE
        FROM ({RENDERED}) WHERE location <> ''""",
    "union_sources": f"""SELECT {TYPED_LIST},
            CASE WHEN length(dtg) > 10 THEN CAST(ts AS DATE) END AS DATE
        FROM ({RENDERED}) WHERE location <> ''
        UNION ALL BY NAME SELECT station AS LOCATION, day AS DATE, tx AS TX_DRYB_10,
            tn AS TN_DRYB_10 FROM ({ORDERS})""",
    "archive_lines": f"""SELECT doc_id, line FROM ({DOCUMENT_LINES})
        WHERE NOT starts_with(line, '#') AND trim(line) <> ''""",
    "station_daily_max": daily(ORDERS_HERE, False, ORDER_START_YEAR),
    "station_daily_max_min": daily(ORDERS_HERE, True, ORDER_START_YEAR),
    "daily_max": f"SELECT station AS user_id, day, tx FROM ({daily(GAPPY, False)})",
    "daily_max_min": f"SELECT station AS user_id, day, tx, tn FROM ({daily(GAPPY, True)})",
    "start_year_filter": f"""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
        WHERE year(o_orderdate) >= {ORDER_START_YEAR}""",
    "condition_flags": f"""SELECT station AS user_id, day, tx, tn,
        CAST(tx >= {EVENT_HEAT.temp_threshold} AS INTEGER) AS is_hot,
        CAST(tx >= {EVENT_HEAT.extreme_temp_threshold} AS INTEGER) AS is_tropical,
        CAST(tx < {EVENT_COLD.temp_threshold} AS INTEGER) AS is_cold,
        CAST(tn < {EVENT_COLD.extreme_temp_threshold} AS INTEGER) AS is_high_frost
        FROM ({daily(EVENTS, True)})""",
    "run_ids": f"""SELECT station AS user_id, day, tx, CAST(day - DATE '1970-01-01' -
        row_number() OVER (PARTITION BY station ORDER BY day) AS INTEGER) AS group_id
        FROM ({daily(EVENTS, False)}) WHERE tx >= {EVENT_HEAT.temp_threshold}""",
    "periods_hot": all_runs(EVENTS, EVENT_HEAT),
    "periods_cold": all_runs(EVENTS, EVENT_COLD),
    "heatwaves": result(EVENTS, EVENT_HEAT, "user_id"),
    "coldwaves": result(EVENTS, EVENT_COLD, "user_id"),
    "both_kinds": f"""SELECT station AS user_id, kind, start_date, end_date, duration,
        extreme_days, temperature AS extreme_temperature
        FROM ({both(GAPPY, EVENT_HEAT, EVENT_COLD)})""",
    "heatwaves_station": result(ORDERS_HERE, ORDER_HEAT, None, ORDER_START_YEAR),
    "coldwaves_station": result(ORDERS_HERE, ORDER_COLD, None, ORDER_START_YEAR),
    "heatwaves_by_year": result(ORDERS, ORDER_HEAT, "station", ORDER_START_YEAR,
                                "year(start_date) = 1999"),
    "coldwaves_by_year": result(ORDERS, ORDER_COLD, "station", ORDER_START_YEAR,
                                "year(start_date) = 1999"),
    "period_records": f"""SELECT '{{"station":"' || station || '","From date":"' ||
        start_date_formatted || '","To date (inc.)":"' || end_date_formatted ||
        '","Duration (in days)":' || duration || ',"Number of tropical days":' || tropical_days ||
        ',"Max temperature":' || max_temperature || '}}' AS record
        FROM ({result(ORDERS, ORDER_HEAT, "station", ORDER_START_YEAR)})""",
    "summary_heatwaves": yearly(ORDER_HEAT),
    "summary_coldwaves": yearly(ORDER_COLD),
    "summary": SUMMARY,
    "summary_json": f"""SELECT '{{"heatwaves":' || {json_object(ORDER_HEAT)} ||
        ',"coldwaves":' || {json_object(ORDER_COLD)} || '}}' AS summary""",
    "quality_counts": f"""SELECT count(*) AS total, count(*) FILTER (WHERE {VIEW}) AS station
        FROM events""",
    "quality_nulls": f"""SELECT count(*) FILTER (WHERE event_type IS NULL) AS station_nulls,
        count(*) FILTER (WHERE tx IS NULL) AS tx_nulls,
        count(*) FILTER (WHERE tn IS NULL) AS tn_nulls,
        count(*) FILTER (WHERE day IS NULL) AS day_nulls FROM ({GAPPY}) WHERE {VIEW}""",
    "quality_stats": f"""SELECT min(tx) AS tx_min, max(tx) AS tx_max, round(avg(tx), 6) AS tx_avg,
        min(tn) AS tn_min, max(tn) AS tn_max, round(avg(tn), 6) AS tn_avg
        FROM ({GAPPY}) WHERE {VIEW}""",
    "quality_report": QUALITY_REPORT,
    "quality_report_of_days": QUALITY_REPORT,
    "record_count": """SELECT count(*) AS observations,
        count(DISTINCT (user_id, CAST(ts AS DATE))) AS station_days FROM events""",
    "report_lines": f"""SELECT rpad(start_date_formatted, 12, ' ') || ' | ' ||
        rpad(end_date_formatted, 12, ' ') || ' | ' ||
        rpad(CAST(duration AS VARCHAR), 15, ' ') || ' | ' ||
        rpad(CAST(tropical_days AS VARCHAR), 15, ' ') || ' | ' ||
        printf('%-12.1f', round(max_temperature, 1)) AS line
        FROM ({result(EVENTS, EVENT_HEAT, None)})""",
    "csv_roundtrip": f"""SELECT CAST(station AS VARCHAR) AS LOCATION, start_date, end_date,
        duration, extreme_days AS high_frost_days, temperature AS min_temperature
        FROM ({waves(EVENTS, EVENT_COLD)})""",
    "period_store": f"""SELECT station, start_date, end_date, duration, extreme_days,
        temperature AS extreme_temperature, kind
        FROM ({both(ORDERS, ORDER_HEAT, ORDER_COLD, ORDER_START_YEAR)})""",
    "wave_job": f"""SELECT station AS LOCATION, start_date, end_date, duration, extreme_days,
        temperature AS extreme_temperature, kind
        FROM ({both(TEXT_OBSERVATIONS, EVENT_HEAT, EVENT_COLD)})""",
    "rejected_files": f"""SELECT '{HEADERLESS}' AS folder, 'no header' AS reason,
        CAST(sum(octet_length(encode(value)) + 1
          + CASE WHEN tx < 10 THEN length('# remark on ' || event_id) + 1 + 4 ELSE 0 END) AS BIGINT)
          AS bytes, 0 AS inputs
        FROM (SELECT {line_of(STANDARD)} AS value, tx, event_id FROM ({RENDERED}))
        UNION ALL SELECT folder, reason, 0, count(*) FROM
        (VALUES {", ".join(f"({i}, '{k}', '{r}')" for i, (k, r) in enumerate(KINDS.items()) if r)}) AS k(turn, folder, reason)
        JOIN (SELECT DISTINCT event_id // {CHUNK} AS chunk FROM events) ON chunk % {len(KINDS)} = turn
        GROUP BY folder, reason""",
    "input_inventory": """
        WITH lines AS (SELECT event_type AS name, octet_length(encode(concat_ws(',', event_id,
                user_id, value))) + 1 AS bytes FROM events WHERE event_type IS NOT NULL),
        kinds AS (SELECT name, CAST(sum(bytes) AS BIGINT) AS bytes FROM lines GROUP BY name)
        SELECT name, bytes, 'all' AS part FROM kinds
        UNION ALL (SELECT '', bytes, 'first' FROM kinds ORDER BY name LIMIT 2)
        UNION ALL SELECT '', CAST(sum(bytes) AS BIGINT), 'total' FROM kinds""",
    "daily_records": f"""SELECT count(*) FILTER (WHERE tx IS NOT NULL) AS heatwaves,
        count(*) FILTER (WHERE paired) AS coldwaves
        FROM (SELECT station, day, max(tx) AS tx, bool_or(tx IS NOT NULL AND tn IS NOT NULL) AS paired
              FROM ({GAPPY}) WHERE year(day) >= 2003 GROUP BY station, day)""",
    "periods_repeated_days": result(EVENTS, EVENT_HEAT, "user_id"),
    "summary_custom": f"""{THREE_SUMMARY} UNION ALL SELECT 'json', NULL, count, extreme_temperature
        FROM ({THREE_SUMMARY}) WHERE kind = 'dear' AND year = 1999""",
}
