"""SQL equivalents of the registered queries, for an independent engine.

They start from the ``events`` table and state the expected outcome of every defect kind
directly; no JSON is parsed here, so parsing itself is under test. Dialect: DuckDB.
"""

from __future__ import annotations

from telemill.sources.feed import BATCHES, DEFECTS

_DEFECT_CASE = " ".join(f"WHEN e.event_id % {n} = 0 THEN '{kind}'" for n, kind in DEFECTS)

# Payloads that are not JSON objects.
_MALFORMED = "('not_json','truncated','empty_array','empty_text','null_value','object_in_array','json_null')"
_OFFSET = "(Z|[+-][0-9]{2}:[0-9]{2})$"
_US_6H = 21_600_000_000


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(20,8)), {digits}) AS DOUBLE)"


_FEED = f"""
sent AS (
  SELECT e.event_id, c.copy_no, e.ts, e.event_type, e.value,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
         CAST(e.user_id % 10 AS VARCHAR) AS unit,
         CAST(regexp_extract(e.props, '"k": *([0-9.]+)', 1) AS DOUBLE) AS charge,
         CASE {_DEFECT_CASE} ELSE '' END AS defect
  FROM events e, LATERAL (SELECT unnest(CASE WHEN e.event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy_no) c
),
feed AS (
  SELECT event_id, event_id * 2 + copy_no AS "offset", event_id % {BATCHES} AS batch_id, ts AS kafka_timestamp,
    iso, ts, defect,
    CASE WHEN defect = 'numeric_id' THEN '42' WHEN defect = 'absent_id' THEN NULL
         WHEN defect = 'tab_id' THEN chr(9) || 'BMW-' || unit
         WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'CAR-' || unit
         WHEN event_id % 2 = 0 THEN ' BMW-' || unit || ' '
         ELSE ' bmw-' || unit || ' ' END AS vehicle_id,
    CASE WHEN event_id % 101 = 0 THEN 'not-a-date' WHEN event_id % 103 = 0 THEN iso
         WHEN defect = 'basic_offset' THEN iso || '+0000' WHEN defect = 'time_only' THEN '10:30:00Z'
         WHEN defect = 'east_offset' THEN iso || '+02:00' ELSE iso || 'Z' END AS stamp,
    value + CASE WHEN copy_no = 1 AND event_id % 20 = 0 THEN 1.0 ELSE 0.0 END AS speed,
    CASE WHEN defect = 'null_battery' THEN NULL WHEN event_id % 107 = 0 THEN 120.0 ELSE charge END AS battery_level,
    CASE WHEN defect = 'absent_temperature' THEN NULL WHEN defect = 'nan_temperature' THEN 'nan'::DOUBLE
         ELSE CAST(event_id % 150 - 25 AS DOUBLE) END AS temperature,
    CASE WHEN defect = 'null_fault' THEN NULL WHEN defect = 'alias_fault' THEN 'temphigh'
         WHEN event_type = 'view' THEN 'none' WHEN event_type = 'signup' THEN 'NONE'
         WHEN event_type = 'click' THEN 'temp-high' WHEN event_type = 'error' THEN ' Engine_Fault '
         WHEN event_id % 5 = 0 THEN 'overheat' ELSE 'battery_low' END AS fault_code
  FROM sent
),
whole AS (
  SELECT *,
    '{{' || CASE WHEN defect = 'absent_id' THEN '' WHEN defect = 'numeric_id' THEN '"vehicle_id": 42, '
                ELSE '"vehicle_id": "' || replace(vehicle_id, chr(9), '\\t') || '", ' END
    || '"timestamp": "' || stamp || '", "speed": '
    || CASE WHEN defect = 'quoted_speed' THEN '"' || speed || '"' WHEN defect = 'text_speed' THEN '"fast"'
            ELSE CAST(speed AS VARCHAR) END
    || ', "battery_level": ' || coalesce(CAST(battery_level AS VARCHAR), 'null') || ', '
    || CASE WHEN defect = 'absent_temperature' THEN '' WHEN defect = 'nan_temperature' THEN '"temperature": NaN, '
            ELSE '"temperature": ' || temperature || ', ' END
    || '"fault_code": ' || coalesce('"' || fault_code || '"', 'null') || '}}' AS body
  FROM feed
),
payloads AS (
  SELECT *,
    CASE defect WHEN 'not_json' THEN 'not json'
         WHEN 'truncated' THEN '{{"vehicle_id": "' || vehicle_id || '", "speed":'
         WHEN 'empty_array' THEN '[]' WHEN 'empty_object' THEN '{{}}' WHEN 'empty_text' THEN ''
         WHEN 'null_value' THEN NULL WHEN 'object_in_array' THEN '[' || body || ']'
         WHEN 'json_null' THEN 'null' WHEN 'trailing_text' THEN body || ' trailing' ELSE body END AS json_payload,
    defect IN {_MALFORMED} AS malformed,
    defect IN {_MALFORMED} OR defect = 'empty_object' AS hollow
  FROM whole
),
parsed AS (
  SELECT event_id, "offset", batch_id, kafka_timestamp, json_payload, defect, malformed, hollow, iso, ts,
    CASE WHEN NOT hollow THEN vehicle_id END AS vehicle_id,
    CASE WHEN NOT hollow THEN stamp END AS stamp,
    CASE WHEN NOT hollow AND defect NOT IN ('quoted_speed', 'text_speed') THEN speed END AS speed,
    CASE WHEN NOT hollow AND defect = 'text_speed' THEN 'fast'
         WHEN NOT hollow THEN CAST(speed AS VARCHAR) END AS speed_text,
    CASE WHEN NOT hollow THEN battery_level END AS battery_level,
    CASE WHEN NOT hollow THEN temperature END AS temperature,
    CASE WHEN NOT hollow THEN fault_code END AS fault_code
  FROM payloads
),
strict AS (
  SELECT * REPLACE (upper(trim(vehicle_id, ' ')) AS vehicle_id,
                    upper(replace(trim(fault_code, ' '), '-', '_')) AS fault_code),
    vehicle_id AS raw_id, fault_code AS raw_code,
    CASE WHEN stamp IN ('not-a-date', '10:30:00Z') OR stamp IS NULL THEN NULL
         WHEN stamp LIKE '%+02:00' THEN ts - INTERVAL 2 HOUR ELSE ts END AS event_timestamp
  FROM parsed
),
judged AS (
  SELECT *, coalesce(regexp_full_match(vehicle_id, 'BMW-[A-Z0-9-]+') AND event_timestamp IS NOT NULL
      AND regexp_matches(stamp, '{_OFFSET}') AND speed BETWEEN 0 AND 250 AND battery_level BETWEEN 0 AND 100
      AND temperature BETWEEN -20 AND 120 AND fault_code IN ('NONE', 'TEMP_HIGH', 'BATTERY_LOW', 'ENGINE_FAULT'),
      false) AS ok
  FROM strict
)"""

_FIRST = """,
first_seen AS (
  SELECT * FROM judged WHERE ok
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_timestamp ORDER BY "offset") = 1
)"""


def _kpis(us: int) -> str:
    start = f"make_timestamp(epoch_us(event_timestamp) // {us} * {us})"
    return f"""{_FEED}{_FIRST},
kpis AS (
  SELECT vehicle_id, {start} AS window_start, {start} + to_microseconds({us}) AS window_end,
    avg(speed) AS average_speed, avg(battery_level) AS average_battery_level, max(temperature) AS maximum_temperature,
    CAST(count(*) FILTER (fault_code <> 'NONE') AS BIGINT) AS fault_count, count(*) AS event_count
  FROM first_seen GROUP BY ALL
)"""


_START = f"make_timestamp(epoch_us(event_timestamp) // {_US_6H} * {_US_6H})"
_CHANGELOG = f"""{_FEED}{_FIRST},
touched AS (
  SELECT DISTINCT vehicle_id, {_START} AS window_start, batch_id FROM first_seen
),
changelog AS (
  SELECT t.vehicle_id, t.window_start, t.window_start + to_microseconds({_US_6H}) AS window_end,
    avg(f.speed) AS average_speed, avg(f.battery_level) AS average_battery_level,
    max(f.temperature) AS maximum_temperature,
    CAST(count(*) FILTER (f.fault_code <> 'NONE') AS BIGINT) AS fault_count, count(*) AS event_count, t.batch_id
  FROM touched t JOIN first_seen f ON f.vehicle_id = t.vehicle_id
    AND make_timestamp(epoch_us(f.event_timestamp) // {_US_6H} * {_US_6H}) = t.window_start
    AND f.batch_id <= t.batch_id
  GROUP BY ALL
)"""
_STATE = f"""{_CHANGELOG},
state AS (
  SELECT * FROM changelog
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, window_start ORDER BY batch_id DESC) = 1
)"""

_KPI_COLUMNS = (
    f"vehicle_id, window_start, window_end, {_r('average_speed', 6)} AS average_speed, "
    f"{_r('average_battery_level', 6)} AS average_battery_level, maximum_temperature, fault_count, event_count"
)

# Lenient path: white space of any kind goes, measures are read from text.
_LENIENT = f"""{_FEED},
texts AS (
  SELECT *, coalesce(regexp_replace(vehicle_id, '^\\s+|\\s+$', '', 'g'), '') AS id_trimmed,
    regexp_replace(fault_code, '^\\s+|\\s+$', '', 'g') AS code_trimmed,
    try_cast(speed_text AS DOUBLE) AS speed_number
  FROM parsed
),
messages AS (
  SELECT *,
    CASE WHEN malformed THEN ['malformed_json']
         WHEN defect = 'empty_object' THEN ['Missing required field: timestamp', 'Missing required field: speed',
              'Missing required field: battery_level', 'Missing required field: temperature',
              'Missing required field: fault_code']
         WHEN defect = 'absent_temperature' THEN ['Missing required field: temperature']
         ELSE list_filter([
           CASE WHEN id_trimmed = '' THEN 'vehicle_id is null or empty'
                WHEN NOT regexp_full_match(id_trimmed, 'BMW-[A-Za-z0-9-]+') THEN 'vehicle_id has an invalid format' END,
           CASE WHEN stamp IN ('not-a-date', '10:30:00Z') THEN 'timestamp is not a valid ISO-8601 datetime'
                WHEN stamp = iso THEN 'timestamp must include timezone information' END,
           CASE WHEN speed_number IS NULL THEN 'speed is not numeric'
                WHEN NOT speed_number BETWEEN 0 AND 250 THEN 'speed is out of expected range 0..250' END,
           CASE WHEN battery_level IS NULL THEN 'battery_level is not numeric'
                WHEN NOT battery_level BETWEEN 0 AND 100 THEN 'battery_level is out of expected range 0..100' END,
           CASE WHEN temperature IS NULL THEN 'temperature is not numeric'
                WHEN NOT temperature BETWEEN -20 AND 120 THEN 'temperature is out of expected range -20..120' END,
           CASE WHEN coalesce(upper(code_trimmed) NOT IN ('NONE', 'TEMP_HIGH', 'BATTERY_LOW', 'ENGINE_FAULT'), true)
                THEN 'fault_code is invalid' END
         ], lambda m: m IS NOT NULL) END AS errors
  FROM texts
)"""

_ISO_TEXT = """CASE WHEN stamp IS NULL OR stamp IN ('not-a-date', '10:30:00Z') THEN NULL
  WHEN stamp = iso THEN {iso} WHEN stamp LIKE '%+02:00' THEN {iso} || '+02:00' ELSE {iso} || '+00:00' END""".format(
    iso="CASE WHEN iso LIKE '%.000000' THEN left(iso, 19) ELSE iso END"
)
_ALIAS = """CASE WHEN fault_code IS NULL THEN 'NONE'
  WHEN upper(trim(fault_code)) = 'TEMPHIGH' THEN 'TEMP_HIGH'
  ELSE upper(replace(trim(fault_code), '-', '_')) END"""
_NO_NAN = "CASE WHEN isnan(temperature) THEN NULL ELSE temperature END AS temperature"
_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def _text(c: str) -> str:
    return f"{_TEXT.format(c=c)} AS {c}"


def _text_of(expr: str, name: str) -> str:
    return f"{_TEXT.format(c=expr)} AS {name}"


_SERVED = f"vehicle_id, {_text('window_start')}, {_text('window_end')}, " + _KPI_COLUMNS.split("window_end, ", 1)[1]

_VALID_COLUMNS = """event_id, "offset", vehicle_id, stamp AS "timestamp", speed, battery_level, temperature,
  fault_code, json_payload, kafka_timestamp, event_timestamp"""

_BATTERY = "coalesce(nullif(average_battery_level, 0), 100)"

_BODIES: dict[str, tuple[str, str]] = {
    # sources and sinks
    "kafka_encode": (
        _FEED,
        f"""SELECT coalesce(vehicle_id, 'unknown') AS message_key, vehicle_id, stamp AS "timestamp", speed,
            battery_level, {_NO_NAN}, fault_code FROM feed""",
    ),
    "raw_json_sink": (
        _FEED,
        "SELECT json_payload, kafka_timestamp, '2024-02-01' AS date, batch_id FROM payloads",
    ),
    "curated_parquet_sink": (_CHANGELOG, f"SELECT {_KPI_COLUMNS}, '2024-02-01' AS date, batch_id FROM changelog"),
    "json_batch_sink": (_STATE, f"SELECT {_KPI_COLUMNS}, batch_id FROM state"),
    "curated_table": (
        _CHANGELOG,
        "SELECT DISTINCT 'date=' || strftime(window_start, '%Y-%m-%d') || '/batch_id=' || batch_id AS partition "
        "FROM changelog",
    ),
    "curated_scan": (
        _CHANGELOG,
        "SELECT vehicle_id, window_start, event_count, strftime(window_start, '%Y-%m-%d') AS date, batch_id "
        "FROM changelog",
    ),
    "changelog_text_scan": (_STATE, f"SELECT {_KPI_COLUMNS}, batch_id FROM state"),
    "table_append_sink": (_STATE, f"SELECT {_KPI_COLUMNS} FROM state"),
    "table_append_replayed": (_CHANGELOG, f"SELECT {_KPI_COLUMNS}, batch_id FROM changelog"),
    "metrics_by_batch": (
        _CHANGELOG,
        """, received AS (SELECT batch_id, count(*) AS n, count(*) FILTER (NOT ok) AS bad FROM judged GROUP BY 1),
           emitted AS (SELECT batch_id, count(*) AS n FROM changelog GROUP BY 1)
        SELECT r.batch_id, m.metric, CAST(m.value AS DOUBLE) AS value, 'Count' AS unit
        FROM received r JOIN emitted e USING (batch_id), LATERAL (
          SELECT 'BatchesProcessed' AS metric, 1 AS value UNION ALL SELECT 'RecordsProcessed', r.n
          UNION ALL SELECT 'AggregatedRecords', e.n UNION ALL SELECT 'InvalidRecords', r.bad
          UNION ALL SELECT 'PipelineErrors', 0) m""",
    ),
    # projections and scalar functions
    "decode_payload": (_FEED, 'SELECT event_id, "offset", json_payload, kafka_timestamp FROM payloads'),
    "parse_json": (
        _FEED,
        f"""SELECT event_id, "offset", vehicle_id, stamp AS "timestamp", speed, battery_level, {_NO_NAN}, fault_code
            FROM parsed""",
    ),
    "flatten_event": (
        _FEED,
        f"""SELECT json_payload, kafka_timestamp, event_id, "offset", vehicle_id, stamp AS "timestamp", speed,
            battery_level, {_NO_NAN}, fault_code FROM parsed""",
    ),
    "normalize_vehicle_id": (
        _FEED,
        """SELECT event_id, "offset", upper(trim(vehicle_id, ' ')) AS vehicle_id,
           upper(trim(vehicle_id, ' ' || chr(9))) AS vehicle_id_lenient FROM parsed""",
    ),
    "normalize_fault_code": (
        _FEED,
        f"""SELECT event_id, "offset", upper(replace(trim(fault_code), '-', '_')) AS fault_code,
            {_ALIAS} AS fault_code_alias FROM parsed""",
    ),
    "parse_event_time": (
        _FEED,
        f'SELECT event_id, "offset", event_timestamp, {_ISO_TEXT} AS iso_timestamp FROM strict',
    ),
    "coerce_numeric": (
        _LENIENT,
        """SELECT event_id, "offset", CASE WHEN defect = 'empty_object' THEN 0.0 ELSE speed_number END AS speed,
           CASE WHEN defect = 'empty_object' THEN 0.0 ELSE battery_level END AS battery_level,
           CASE WHEN defect IN ('empty_object', 'absent_temperature') THEN 0.0
                WHEN NOT isnan(temperature) THEN temperature END AS temperature
           FROM texts WHERE NOT malformed""",
    ),
    "normalize_events": (
        _LENIENT,
        f"""SELECT event_id, "offset", upper(id_trimmed) AS vehicle_id, {_ISO_TEXT} AS "timestamp",
           CASE WHEN defect = 'empty_object' THEN 0.0 ELSE speed_number END AS speed,
           CASE WHEN defect = 'empty_object' THEN 0.0 ELSE battery_level END AS battery_level,
           CASE WHEN defect IN ('empty_object', 'absent_temperature') THEN 0.0
                WHEN NOT isnan(temperature) THEN temperature END AS temperature,
           {_ALIAS} AS fault_code,
           CASE WHEN stamp IS NULL OR stamp IN ('not-a-date', '10:30:00Z') THEN 'timestamp'
                WHEN speed_number IS NULL THEN 'speed' WHEN battery_level IS NULL THEN 'battery_level'
                END AS normalize_error
           FROM texts WHERE NOT malformed""",
    ),
    "light_trim": (
        _LENIENT,
        'SELECT event_id, "offset", id_trimmed AS vehicle_id, code_trimmed AS fault_code FROM texts',
    ),
    "typed_projection": (
        _STATE,
        f"""SELECT CASE WHEN event_count % 7 <> 0 THEN vehicle_id ELSE '' END AS vehicle_id,
            {_text('window_start')},
            CASE WHEN fault_count > 0 THEN {_TEXT.format(c='window_end')} ELSE '' END AS window_end,
            CASE WHEN event_count % 5 <> 0 THEN {_r('average_speed', 2)} ELSE 0.0 END AS average_speed,
            CASE WHEN fault_count % 4 = 3 THEN 0.0 ELSE {_r('average_battery_level', 2)} END AS average_battery_level,
            maximum_temperature, fault_count, CASE WHEN event_count % 6 = 0 THEN 0 ELSE event_count END AS event_count
            FROM state""",
    ),
    "flatten_window": (
        _kpis(3_600_000_000),
        "SELECT vehicle_id, window_start, window_end, event_count FROM kpis",
    ),
    "round_2": (
        _STATE,
        f"""SELECT vehicle_id, window_start, {_r('average_speed', 2)} AS speed_2dp,
            {_r('average_battery_level', 2)} AS battery_2dp, {_r('maximum_temperature', 2)} AS temperature_2dp
            FROM state""",
    ),
    "timestamp_to_string": (
        _STATE,
        f"SELECT vehicle_id, {_text('window_start')}, {_text('window_end')} FROM state",
    ),
    "fault_rate_pct": (
        _STATE,
        f"""SELECT vehicle_id, window_start,
            {_r('100.0 * fault_count / nullif(event_count, 0)::DOUBLE', 1)} AS rate_1dp,
            {_r('100.0 * fault_count / nullif(event_count, 0)::DOUBLE', 2)} AS rate_2dp,
            {_r('100.0 * event_count / nullif(fault_count, 0)::DOUBLE', 2)} AS inverse_rate FROM state""",
    ),
    "window_status": (
        _STATE,
        f"""SELECT vehicle_id, window_start, fault_count,
            CASE WHEN fault_count > 0 THEN 'fault'
                 WHEN maximum_temperature > 90 OR {_BATTERY} < 20 THEN 'warning' ELSE 'ok' END AS status,
            CASE WHEN fault_count > 1 THEN fault_count || ' Faults' WHEN fault_count = 1 THEN '1 Fault'
                 WHEN maximum_temperature > 90 OR {_BATTERY} < 20 THEN 'Warning' ELSE 'Nominal' END AS status_label
            FROM state""",
    ),
    "validation_errors": (
        _LENIENT,
        """SELECT event_id, "offset", array_to_string(errors, '; ') AS errors FROM messages""",
    ),
    # filters and routing
    "malformed_split": (
        _FEED,
        """SELECT event_id, "offset", json_payload, 'malformed_json' AS error_reason, kafka_timestamp
           FROM payloads WHERE malformed""",
    ),
    "valid_events": (_FEED, f"SELECT {_VALID_COLUMNS} FROM judged WHERE ok"),
    "invalid_events": (
        _FEED,
        """SELECT event_id, "offset", json_payload, 'invalid_telemetry_values' AS error_reason, kafka_timestamp
           FROM judged WHERE NOT ok AND NOT malformed""",
    ),
    "validate_rules": (
        _LENIENT,
        """SELECT event_id, "offset", len(errors) = 0 AS valid, CAST(len(errors) AS INTEGER) AS error_count
           FROM messages""",
    ),
    "validate_split": (
        _LENIENT,
        """SELECT event_id, "offset", 'valid' AS part, id_trimmed AS content FROM messages WHERE len(errors) = 0
           UNION ALL SELECT event_id, "offset", 'invalid', json_payload FROM messages WHERE len(errors) > 0
           UNION ALL SELECT event_id, "offset", 'reason', unnest(errors) FROM messages""",
    ),
    "missing_fields": (
        _FEED,
        """SELECT event_id, "offset", unnest(CASE defect WHEN 'absent_temperature' THEN ['temperature']
             ELSE ['timestamp', 'speed', 'battery_level', 'temperature', 'fault_code'] END) AS field
           FROM parsed WHERE defect IN ('empty_object', 'absent_temperature')""",
    ),
    "fault_windows": (
        _STATE,
        f"""SELECT vehicle_id, window_start, window_end, fault_count, event_count,
            {_r('100.0 * fault_count / nullif(event_count, 0)::DOUBLE', 1)} AS fault_rate_pct
            FROM state WHERE fault_count > 0""",
    ),
    "high_temp_windows": (
        _STATE,
        """SELECT vehicle_id, window_start, window_end, maximum_temperature FROM state
           WHERE maximum_temperature > 90.0""",
    ),
    "recent_windows": (
        _STATE,
        f"""SELECT vehicle_id, window_start, window_end, {_r('average_speed', 2)} AS avg_speed_kmh,
            {_r('average_battery_level', 2)} AS avg_battery_pct, fault_count, event_count FROM state
            WHERE window_end >= (SELECT max(window_end) FROM state) - INTERVAL 30 MINUTE""",
    ),
    "batch_filter": (_STATE, f"SELECT {_KPI_COLUMNS}, batch_id FROM state WHERE batch_id = 1"),
    # deduplication
    "stream_dedup": (
        _FEED + _FIRST,
        'SELECT event_id, "offset", vehicle_id, event_timestamp, speed, fault_code FROM first_seen',
    ),
    "exact_dedup": (
        _FEED,
        """SELECT DISTINCT vehicle_id, stamp AS "timestamp", speed_text AS speed,
             CAST(battery_level AS VARCHAR) AS battery_level,
             CASE WHEN isnan(temperature) THEN '"NaN"' ELSE CAST(temperature AS VARCHAR) END AS temperature, fault_code,
             CAST(CASE WHEN defect = 'empty_object' THEN 0 WHEN defect IN ('absent_id', 'absent_temperature') THEN 5
                  ELSE 6 END AS INTEGER) AS key_count
           FROM parsed WHERE NOT malformed""",
    ),
    # windows
    "window_kpis": (_kpis(_US_6H), f"SELECT {_KPI_COLUMNS} FROM kpis"),
    "window_kpis_5m": (_kpis(300_000_000), f"SELECT {_KPI_COLUMNS} FROM kpis"),
    "window_kpis_rounded": (
        _LENIENT,
        f""", good AS (
          SELECT DISTINCT id_trimmed, stamp, speed_number AS speed, battery_level, temperature, code_trimmed,
            CASE WHEN stamp LIKE '%+02:00' THEN ts - INTERVAL 2 HOUR ELSE ts END AS sent_at
          FROM messages WHERE len(errors) = 0)
        SELECT id_trimmed AS vehicle_id,
          strftime(make_timestamp(epoch_us(sent_at) // {_US_6H} * {_US_6H}), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_start,
          CAST(21600 AS INTEGER) AS window_seconds, {_r('avg(speed)', 2)} AS avg_speed,
          {_r('avg(battery_level)', 2)} AS avg_battery_level, max(temperature) AS max_temperature,
          CAST(count(*) FILTER (upper(code_trimmed) <> 'NONE') AS BIGINT) AS fault_count, count(*) AS event_count
        FROM good GROUP BY ALL""",
    ),
    "fault_count_expr": (
        _FEED,
        """SELECT batch_id,
             CAST(count(*) FILTER (upper(replace(trim(fault_code), '-', '_')) <> 'NONE') AS BIGINT) AS faults,
             CAST(count(*) FILTER (upper(fault_code) <> 'NONE') AS BIGINT) AS faults_any_case
           FROM parsed GROUP BY 1""",
    ),
    "sorted_windows": (_kpis(86_400_000_000), f"SELECT {_KPI_COLUMNS} FROM kpis"),
    # analytics
    "vehicle_speed_summary": (
        _STATE,
        f"""SELECT vehicle_id, {_r('avg(average_speed)', 2)} AS overall_avg_speed_kmh, count(*) AS total_windows,
            CAST(sum(event_count) AS BIGINT) AS total_events FROM state GROUP BY 1""",
    ),
    "vehicle_battery_summary": (
        _STATE,
        f"""SELECT vehicle_id, {_r('avg(average_battery_level)', 2)} AS overall_avg_battery_pct,
            {_r('min(average_battery_level)', 6)} AS min_battery_pct,
            {_r('max(average_battery_level)', 6)} AS max_battery_pct FROM state GROUP BY 1""",
    ),
    "vehicle_max_temp": (
        _STATE,
        "SELECT vehicle_id, max(maximum_temperature) AS all_time_max_temp_celsius FROM state GROUP BY 1",
    ),
    "vehicle_fault_distribution": (
        _STATE,
        f"""SELECT vehicle_id, CAST(sum(fault_count) AS BIGINT) AS total_faults,
            CAST(sum(event_count) AS BIGINT) AS total_events,
            {_r('100.0 * sum(fault_count) / nullif(sum(event_count), 0)::DOUBLE', 2)} AS fault_rate_pct
            FROM state GROUP BY 1""",
    ),
    "latest_window_per_vehicle": (
        _STATE,
        """SELECT vehicle_id, max(window_end) AS latest_window_end, max(window_start) AS latest_window_start
           FROM state GROUP BY 1""",
    ),
    "table_totals": (
        _STATE,
        """SELECT count(*) AS total_windows, min(window_start) AS earliest_window, max(window_end) AS latest_window
           FROM state""",
    ),
    "fleet_summary": (
        _STATE,
        f"""SELECT count(DISTINCT vehicle_id) AS total_vehicles, count(*) AS total_windows,
            CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_events,
            CAST(coalesce(sum(fault_count), 0) AS BIGINT) AS total_faults,
            coalesce({_r('avg(average_speed)', 2)}, 0.0) AS avg_speed,
            coalesce({_r('avg(average_battery_level)', 2)}, 0.0) AS avg_battery,
            coalesce({_r('max(maximum_temperature)', 2)}, 0.0) AS max_temperature,
            {_text_of('min(window_start)', 'earliest_window')}, {_text_of('max(window_end)', 'latest_window')}
            FROM state""",
    ),
    "fault_kpis": (
        _STATE,
        """SELECT CAST(coalesce(sum(fault_count), 0) AS BIGINT) AS total_faults,
           count(DISTINCT vehicle_id) AS affected_vehicles, count(*) AS fault_windows
           FROM state WHERE fault_count > 0""",
    ),
    "fault_vehicles": (_STATE, "SELECT DISTINCT vehicle_id FROM state WHERE fault_count > 0"),
    "recent_window_metrics": (
        _STATE,
        f"""SELECT vehicle_id, window_start, window_end, {_r('average_speed', 2)} AS avg_speed_kmh,
            {_r('average_battery_level', 2)} AS avg_battery_pct, {_r('maximum_temperature', 2)} AS max_temp_celsius,
            fault_count, event_count FROM state ORDER BY state.window_start DESC, vehicle_id LIMIT 50""",
    ),
    "latest_telemetry": (
        _STATE,
        f"SELECT {_SERVED} FROM state ORDER BY state.window_start DESC, vehicle_id LIMIT 100",
    ),
    "recent_faults": (
        _STATE,
        f"""SELECT {_SERVED} FROM state WHERE fault_count > 0
            ORDER BY state.window_start DESC, fault_count DESC, vehicle_id LIMIT 50""",
    ),
    "latest_telemetry_desc": (
        _STATE,
        f"SELECT {_KPI_COLUMNS}, batch_id FROM state ORDER BY state.window_start DESC, vehicle_id DESC LIMIT 100",
    ),
    "batch_counts": (_STATE, "SELECT batch_id, count(*) AS row_count FROM state GROUP BY 1"),
    "top10_faults": (
        _STATE,
        f"""SELECT {_SERVED} FROM state WHERE fault_count > 0
            ORDER BY state.window_start DESC, fault_count DESC, vehicle_id LIMIT 10""",
    ),
    "latest_window_state": (_STATE, f"SELECT {_KPI_COLUMNS}, batch_id FROM state"),
    "sort_by_column": (_STATE, f"SELECT {_KPI_COLUMNS}, batch_id FROM state"),
    "invalid_counts": (_FEED, "SELECT batch_id, count(*) AS invalid_records FROM judged WHERE NOT ok GROUP BY 1"),
    "dq_reason_counts": (
        _LENIENT,
        "SELECT reason, count(*) AS occurrences FROM (SELECT unnest(errors) AS reason FROM messages) GROUP BY 1",
    ),
    "dead_letter": (
        _FEED,
        """SELECT event_id, "offset", json_payload,
             CASE WHEN malformed THEN 'malformed_json' ELSE 'invalid_telemetry_values' END AS error_reason,
             kafka_timestamp FROM judged WHERE NOT ok""",
    ),
    "snapshot_diff": (
        _STATE,
        """, previous AS (
          SELECT * FROM changelog WHERE batch_id <= 1
          QUALIFY row_number() OVER (PARTITION BY vehicle_id, window_start ORDER BY batch_id DESC) = 1)
        SELECT c.vehicle_id, c.window_start, c.event_count,
          CASE WHEN p.vehicle_id IS NULL THEN 'new' ELSE 'updated' END AS change
        FROM state c LEFT JOIN previous p USING (vehicle_id, window_start)
        WHERE p.vehicle_id IS NULL OR c.event_count > p.event_count""",
    ),
    "new_window_count": (
        _STATE,
        """, previous AS (SELECT DISTINCT vehicle_id, window_start FROM changelog WHERE batch_id <= 1)
        SELECT count(*) AS new_windows FROM state c ANTI JOIN previous p USING (vehicle_id, window_start)""",
    ),
    "curated_scan_dates": (
        _CHANGELOG,
        """SELECT vehicle_id, window_start, event_count, strftime(window_start, '%Y-%m-%d') AS date, batch_id
           FROM changelog WHERE strftime(window_start, '%Y-%m-%d') BETWEEN '2024-01-03' AND '2024-01-10'""",
    ),
    "ingest_outcomes": (
        _FEED,
        """SELECT batch_id, CASE WHEN ok THEN 'valid' WHEN malformed THEN 'malformed_json'
             ELSE 'invalid_telemetry_values' END AS outcome, count(*) AS records FROM judged GROUP BY ALL""",
    ),
    # streaming
    "stream_window_state": (_kpis(_US_6H), f"SELECT {_KPI_COLUMNS} FROM kpis"),
    # Records come in by offset modulo 3, so the copy with the smaller remainder is first.
    "stream_window_state_batches": (
        _kpis(_US_6H).replace('ORDER BY "offset")', 'ORDER BY "offset" % 3)'),
        f"SELECT {_KPI_COLUMNS} FROM kpis",
    ),
    "stream_stored_state": (
        _kpis(_US_6H).replace('ORDER BY "offset")', 'ORDER BY "offset" % 3 = 2)'),
        f"SELECT {_KPI_COLUMNS} FROM kpis",
    ),
    # A run's late events are those up to three days before the newest of earlier runs.
    "stream_late_rows": (
        _FEED,
        """, arrived AS (
          SELECT vehicle_id, event_timestamp, (CAST(floor(epoch(kafka_timestamp) / 604800) AS BIGINT) + event_id % 3) % 4 AS part
          FROM judged WHERE ok),
        newest AS (
          SELECT part, max(max(event_timestamp)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM arrived GROUP BY part),
        told AS (
          SELECT *, coalesce(event_timestamp <= before - INTERVAL 3 DAY, false) AS is_late FROM arrived JOIN newest USING (part)),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY vehicle_id, event_timestamp, is_late ORDER BY part) AS nth FROM told)
        SELECT CAST(dense_rank() OVER (ORDER BY part) AS INTEGER) AS run, count(*) AS valid,
          count(*) FILTER (NOT is_late AND nth = 1) AS accepted, count(*) FILTER (NOT is_late AND nth > 1) AS duplicates,
          count(*) FILTER (is_late) AS late FROM ranked GROUP BY part""",
    ),
    "stream_dead_letter": (
        _FEED,
        """SELECT json_payload, CASE WHEN malformed THEN 'malformed_json' ELSE 'invalid_telemetry_values' END
             AS error_reason, kafka_timestamp FROM judged WHERE NOT ok""",
    ),
    # A window is final once the watermark (newest event minus 2 minutes) has reached its end.
    "stream_final_windows": (
        _kpis(_US_6H),
        f"""SELECT {_KPI_COLUMNS}, strftime(window_start, '%Y-%m-%d') AS date FROM kpis
            WHERE window_end <= (SELECT max(event_timestamp) FROM judged WHERE ok) - INTERVAL 2 MINUTE""",
    ),
}


# Queries over the feed with a vehicle per user and a batch per day, by the query they repeat.
_FROM_ROLLUPS = (
    "vehicle_speed_summary", "vehicle_battery_summary", "vehicle_max_temp", "vehicle_fault_distribution",
    "latest_window_per_vehicle", "table_totals", "fleet_summary",
)
_NEWEST = ("recent_window_metrics", "latest_telemetry", "latest_telemetry_desc", "recent_faults", "recent_windows")
_WIDE = ("window_kpis", "stream_dedup", "latest_window_state", "vehicle_speed_summary", "fleet_summary", "invalid_counts")


def _widened(ctes: str) -> str:
    ten = "CAST(e.user_id % 10 AS VARCHAR) AS unit"
    three = f"event_id % {BATCHES} AS batch_id"
    return ctes.replace(ten, "CAST(e.user_id AS VARCHAR) AS unit").replace(
        three, "CAST(floor(epoch(ts) / 86400) AS BIGINT) AS batch_id"
    )


def checks() -> dict[str, str]:
    """Query name to SQL."""
    wide = {f"{name}_wide": (_widened(_BODIES[name][0]), _BODIES[name][1]) for name in _WIDE}
    same = {
        "compacted_state": "latest_window_state",
        "compacted_late_run": "latest_window_state",
        "version_diff": "snapshot_diff",
        "stream_first_arrival": "stream_dedup",
        "newest_top_faults": "top10_faults",
        **{f"rollup_{name}": name for name in _FROM_ROLLUPS},
        **{f"newest_{name}": name for name in _NEWEST},
    }
    wide |= {name: _BODIES[of] for name, of in same.items()}
    return {name: f"WITH {ctes.lstrip()} {body}" for name, (ctes, body) in (_BODIES | wide).items()}
