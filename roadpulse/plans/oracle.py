"""DuckDB SQL for every registered query, over the same tables.

Written from the meaning of each query rather than from its Spark plan, so that
a mistake in one is not repeated in the other.
"""

from __future__ import annotations

from roadpulse.schemas import SWEEP

# The station records of ``feeds.station_records``, with plain column names.
_STATION = """
station AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS true_time,
    strftime(ts, '%m/%d/%Y %H:%M:%S') AS us_time,
    CAST(user_id AS VARCHAR) AS station,
    CASE WHEN event_id % 31 = 0 THEN NULL
         WHEN event_type = 'view' THEN '7'
         WHEN event_type = 'click' THEN '7.0'
         ELSE CAST(event_id % 12 AS VARCHAR) END AS district,
    CAST(user_id % 400 AS VARCHAR) AS freeway,
    substr('NSEW', CAST(user_id % 4 AS INTEGER) + 1, 1) AS direction,
    CASE event_id % 3 WHEN 0 THEN 'ML' WHEN 1 THEN 'OR' ELSE 'FR' END AS lane_type,
    '0.5' AS station_length,
    CAST(event_id % 60 AS VARCHAR) AS samples,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '0' ELSE '100' END AS pct_observed,
    CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 11 = 0 THEN '   '
         ELSE CAST(value AS VARCHAR) END AS total_flow,
    '0.125' AS avg_occupancy,
    CASE WHEN event_id % 13 = 0 THEN 'NA' ELSE CAST(value AS VARCHAR) END AS avg_speed,
    event_type AS region,
    event_id % 10 = 0 OR event_id % 11 = 0 AS no_flow,
    event_id % 13 = 0 AS no_speed,
    value
  FROM events
)"""

_CELLS = """time_text, station, district, freeway, direction, lane_type, station_length,
  samples, pct_observed, total_flow, avg_occupancy, avg_speed"""
# An empty cell of a CSV file is a missing one; a cell of blanks is text.
_CSV_CELLS = _CELLS.replace("total_flow", "nullif(total_flow, '') AS total_flow")

# Usable readings; the district decides the region.
_READINGS = (
    _STATION
    + """,
readings AS (
  SELECT event_id, date_trunc('second', ts) AS ts,
    CASE WHEN district IN ('7', '7.0') THEN 'LA' ELSE district END AS region,
    station AS road_id,
    CASE WHEN no_flow THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS vehicle_count,
    CASE WHEN no_speed THEN NULL ELSE value END AS speed
  FROM station
  WHERE time_text <> 'bad'
)"""
)

_EVENT_READINGS = """
readings AS (
  SELECT ts, event_type AS region, CAST(user_id AS VARCHAR) AS road_id,
    CAST(trunc(value) AS INTEGER) AS vehicle_count, value AS speed
  FROM events
)"""


def _round(value: str, digits: int = 6) -> str:
    """Half up, after the noise of a floating-point sum is cut off."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def _half_up(value: str, digits: int = 2) -> str:
    """A double rounded half up as it is written in decimals."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _windows(width: str, source: str = "readings") -> str:
    return f"""
spans AS (
  SELECT region, time_bucket(INTERVAL '{width}', ts) AS window_start,
    avg(speed) AS mean_speed, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles
  FROM {source} GROUP BY 1, 2
),
aggregates AS (
  SELECT region, window_start, window_start + INTERVAL '{width}' AS window_end,
    mean_speed, total_vehicles,
    CASE WHEN mean_speed > 0 THEN {_half_up("total_vehicles / mean_speed")} END AS congestion_index
  FROM spans
)"""


_AGGREGATE_COLUMNS = f"""region, window_start, window_end, {_round("mean_speed")} AS avg_speed,
  total_vehicles, congestion_index"""


def _aggregates(ctes: str, width: str) -> str:
    return f"WITH {ctes}, {_windows(width)} SELECT {_AGGREGATE_COLUMNS} FROM aggregates"


# A closed window ends at or before the last event time, cut to milliseconds as
# stream time is, less the watermark delay.
def _closed(ctes: str, width: str) -> str:
    return f"""{_aggregates(ctes, width)}
WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM readings) - INTERVAL '20 seconds'"""


_LAST_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) FROM readings) - INTERVAL '20 seconds'"


def _plain_aggregate(width: str) -> str:
    return f"""WITH {_EVENT_READINGS}, {_windows(width)}
SELECT region, window_start, window_end, {_round("mean_speed")} AS avg_speed, total_vehicles
FROM aggregates"""


_LABELS = " ".join(
    f"WHEN {number} THEN 'file|window={window}|trigger={trigger}'"
    for number, (window, trigger) in enumerate(SWEEP)
)
_METRICS = f"""
per_batch AS (
  SELECT event_id // 100 AS batch_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS logged_at,
    count(*) AS rows, sum(value) / 1000 AS duration_sec
  FROM events GROUP BY 1
),
metrics AS (
  SELECT batch_id, logged_at, rows, duration_sec, rows / duration_sec AS throughput,
    CASE batch_id % 6 {_LABELS} END AS config,
    CASE WHEN batch_id % 6 < 3 THEN 5 ELSE 10 END AS window_seconds,
    CASE batch_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 20 END AS trigger_seconds
  FROM per_batch
)"""
_STEADY = f"""{_METRICS},
steady AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY window_seconds, trigger_seconds ORDER BY batch_id) AS nth
    FROM metrics) WHERE nth > 1
)"""

_REGIONS = ["click", "error", "purchase", "signup", "view"]


def _pivot(metric: str, ctes: str, source: str = "aggregates") -> str:
    columns = ", ".join(
        f"{_round(f"avg({metric}) FILTER (WHERE region = '{region}')")} AS {region}"
        for region in _REGIONS
    )
    return f"""WITH {ctes} SELECT window_start, {columns} FROM {source}
WHERE {metric} IS NOT NULL AND region IS NOT NULL GROUP BY window_start"""


_HOURLY = f"{_EVENT_READINGS}, {_windows('1 hour')}"
_ROLLING = f"""{_HOURLY},
rolling AS (
  SELECT region, window_start,
    avg(mean_speed) OVER recent AS avg_speed_roll,
    avg(congestion_index) OVER recent AS congestion_roll
  FROM aggregates
  WINDOW recent AS (PARTITION BY region ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)"""

# Lane layouts: width, and the names of all cells.
_LINES = f"""{_STATION},
widths AS (
  SELECT CASE WHEN event_id % 41 = 0 THEN 10
              ELSE 12 + 5 * (event_id % 3) + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END END AS n_columns
  FROM station
)"""


_JSON_CELLS = [
    ("Timestamp", "time_text"),
    ("Station", "station"),
    ("District", "district"),
    ("Freeway #", "freeway"),
    ("Direction of Travel", "direction"),
    ("Lane Type", "lane_type"),
    ("Station Length", "station_length"),
    ("Samples", "samples"),
    ("% Observed", "pct_observed"),
    ("Total Flow", "total_flow"),
    ("Avg Occupancy", "avg_occupancy"),
    ("Avg Speed", "avg_speed"),
    ("Region", "region"),
]
# The twelve base columns as one text, and without the two that short lines lack.
_BASE_NAMES = "|".join(name for name, _ in _JSON_CELLS[:12])
_SHORT_NAMES = "|".join(name for name, _ in _JSON_CELLS[:10])


def _lane_names(lane: int) -> str:
    fields = ("Samples", "Flow", "Avg Occ", "Avg Speed", "Observed")
    return "".join(f"|Lane {lane} {field}" for field in fields)


_TEXT_CELLS = """CASE WHEN event_id % 41 = 0 THEN NULL ELSE '0.125' END AS avg_occupancy,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE avg_speed END AS avg_speed"""
_TEXT_LINE = f"""us_time AS time_text, station, district, freeway, direction, lane_type,
  station_length, samples, pct_observed, nullif(total_flow, '') AS total_flow, {_TEXT_CELLS}"""

_PREPARED_RULE = "pct_observed IS DISTINCT FROM '0' AND NOT no_flow AND NOT no_speed"


def _prepared(region: str) -> str:
    return f"""WITH {_STATION}
SELECT CASE WHEN time_text = 'bad' THEN NULL ELSE true_time END AS time_text, station, district,
  freeway, direction, lane_type, station_length, samples,
  CAST(pct_observed AS DOUBLE) AS pct_observed, value AS total_flow, avg_occupancy,
  value AS avg_speed, {region} AS region
FROM station WHERE {_PREPARED_RULE}"""


_JSON_TEXT = " || ',' || ".join(
    f"""'"{name}":"' || coalesce({column}, '') || '"'""" for name, column in _JSON_CELLS
)
_KEY_ROWS = " UNION ALL ".join(
    f"""SELECT '{name}' AS key, count(*) AS messages
FROM decodable WHERE {column} IS NOT NULL HAVING count(*) > 0"""
    for name, column in _JSON_CELLS
)


_PRESENT_KEYS = ", ".join(
    f"CASE WHEN {column} IS NOT NULL THEN '{name}' END" for name, column in _JSON_CELLS
)
_PRESENT_CELLS = ", ".join(column for _, column in _JSON_CELLS)


def _decoded(condition: str) -> str:
    columns = ", ".join(
        f"CASE WHEN event_id % 23 = 0 THEN NULL ELSE {column} END AS {column}"
        for _, column in _JSON_CELLS
    )
    return f"WITH {_STATION} SELECT {columns}, ts AS kafka_ts FROM station WHERE {condition}"


_ONE_BATCH = """SELECT '{label}' AS config, CAST(0 AS BIGINT) AS batch_id, count(*) AS rows, count(speed) AS has_speed,
  count(vehicle_count) AS has_count, CAST(0 AS BIGINT) AS dropped_late FROM readings"""

ORACLE: dict[str, str] = {
    # sources
    "src_csv_stream": f"WITH {_STATION} SELECT {_CSV_CELLS}, region FROM station",
    "src_csv_typed": f"""WITH {_STATION}
SELECT time_text, station, CASE WHEN district = '7.0' THEN NULL ELSE CAST(district AS INTEGER) END AS district,
  CAST(freeway AS INTEGER) AS freeway, direction, lane_type, 0.5::DOUBLE AS station_length,
  CAST(samples AS INTEGER) AS samples, CAST(pct_observed AS DOUBLE) AS pct_observed,
  CASE WHEN no_flow THEN NULL ELSE value END AS total_flow, 0.125::DOUBLE AS avg_occupancy,
  CASE WHEN no_speed THEN NULL ELSE value END AS avg_speed, region
FROM station""",
    "src_json_decode": _decoded("event_id % 29 <> 0"),
    "json_decode_strict": _decoded("event_id % 29 <> 0 AND event_id % 23 <> 0"),
    "src_station_text": f"WITH {_STATION} SELECT {_TEXT_LINE} FROM station",
    "src_header_sniff": f"""WITH {_STATION}
SELECT 'named' AS layout, {_CSV_CELLS} FROM station
UNION ALL SELECT 'unnamed' AS layout, {_TEXT_LINE} FROM station""",
    "lane_layout": f"""WITH {_LINES}
SELECT CAST(n_columns AS INTEGER) AS n_columns, count(*) AS n_lines,
  CAST(CASE WHEN n_columns < 12 THEN 0 ELSE (n_columns - 12) // 5 END AS INTEGER) AS n_lanes,
  CASE WHEN n_columns >= 12 THEN '{_BASE_NAMES}' ELSE '{_SHORT_NAMES}' END
  || CASE WHEN n_columns >= 17 THEN '{_lane_names(1)}' ELSE '' END
  || CASE WHEN n_columns >= 22 THEN '{_lane_names(2)}' ELSE '' END
  || CASE WHEN n_columns IN (13, 18, 23) THEN '|Extra_' || (n_columns - 1) ELSE '' END AS column_names
FROM widths GROUP BY n_columns""",
    "src_csv_batch": f"WITH {_STATION} SELECT {_CSV_CELLS}, region FROM station",
    "src_described_schema": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus,
  CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders""",
    "src_parquet_parts": _aggregates(_EVENT_READINGS, "1 hour"),
    "src_metrics": f"""WITH {_METRICS}
SELECT CAST(logged_at AS TIMESTAMP) AS logged_at, batch_id, rows, {_round("duration_sec")} AS duration_sec,
  {_round("throughput")} AS throughput_rows_per_sec, config FROM metrics""",
    "src_metrics_early": f"""WITH {_METRICS}
SELECT CAST(logged_at AS TIMESTAMP) AS logged_at, batch_id, rows FROM metrics""",
    # sinks
    "sink_parquet_stream": _closed(_EVENT_READINGS, "1 hour"),
    "sink_batch_metrics": f"WITH {_EVENT_READINGS} "
    + _ONE_BATCH.format(label="file|window=1 hour|trigger=available-now"),
    "quality_counts": f"""WITH {_READINGS}
SELECT count(*) AS total, count(ts) AS has_ts, count(speed) AS has_speed,
  count(vehicle_count) AS has_count FROM readings HAVING count(*) > 0""",
    "sink_csv": _prepared("'LA'"),
    "chunk_assign": f"""WITH {_STATION},
placed AS (SELECT event_id, row_number() OVER (ORDER BY time_text, station, event_id) AS row_position FROM station)
SELECT event_id, row_position, 1 + (row_position - 1) // 1000 AS chunk_id FROM placed""",
    "chunk_input_order": f"""WITH {_STATION},
placed AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_position FROM station)
SELECT event_id, row_position, 1 + (row_position - 1) // 1000 AS chunk_id FROM placed""",
    "sink_chunks": f"""WITH {_STATION},
placed AS (SELECT event_id, row_number() OVER (ORDER BY time_text, station, event_id) AS row_position FROM station)
SELECT 1 + (row_position - 1) // 1000 AS chunk_id, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files,
  CAST(sum(event_id) AS BIGINT) AS event_id_sum FROM placed GROUP BY 1""",
    "sink_json_encode": f"""WITH {_STATION} SELECT '{{' || {_JSON_TEXT} || '}}' AS value FROM station""",
    # projections and filters
    "null_if_empty": f"""WITH {_STATION}
SELECT event_id, CASE WHEN no_flow THEN NULL ELSE total_flow END AS flow_text FROM station""",
    "coalesce_aliases": f"""WITH {_STATION}
SELECT event_id, CASE WHEN no_flow THEN samples ELSE total_flow END AS flow_text,
  avg_speed AS speed_text, CAST(NULL AS VARCHAR) AS no_such_text FROM station""",
    "cast_measures": f"""WITH {_STATION}
SELECT event_id, CASE WHEN no_flow THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS vehicle_count,
  CASE WHEN no_speed THEN NULL ELSE value END AS speed FROM station""",
    "region_map": f"""WITH {_STATION}
SELECT event_id, CASE WHEN TRY_CAST(district AS DOUBLE) = 7 THEN 'LA' ELSE district END AS region FROM station""",
    "parse_event_time": f"""WITH {_STATION}
SELECT event_id, TRY_CAST(time_text AS TIMESTAMP) AS event_time FROM station
WHERE TRY_CAST(time_text AS TIMESTAMP) IS NOT NULL""",
    "canonical_reading": f"WITH {_READINGS} SELECT ts, region, road_id, vehicle_count, speed FROM readings",
    "event_time_ingest": f"""WITH {_STATION}
SELECT ts,
  CASE WHEN event_id % 23 = 0 THEN NULL WHEN district IN ('7', '7.0') THEN 'LA' ELSE district END AS region,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE station END AS road_id,
  CASE WHEN event_id % 23 = 0 OR no_flow THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS vehicle_count,
  CASE WHEN event_id % 23 = 0 OR no_speed THEN NULL ELSE value END AS speed
FROM station WHERE event_id % 29 <> 0""",
    "keep_base_columns": f"WITH {_STATION} SELECT {_CELLS}, 11 AS n_removed FROM station",
    "drop_unobserved": f"""WITH {_STATION}
SELECT event_id, CAST(pct_observed AS DOUBLE) AS pct_observed FROM station
WHERE pct_observed IS NULL OR pct_observed <> '0'""",
    "drop_null_flow": f"""WITH {_STATION}
SELECT event_id, TRY_CAST(total_flow AS DOUBLE) AS total_flow FROM station
WHERE TRY_CAST(total_flow AS DOUBLE) IS NOT NULL""",
    "drop_null_speed": f"""WITH {_STATION}
SELECT event_id, TRY_CAST(avg_speed AS DOUBLE) AS avg_speed FROM station
WHERE TRY_CAST(avg_speed AS DOUBLE) IS NOT NULL""",
    "cleaning_audit": f"""WITH {_STATION},
counts AS (
  SELECT count(*) AS n,
    count(*) FILTER (WHERE pct_observed = '0') AS a,
    count(*) FILTER (WHERE pct_observed IS DISTINCT FROM '0' AND no_flow) AS b,
    count(*) FILTER (WHERE pct_observed IS DISTINCT FROM '0' AND NOT no_flow AND no_speed) AS c
  FROM station
),
steps AS (
  SELECT 1 AS step, 'unobserved' AS rule, a AS gone, n - a AS kept, n FROM counts
  UNION ALL SELECT 2, 'no flow', b, n - a - b, n FROM counts
  UNION ALL SELECT 3, 'no speed', c, n - a - b - c, n FROM counts
  UNION ALL SELECT 4, 'total', a + b + c, n - a - b - c, n FROM counts
)
SELECT step, rule, gone AS rows_removed, {_half_up("gone * 100.0::DOUBLE / n", 1)} AS pct_of_input,
  kept AS rows_remaining FROM steps""",
    "reformat_timestamp": f"""WITH {_STATION}
SELECT event_id, CASE WHEN time_text = 'bad' THEN NULL ELSE true_time END AS time_text FROM station""",
    "region_constant": "SELECT event_id, 'LA' AS region FROM events",
    "prepared_records": _prepared("CASE WHEN district IN ('7', '7.0') THEN 'LA' ELSE district END"),
    "to_numeric": f"""WITH {_STATION}
SELECT event_id, TRY_CAST(total_flow AS DOUBLE) AS flow, TRY_CAST(avg_speed AS DOUBLE) AS speed,
  TRY_CAST(pct_observed AS DOUBLE) AS pct_observed FROM station""",
    "distinct_district": f"WITH {_STATION} SELECT DISTINCT district FROM station",
    "head_rows": f"""WITH {_STATION}
SELECT event_id, time_text, station, total_flow FROM station ORDER BY time_text, event_id LIMIT 3""",
    "payload_key_profile": f"""WITH {_STATION},
decodable AS (SELECT * FROM station WHERE event_id % 29 <> 0 AND event_id % 23 <> 0)
{_KEY_ROWS}""",
    "payload_samples": f"""WITH {_STATION}
SELECT ts AS kafka_ts, concat_ws('|', {_PRESENT_KEYS}) AS keys,
  array_to_string(list_filter([{_PRESENT_CELLS}], lambda cell: cell IS NOT NULL)[1:3], '|') AS sample_values
FROM station WHERE event_id % 29 <> 0 AND event_id % 23 <> 0 ORDER BY ts LIMIT 3""",
    # batch metrics
    "metrics_normalise": f"""WITH {_METRICS}
SELECT batch_id, rows, {_round("duration_sec")} AS duration_sec, {_round("throughput")} AS throughput_rps,
  'default' AS config FROM metrics WHERE batch_id % 9 <> 0""",
    "dropna_subset": f"""WITH {_METRICS}
SELECT batch_id, window_seconds, trigger_seconds FROM metrics WHERE batch_id % 5 <> 0""",
    "config_label": """SELECT event_id, event_type || '|window=' || (event_id % 60 + 1) || ' seconds|trigger='
  || (user_id % 20 + 1) || ' seconds' AS config FROM events""",
    "parse_config": f"WITH {_METRICS} SELECT batch_id, window_seconds, trigger_seconds FROM metrics",
    "short_label": f"""WITH {_METRICS}
SELECT batch_id, 'W' || window_seconds || '–T' || trigger_seconds AS short_label FROM metrics""",
    "batch_size_by_config": f"""WITH {_METRICS}
SELECT config, {_round("avg(rows)")} AS avg_rows FROM metrics GROUP BY config""",
    "latency_jitter": f"""WITH {_METRICS}
SELECT config, {_round("stddev_samp(duration_sec)")} AS jitter_sec FROM metrics GROUP BY config""",
    "steady_state_summary": f"""WITH {_STEADY}
SELECT window_seconds, trigger_seconds, {_round("avg(duration_sec)")} AS avg_duration_sec,
  {_round("avg(throughput)")} AS avg_throughput, count(batch_id) AS batches,
  'W' || window_seconds || '–T' || trigger_seconds AS short_label
FROM steady GROUP BY window_seconds, trigger_seconds""",
    "warmup_drop": f"""WITH {_STEADY}
SELECT window_seconds, trigger_seconds, batch_id, {_round("duration_sec")} AS duration_sec FROM steady""",
    "throughput_efficiency": f"""WITH {_METRICS}
SELECT config, {_round("avg(throughput / (SELECT max(throughput) FROM metrics) * 100)")} AS efficiency
FROM metrics GROUP BY config""",
    "latency_histogram": f"""WITH {_METRICS},
range AS (SELECT min(duration_sec) AS least, max(duration_sec) AS most FROM metrics),
edges AS (
  SELECT bin, least + bin * ((most - least) / 20) AS lo,
    CASE WHEN bin = 19 THEN most ELSE least + (bin + 1) * ((most - least) / 20) END AS hi
  FROM generate_series(0, 19) AS bins(bin), range
)
SELECT bin, {_round("lo")} AS lo, {_round("hi")} AS hi, count(duration_sec) AS n
FROM edges LEFT JOIN metrics
  ON duration_sec >= lo AND (duration_sec < hi OR (bin = 19 AND duration_sec <= hi))
GROUP BY bin, lo, hi""",
    "scaling_curve": f"""WITH {_METRICS}
SELECT rows, {_round("duration_sec")} AS duration_sec FROM metrics""",
    # window aggregates and trends
    "congestion_index": _aggregates(_EVENT_READINGS, "1 hour"),
    "window_agg_5s": _plain_aggregate("5 seconds"),
    "window_agg_10s": _plain_aggregate("10 seconds"),
    "window_agg_1h": _plain_aggregate("1 hour"),
    "window_agg_shipments": _aggregates(
        """readings AS (
  SELECT l_shipdate AS ts, l_returnflag AS region, CAST(trunc(l_quantity) AS INTEGER) AS vehicle_count,
    l_extendedprice AS speed FROM lineitem
)""",
        "1 day",
    ),
    "window_agg_dirty": _aggregates(_READINGS, "1 hour"),
    "mean_by_region": f"""WITH {_EVENT_READINGS}, {_windows("1 hour")}
SELECT window_start, region, {_round("mean_speed")} AS mean FROM aggregates
WHERE region IS NOT NULL AND mean_speed IS NOT NULL""",
    "window_agg_rounded": f"""WITH {_STATION}
SELECT region, time_bucket(INTERVAL '1 hour', ts) AS window_start,
  time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
  {_half_up("avg(CASE WHEN no_speed THEN NULL ELSE value END)")} AS avg_speed,
  {_half_up("sum(CASE WHEN no_flow THEN NULL ELSE value END)")} AS total_vehicles
FROM station GROUP BY 1, 2""",
    "pivot_avg_speed": _pivot("mean_speed", _HOURLY),
    "pivot_total_vehicles": _pivot("total_vehicles", _HOURLY),
    "pivot_congestion": _pivot("congestion_index", _HOURLY),
    "congestion_vs_speed": f"""WITH {_READINGS}, {_windows('1 hour')}
SELECT region, {_round("mean_speed")} AS avg_speed, congestion_index FROM aggregates WHERE region IS NOT NULL""",
    "rolling_mean_3": f"""WITH {_ROLLING}
SELECT region, window_start, {_round("avg_speed_roll")} AS avg_speed_roll,
  {_round("congestion_roll")} AS congestion_roll FROM rolling""",
    "pivot_rolling_speed": _pivot("avg_speed_roll", _ROLLING, "rolling"),
    "pivot_rolling_congestion": _pivot("congestion_roll", _ROLLING, "rolling"),
    "sorted_aggregates": _aggregates(_EVENT_READINGS, "1 hour")
    + " ORDER BY region NULLS LAST, window_start",
    "peak_congestion": f"""WITH {_HOURLY}
SELECT window_start, region, congestion_index FROM aggregates
ORDER BY congestion_index DESC NULLS LAST, region NULLS LAST, window_start LIMIT 5""",
    "union_all_sources": _aggregates(
        """readings AS (
  SELECT ts, event_type AS region, CAST(trunc(value) AS INTEGER) AS vehicle_count, value AS speed FROM events
  UNION ALL
  SELECT l_shipdate, l_returnflag, CAST(trunc(l_quantity) AS INTEGER), l_extendedprice FROM lineitem
)""",
        "1 day",
    ),
    # streams
    "stream_watermark": f"""WITH {_EVENT_READINGS}
SELECT ts, region, road_id, vehicle_count, speed FROM readings""",
    "stream_window_agg": _closed(_EVENT_READINGS, "10 seconds"),
    "stream_station_job": _closed(_READINGS, "1 hour"),
    "stream_message_job": _closed(
        _STATION
        + """,
readings AS (
  SELECT ts,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN district IN ('7', '7.0') THEN 'LA' ELSE district END AS region,
    CASE WHEN event_id % 23 = 0 OR no_flow THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS vehicle_count,
    CASE WHEN event_id % 23 = 0 OR no_speed THEN NULL ELSE value END AS speed
  FROM station WHERE event_id % 29 <> 0
)""",
        "1 hour",
    ),
    "stream_typed_updates": f"""WITH {_STATION}
SELECT region, time_bucket(INTERVAL '5 seconds', ts) AS window_start,
  time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
  {_half_up("avg(CASE WHEN no_speed THEN NULL ELSE value END)")} AS avg_speed,
  {_half_up("sum(CASE WHEN no_flow THEN NULL ELSE value END)")} AS total_vehicles
FROM station WHERE time_text <> 'bad' GROUP BY 1, 2""",
    "stream_late_data": _closed(
        """readings AS (
  SELECT ts, event_type AS region, CAST(trunc(value) AS INTEGER) AS vehicle_count, value AS speed
  FROM events WHERE event_type IS DISTINCT FROM 'error' OR ts >= TIMESTAMP '2024-01-11'
)""",
        "1 hour",
    ),
    "stream_fan_out": f"""SELECT * FROM ({_closed(_EVENT_READINGS, "1 hour")})
CROSS JOIN (VALUES ('parquet'), ('csv')) AS outputs(output)""",
    "stream_open_windows": f"""WITH {_EVENT_READINGS}, {_windows("1 hour")}
SELECT {_AGGREGATE_COLUMNS}, window_end > {_LAST_CLOSED} AS is_open FROM aggregates""",
    "stream_readings_ledger": f"""WITH {_EVENT_READINGS},
judged AS (
  SELECT region IS NOT DISTINCT FROM 'error' AND ts < TIMESTAMP '2024-01-11' AS late,
    time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= {_LAST_CLOSED} AS closed
  FROM readings WHERE ts IS NOT NULL
)
SELECT count(*) AS arrived, count(*) FILTER (NOT late AND closed) AS emitted,
  count(*) FILTER (NOT late AND NOT closed) AS open_now, count(*) FILTER (late) AS late
FROM judged""",
    "stream_resume": _closed(_EVENT_READINGS, "1 hour"),
    "sink_parquet_compacted": _closed(_EVENT_READINGS, "1 hour"),
    "stream_update_mode": _aggregates(_EVENT_READINGS, "1 hour"),
    "stream_paced": f"""WITH {_READINGS}
SELECT event_id % 4 AS batch_id, count(*) AS rows, count(speed) AS has_speed, count(vehicle_count) AS has_count
FROM readings GROUP BY 1""",
    "sweep_metrics": f"WITH {_EVENT_READINGS} "
    + " UNION ALL ".join(
        _ONE_BATCH.format(label=f"file|window={window}|trigger={trigger}") for window, trigger in SWEEP
    ),
}
