"""SQL of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

from dataclasses import asdict

from tripmill import settings as S
from tripmill.operators import monitoring
from tripmill.plans import registry as R

# ---- views shared by several queries -----------------------------------------------------------

TRIPS = """
base AS (
  SELECT *, (l_orderkey * 7 + l_linenumber * 3601) % 86400 AS pu_s,
         CAST(l_quantity * 60 - 90 + (l_orderkey * 131 + l_partkey * 17) % 1800 AS BIGINT) AS du_s
  FROM lineitem),
trips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_id,
         l_shipdate + to_seconds(pu_s) AS tpep_pickup_datetime,
         l_shipdate + to_seconds(pu_s + du_s) AS tpep_dropoff_datetime,
         CAST(l_suppkey % 265 + 1 AS INTEGER) AS PULocationID,
         CAST(l_partkey % 265 + 1 AS INTEGER) AS DOLocationID,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS passenger_count,
         l_quantity * CAST(0.4 AS DOUBLE) AS trip_distance,
         l_extendedprice / 1000 AS total_amount,
         CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 3 END
           AS payment_type
  FROM base)"""

TIMED = TRIPS + """,
timed AS (
  SELECT *, (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))
            / CAST(1000000 AS DOUBLE) / CAST(60 AS DOUBLE) AS duration
  FROM trips)"""

CLEAN = TIMED + """,
clean AS (
  SELECT * REPLACE (CAST(PULocationID AS VARCHAR) AS PULocationID,
                    CAST(DOLocationID AS VARCHAR) AS DOLocationID),
         CAST(PULocationID AS VARCHAR) || '_' || CAST(DOLocationID AS VARCHAR) AS PU_DO
  FROM timed WHERE duration >= 1 AND duration <= 60)"""

PAYLOADS = """
payloads AS (
  SELECT event_id AS sequence_number, ts AS arrival_ts, CASE event_id % 9
    WHEN 0 THEN '{"PULocationID":' || (user_id % 265 + 1) || ',"DOLocationID":'
                || (event_id % 265 + 1) || ',"trip_distance":' || value || '}'
    WHEN 1 THEN '{"ride_id":"r' || event_id || '","PULocationID":' || (user_id % 265 + 1)
                || ',"DOLocationID":' || (event_id % 265 + 1) || '}'
    WHEN 2 THEN '{"ride_id":"r' || event_id || '","PULocationID":' || (user_id % 265 + 1)
                || ',"DOLocationID":' || (event_id % 265 + 1) || ',"trip_distance":null}'
    WHEN 3 THEN '{"ride_id":"r' || event_id || '","PULocationID":' || (user_id % 265 + 1)
                || ',"DOLocationID":' || (event_id % 265 + 1) || ',"trip_distance":"abc"}'
    WHEN 4 THEN '{"ride_id":"r' || event_id || '","DOLocationID":' || (event_id % 265 + 1)
                || ',"trip_distance":' || value || '}'
    WHEN 5 THEN 'not json ' || event_id
    WHEN 6 THEN '{"event_id":"t' || event_id || '","event_type":"taxi_trip_request",'
                || '"timestamp":"2024-01-01T00:00:00Z","data":{"pickup_location_id":"'
                || (user_id % 265 + 1) || '","dropoff_location_id":"' || (event_id % 265 + 1)
                || '","trip_distance":' || value || '}}'
    ELSE '{"ride_id":"r' || (event_id - event_id % 9) || '","PULocationID":"'
                || (user_id % 265 + 1) || '","DOLocationID":"' || (event_id % 265 + 1)
                || '","trip_distance":' || value || '}' END AS payload
  FROM events),
docs AS (
  SELECT *, CASE WHEN json_valid(payload) THEN payload END AS j FROM payloads)"""

_PICK = """CASE WHEN j IS NULL THEN NULL
    WHEN json_exists(j, '$.{flat}') THEN json_extract_string(j, '$.{flat}')
    WHEN json_exists(j, '$.data.{inner}') THEN json_extract_string(j, '$.data.{inner}')
    ELSE '{default}' END"""

ISO = r"regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\.000000$', '')"

NORMAL = PAYLOADS + f""",
normal AS (
  SELECT sequence_number, arrival_ts, payload, j,
    {_PICK.format(flat='PULocationID', inner='pickup_location_id', default='1')} AS pickup,
    {_PICK.format(flat='DOLocationID', inner='dropoff_location_id', default='1')} AS dropoff,
    {_PICK.format(flat='trip_distance', inner='trip_distance', default='1.0')} AS distance
  FROM docs)"""

REQUESTS = NORMAL + r""",
requests AS (
  SELECT sequence_number, arrival_ts, payload,
    coalesce(json_extract_string(j, '$.ride_id'), 'ride_'
      || strftime(arrival_ts, '%Y%m%d_%H%M%S_%f') || '_' || sequence_number) AS ride_id,
    regexp_replace(pickup, '^(-?\d+)\.0+$', '\1') AS PULocationID,
    regexp_replace(dropoff, '^(-?\d+)\.0+$', '\1') AS DOLocationID,
    TRY_CAST(distance AS DOUBLE) AS trip_distance,
    CASE WHEN j IS NULL THEN 'payload is not a JSON object'
         WHEN pickup IS NULL THEN 'PULocationID is null'
         WHEN dropoff IS NULL THEN 'DOLocationID is null'
         WHEN distance IS NULL THEN 'trip_distance is null'
         WHEN TRY_CAST(distance AS DOUBLE) IS NULL THEN 'trip_distance is not a number'
    END AS reason
  FROM normal)"""

ENTRIES = REQUESTS + f""",
entries AS (
  SELECT ride_id, {ISO.format(ts='arrival_ts')} AS timestamp, PULocationID, DOLocationID,
         trip_distance,
         CASE WHEN PULocationID <> DOLocationID THEN trip_distance / CAST(0.4 AS DOUBLE)
              ELSE CAST(15 AS DOUBLE) END AS predicted_duration,
         PULocationID = DOLocationID AS is_default, sequence_number,
         CAST(year(arrival_ts) AS INTEGER) AS year, CAST(month(arrival_ts) AS INTEGER) AS month,
         CAST(day(arrival_ts) AS INTEGER) AS day, arrival_ts
  FROM requests WHERE reason IS NULL),
latest AS (
  SELECT * FROM entries QUALIFY row_number() OVER (
    PARTITION BY year, month, day, ride_id ORDER BY arrival_ts DESC, sequence_number DESC) = 1)"""

EPOCH = "epoch_us(tpep_pickup_datetime)"


def _envelopes(source: str = "timed", count: str = "passenger_count",
               reason: str = "CASE WHEN passenger_count IS NULL THEN 'passenger_count is null' END",
               ) -> str:
    return f"""
  SELECT trip_id, 'trip_' || {EPOCH} || '_' || PULocationID || '_' || substring(md5(trip_id), 1, 16)
           AS event_id,
         'taxi_trip_request' AS event_type, {ISO.format(ts='tpep_pickup_datetime')} AS timestamp,
         {ISO.format(ts='tpep_pickup_datetime')} AS pickup_datetime,
         {ISO.format(ts='tpep_dropoff_datetime')} AS dropoff_datetime,
         CAST(PULocationID AS VARCHAR) AS pickup_location_id,
         CAST(DOLocationID AS VARCHAR) AS dropoff_location_id,
         {count} AS passenger_count, trip_distance, duration AS duration_minutes, total_amount,
         payment_type, {reason} AS reason
  FROM {source}"""


ORDER = "md5(trip_id || '-42'), trip_id"

RIDE_EVENTS = f"""
  SELECT 'ride_' || trip_id AS ride_id, CAST(PULocationID AS VARCHAR) AS PULocationID,
         CAST(DOLocationID AS VARCHAR) AS DOLocationID, trip_distance,
         {ISO.format(ts='tpep_pickup_datetime')} AS pickup_datetime
  FROM trips"""

EVALUATED = CLEAN + """,
err AS (
  SELECT sqrt(avg(power(duration - trip_distance / CAST(0.4 AS DOUBLE), 2))) AS rmse FROM clean)"""

RUNS = """
runs AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS run_date FROM orders)"""


def _months(prefix: str, when: str) -> str:
    return (f"CAST(year({when}) AS INTEGER) AS {prefix}_year, "
            f"CAST(month({when}) AS INTEGER) AS {prefix}_month")


def _with(views: str, query: str) -> str:
    return f"WITH {views.strip()}\n{query.strip()}"


def _month_range(ts: str, year: int, month: int) -> str:
    return (f"{ts} >= make_timestamp({year}, {month}, 1, 0, 0, 0) AND "
            f"{ts} < make_timestamp({year}, {month}, 1, 0, 0, 0) + INTERVAL 1 MONTH")


_PICKUP_PARTS = ("CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, "
                 "CAST(month(tpep_pickup_datetime) AS INTEGER) AS month")

_SPLIT = f"tpep_pickup_datetime {{}} TIMESTAMP '{R.FIRST_VALIDATION_DAY}'"

_ENTRY_COLUMNS = ("ride_id, timestamp, PULocationID, DOLocationID, trip_distance, "
                  "predicted_duration, is_default, sequence_number, year, month, day")

_ENVELOPE_TEXT = r"""
texts AS (
  SELECT event_id AS sequence_number, event_id % 11 AS kind,
    '{"event_id":"t' || event_id || '",' AS head, '"event_type":"taxi_trip_request",' AS typed,
    '"timestamp":"2024-01-05T06:07:08Z"' AS iso, '"pickup_location_id":"12","dropoff_location_id":"7"'
      AS zones, value, event_id FROM events),
payloads AS (
  SELECT sequence_number, CASE kind
    WHEN 0 THEN head || typed || iso || ',"data":{' || zones || ',"trip_distance":' || value || '}}'
    WHEN 1 THEN head || iso || ',"data":{' || zones || ',"trip_distance":' || value || '}}'
    WHEN 2 THEN head || typed || '"timestamp":"yesterday","data":{' || zones
                || ',"trip_distance":' || value || '}}'
    WHEN 3 THEN head || typed || iso || '}'
    WHEN 4 THEN head || typed || iso || ',"data":{"dropoff_location_id":"7"}}'
    WHEN 5 THEN head || typed || iso || ',"data":{' || zones || ',"total_amount":"free"}}'
    WHEN 6 THEN head || typed || iso || ',"data":{' || zones || ',"passenger_count":null}}'
    WHEN 7 THEN head || typed || '"timestamp":"2024-01-05T06:07:08.250+02:00","data":{' || zones
                || ',"trip_distance":' || value || '}}'
    WHEN 8 THEN head || typed || '"timestamp":null,"data":{' || zones
                || ',"trip_distance":' || value || '}}'
    WHEN 9 THEN head || typed || '"timestamp":"2024-02-30T00:00:00","data":{' || zones
                || ',"trip_distance":' || value || '}}'
    ELSE '{"event_id":"t' || event_id END AS payload
  FROM texts),
docs AS (SELECT *, CASE WHEN json_valid(payload) THEN payload END AS j FROM payloads)"""

_ISO_OK = r"""(regexp_matches({t},
  '^\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}(:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?)?(Z|[+-]\d{{2}}:?\d{{2}}(:?\d{{2}})?)?)?$')
  AND TRY_CAST({t} AS TIMESTAMPTZ) IS NOT NULL)"""


def _missing(path: str, message: str) -> str:
    return f"WHEN NOT json_exists(j, '$.{path}') THEN '{message}: {path.split('.')[-1]}'"


def _not_number(name: str) -> str:
    text = f"json_extract_string(j, '$.data.{name}')"
    return (f"WHEN {text} IS NOT NULL AND TRY_CAST({text} AS DOUBLE) IS NULL "
            f"THEN '{name} is not a number'")


def _envelope_rules() -> str:
    stamp = "json_extract_string(j, '$.timestamp')"
    rules = ["WHEN j IS NULL THEN 'not a JSON object'"]
    rules += [_missing(name, "Missing required field")
              for name in ("event_id", "event_type", "timestamp", "data")]
    rules += ["WHEN json_type(j, '$.data') <> 'OBJECT' THEN 'data is not an object'"]
    rules += [_missing(f"data.{name}", "Missing required data field")
              for name in ("pickup_location_id", "dropoff_location_id")]
    rules += [f"WHEN {stamp} IS NULL OR NOT {_ISO_OK.format(t=stamp)} "
              "THEN 'timestamp is not ISO-8601'"]
    rules += [_not_number(name) for name in
              ("passenger_count", "trip_distance", "duration_minutes", "total_amount")]
    return "CASE " + "\n  ".join(rules) + " END"


def all_sql() -> dict[str, str]:
    sql = {}

    # ---- sources and sinks
    month = _month_range("tpep_pickup_datetime", *R.SCAN_MONTH)
    sql["scan_trips_month"] = _with(TRIPS, f"SELECT *, {_PICKUP_PARTS} FROM trips WHERE {month}")
    sql["load_month_with_backfill"] = _with(
        TRIPS, "SELECT * FROM trips WHERE " + _month_range("tpep_pickup_datetime", *R.CACHE_MONTH))
    sql["month_availability"] = _with(TRIPS + f""",
required AS (
  SELECT run_date, {_months('train', 'run_date - INTERVAL 4 MONTH')},
         {_months('val', 'run_date - INTERVAL 3 MONTH')}
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)),
present AS (SELECT DISTINCT {_PICKUP_PARTS} FROM trips),
found AS (
  SELECT r.*, t.year IS NOT NULL AS train_available, v.year IS NOT NULL AS val_available
  FROM required r
  LEFT JOIN present t ON t.year = r.train_year AND t.month = r.train_month
  LEFT JOIN present v ON v.year = r.val_year AND v.month = r.val_month)""", """
SELECT run_date, train_available, val_available,
  train_available AND val_available AS both_available,
  concat_ws(', ',
    CASE WHEN NOT train_available
         THEN 'training (' || printf('%d-%02d', train_year, train_month) || ')' END,
    CASE WHEN NOT val_available
         THEN 'validation (' || printf('%d-%02d', val_year, val_month) || ')' END) AS missing
FROM found""")
    fields = ", ".join(f"json_extract_string(j, '$.{c}') AS {c}" for c in
                       ("ride_id", "PULocationID", "DOLocationID", "trip_distance"))
    sql["read_json_docs"] = _with(
        PAYLOADS, f"SELECT {fields}, CASE WHEN j IS NULL THEN payload END AS corrupt_text FROM docs")
    sql["text_preview"] = """
SELECT doc_id, CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || '...' ELSE text END
  AS content, length(text) AS full_length FROM documents""".strip()
    sql["table_preview"] = _with(TRIPS, """
SELECT (SELECT count(*) FROM trips) AS row_count,
  'trip_id,tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID,passenger_count,'
  || 'trip_distance,total_amount,payment_type' AS column_names, *
FROM trips ORDER BY trip_id LIMIT 5""")
    sql["recent_events"] = _with(PAYLOADS, """
SELECT arrival_ts, payload, sequence_number FROM docs WHERE j IS NOT NULL
ORDER BY arrival_ts DESC, sequence_number DESC LIMIT 10""")
    sql["stream_rides"] = _with(PAYLOADS, """
SELECT to_base64(encode(payload)) AS data, sequence_number, arrival_ts FROM payloads""")
    sql["write_trips_month"] = _with(TRIPS, f"SELECT *, {_PICKUP_PARTS} FROM trips")
    sql["write_predictions"] = _with(ENTRIES, f"SELECT {_ENTRY_COLUMNS} FROM entries")
    sql["stream_write_predictions"] = sql["write_predictions"]
    sql["latest_predictions"] = _with(ENTRIES, f"SELECT {_ENTRY_COLUMNS} FROM latest")
    sql["export_json"] = _with(TRIPS, RIDE_EVENTS)
    sql["export_text"] = _with(TRIPS, """
SELECT trip_id || ' ' || PULocationID || ' ' || DOLocationID AS value FROM trips""")

    # ---- projections
    sql["trip_duration"] = _with(TIMED, "SELECT trip_id, duration FROM timed")
    sql["trip_duration_if_absent"] = _with(TIMED, """
SELECT trip_id, coalesce(passenger_count * CAST(1.5 AS DOUBLE), duration) AS duration FROM timed""")
    sql["cast_zone_ids"] = _with(TRIPS, """
SELECT trip_id, CAST(PULocationID AS VARCHAR) AS PULocationID,
  CAST(DOLocationID AS VARCHAR) AS DOLocationID FROM trips""")
    sql["pu_do"] = _with(TRIPS, """
SELECT trip_id, PULocationID || '_' || DOLocationID AS PU_DO FROM trips""")
    sql["training_columns"] = _with(CLEAN, "SELECT PU_DO, trip_distance, duration FROM clean")
    sql["trip_to_envelope"] = _with(TIMED, _envelopes())
    sql["trip_to_envelope_filled"] = _with(
        TIMED, _envelopes(count="coalesce(passenger_count, 1)", reason="CAST(NULL AS VARCHAR)"))
    sql["trip_to_ride_event"] = _with(TRIPS, RIDE_EVENTS)
    sql["ride_json_roundtrip"] = _with(TRIPS, """
SELECT 'ride_' || trip_id AS ride_id, PULocationID, DOLocationID, trip_distance, false AS rejected
FROM trips""")
    sql["ride_from_json"] = _with(PAYLOADS, """
, typed AS (
  SELECT sequence_number, json_extract_string(j, '$.ride_id') AS ride_id,
    TRY_CAST(json_extract_string(j, '$.PULocationID') AS INTEGER) AS PULocationID,
    TRY_CAST(json_extract_string(j, '$.DOLocationID') AS INTEGER) AS DOLocationID,
    TRY_CAST(json_extract_string(j, '$.trip_distance') AS DOUBLE) AS trip_distance FROM docs)
SELECT *, PULocationID IS NULL OR DOLocationID IS NULL OR trip_distance IS NULL AS rejected
FROM typed""")
    sql["fill_event_timestamp"] = _with(PAYLOADS, f"""
SELECT sequence_number,
  coalesce(json_extract_string(j, '$.timestamp'), {ISO.format(ts='arrival_ts')}) AS timestamp
FROM docs""")
    sql["normalize_event"] = _with(
        NORMAL, "SELECT sequence_number, pickup, dropoff, distance FROM normal")
    sql["serving_features"] = _with(REQUESTS, """
SELECT sequence_number, PULocationID, DOLocationID, trip_distance, reason FROM requests""")

    # ---- filters and validation
    sql["duration_filter"] = _with(TIMED, """
SELECT trip_id, duration FROM timed WHERE duration >= 1 AND duration <= 60""")
    sql["pickup_month_filter"] = _with(
        TRIPS, f"SELECT trip_id, tpep_pickup_datetime FROM trips WHERE {month}")
    sql["clean_trips"] = _with(CLEAN, "SELECT * FROM clean")
    sql["validate_events"] = _with(_ENVELOPE_TEXT, f"""
, checked AS (SELECT sequence_number, {_envelope_rules()} AS error FROM docs)
SELECT sequence_number, error IS NULL AS valid, error FROM checked""")
    sql["zone_range_check"] = _with(TRIPS, """
, checked AS (
  SELECT trip_id, CASE WHEN PULocationID NOT BETWEEN 1 AND 265 THEN 'pickup_location_id is not a zone'
    WHEN DOLocationID + coalesce(passenger_count, 0) NOT BETWEEN 1 AND 265
    THEN 'dropoff_location_id is not a zone' END AS error FROM trips)
SELECT trip_id, error, error IS NULL AS valid FROM checked""")
    sql["quarantine_split"] = _with(REQUESTS, """
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason,
  count(*) AS n FROM requests GROUP BY ALL""")
    part = f"ORDER BY {ORDER} LIMIT {R.SLICE_SIZE} OFFSET {R.SLICE_START}"
    sliced = TIMED + f", sliced AS (SELECT * FROM timed {part})"
    sql["load_transform_validate"] = _with(
        sliced + f", enveloped AS ({_envelopes('sliced')})", """
SELECT trip_id, event_id, reason IS NULL AS valid, reason AS error FROM enveloped""")
    sql["ride_id_lookup"] = _with(ENTRIES, f"""
SELECT {_ENTRY_COLUMNS} FROM entries WHERE year = {R.LOOKUP_DAY[0]} AND month = {R.LOOKUP_DAY[1]}
  AND day = {R.LOOKUP_DAY[2]} AND contains(ride_id, '{R.LOOKUP_TEXT}')""")

    # ---- aggregates
    sql["cleaning_funnel"] = _with(TIMED, """
SELECT CAST(year(tpep_dropoff_datetime) AS INTEGER) AS year,
  CAST(month(tpep_dropoff_datetime) AS INTEGER) AS month, count(*) AS raw_rows,
  count(*) FILTER (WHERE duration BETWEEN 1 AND 60) AS after_duration,
  count(*) FILTER (WHERE duration BETWEEN 1 AND 60 AND date_trunc('month', tpep_pickup_datetime)
                         = date_trunc('month', tpep_dropoff_datetime)) AS after_month,
  9 AS raw_columns, 11 AS clean_columns
FROM timed GROUP BY ALL""")
    sql["rmse"] = _with(EVALUATED, "SELECT round(rmse, 4) AS rmse FROM err")
    sql["rmse_gate"] = _with(
        EVALUATED, "SELECT round(rmse, 4) AS rmse, coalesce(rmse < 10, false) AS passed FROM err")
    sql["batch_outcome"] = _with(REQUESTS, f"""
SELECT sequence_number // {R.BATCH_ROWS} AS batch_id, count(*) FILTER (WHERE reason IS NULL)
  AS processed, count(*) FILTER (WHERE reason IS NOT NULL) AS failed, count(*) AS total
FROM requests GROUP BY 1""")
    sql["predictions_per_day"] = _with(ENTRIES, """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year, month, day ORDER BY ride_id) AS position
  FROM latest)
SELECT year, month, day, count(*) AS total,
  string_agg(ride_id, ',' ORDER BY ride_id) FILTER (WHERE position <= 5) AS first_ride_ids,
  greatest(count(*) - 5, 0) AS more
FROM ranked GROUP BY ALL""")
    sql["recent_predictions"] = _with(ENTRIES, f"""
SELECT {_ENTRY_COLUMNS} FROM latest
WHERE arrival_ts > TIMESTAMP '{R.REPORT_TIME}' - INTERVAL {R.REPORT_HOURS} HOUR
  AND arrival_ts <= TIMESTAMP '{R.REPORT_TIME}'""")

    # ---- samples and order
    sql["seeded_sample"] = _with(
        TRIPS, f"SELECT * FROM trips ORDER BY {ORDER} LIMIT {R.SAMPLE_ROWS}")
    sql["record_at_index"] = _with(
        TRIPS, f"SELECT * FROM trips ORDER BY {ORDER} LIMIT 1 OFFSET {R.RECORD_INDEX}")
    sql["batch_slice"] = _with(sliced, _envelopes("sliced"))
    sql["shuffled_replay"] = _with(TRIPS, RIDE_EVENTS + f" ORDER BY {ORDER}")
    sql["sort_by_event_time"] = "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id"

    # ---- scalar functions
    sql["training_months"] = _with(RUNS, f"""
SELECT o_orderkey, run_date, {_months('train', 'run_date - INTERVAL 4 MONTH')},
  {_months('val', 'run_date - INTERVAL 3 MONTH')} FROM runs""")
    sql["training_months_fallback"] = _with(RUNS, f"""
SELECT o_orderkey, run_date, {_months('train', 'run_date')},
  {_months('val', "date_trunc('month', run_date) + INTERVAL 1 MONTH")} FROM runs""")
    sql["data_month"] = _with(RUNS, f"""
SELECT o_orderkey, run_date, {_months('data', 'run_date - INTERVAL 24 MONTH')},
  strftime(run_date, '%Y-%m') AS run_month FROM runs""")
    sql["prediction_path"] = _with(REQUESTS, """
SELECT sequence_number,
  'predictions/' || strftime(arrival_ts, '%Y/%m/%d') || '/' || ride_id || '.json' AS path
FROM requests""")
    sql["iso_timestamp"] = f"""
WITH texts AS (
  SELECT event_id, ts, CASE event_id % 5
    WHEN 0 THEN {ISO.format(ts='ts')} WHEN 1 THEN {ISO.format(ts='ts')} || 'Z'
    WHEN 2 THEN {ISO.format(ts='ts')} || '+02:00' WHEN 3 THEN strftime(ts, '%Y')
    ELSE 'at ' || {ISO.format(ts='ts')} END AS text
  FROM events)
SELECT event_id, text, CASE WHEN event_id % 5 < 2 THEN ts
  WHEN event_id % 5 = 2 THEN ts - INTERVAL 2 HOUR END AS instant FROM texts""".strip()
    sql["decode_records"] = _with(PAYLOADS, """
SELECT sequence_number, CASE WHEN sequence_number % 3 <> 0 THEN payload END AS payload,
  sequence_number % 3 <> 0 AND j IS NOT NULL AS is_object,
  CASE WHEN sequence_number % 3 = 0 THEN 'payload is not base64 UTF-8 text'
       WHEN j IS NULL THEN 'payload is not a JSON object' END AS reason FROM docs""")
    sql["ensure_ride_id"] = _with(REQUESTS, "SELECT sequence_number, ride_id FROM requests")

    # ---- features and default
    vocabulary = CLEAN + f""",
vocabulary AS (
  SELECT PU_DO, row_number() OVER (ORDER BY PU_DO) - 1 AS feature_index
  FROM (SELECT DISTINCT PU_DO FROM clean WHERE {_SPLIT.format('<')}))"""
    sql["fit_features"] = _with(vocabulary, """
SELECT feature_index, 'PU_DO=' || PU_DO AS feature FROM vocabulary
UNION ALL SELECT count(*), 'trip_distance' FROM vocabulary""")
    sql["transform_features"] = _with(vocabulary, f"""
SELECT trip_id, PU_DO, feature_index AS route_index, CAST(n + 1 AS INTEGER) AS vector_size,
  CASE WHEN feature_index IS NULL THEN 1 ELSE 2 END AS n_set,
  CAST(coalesce(feature_index, n) AS INTEGER) AS first_index,
  CASE WHEN feature_index IS NULL THEN trip_distance ELSE 1 END AS first_value,
  CAST(n AS INTEGER) AS last_index, trip_distance AS last_value
FROM clean LEFT JOIN vocabulary USING (PU_DO), (SELECT count(*) AS n FROM vocabulary)
WHERE {_SPLIT.format('>=')}""")
    sql["default_prediction"] = _with(REQUESTS, """
SELECT ride_id, sequence_number, CAST(15 AS DOUBLE) AS predicted_duration, true AS is_default
FROM requests WHERE reason IS NULL""")

    split = CLEAN + f""",
means AS (SELECT avg(duration) AS mean FROM clean WHERE {_SPLIT.format('<')}),
held_out AS (SELECT * FROM clean WHERE {_SPLIT.format('>=')}),
baseline AS (
  SELECT count(*) AS n, sqrt(avg(power(duration - (SELECT mean FROM means), 2))) AS baseline_rmse
  FROM held_out),
rounds AS (SELECT CAST(unnest(range({S.BOOSTING_ROUNDS})) AS INTEGER) AS round)"""
    sql["train_duration_model"] = _with(split, f"""
SELECT round, CAST(CASE WHEN round = 0 THEN 1 ELSE {round(S.LEARNING_RATE, 6)} END AS DOUBLE)
  AS weight, round(baseline_rmse, 4) AS baseline_rmse, true AS beats_baseline
FROM rounds, baseline""")
    sql["batch_score"] = _with(split, """
SELECT n, round(baseline_rmse, 4) AS baseline_rmse, true AS beats_baseline, true AS passed
FROM baseline""")
    sql["score_or_default"] = _with(REQUESTS, """
SELECT sequence_number, ride_id, PULocationID, DOLocationID, trip_distance, arrival_ts,
  false AS is_default, true AS plausible FROM requests WHERE reason IS NULL""")
    sql["training_runs"] = "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}', true)" for k, v in asdict(R.PARAMS).items()
    ) + ") AS t(name, value, has_rmse)"
    sql["model_store"] = _with(
        CLEAN, f"SELECT trip_id, true AS same_prediction FROM clean WHERE {_SPLIT.format('>=')}")

    # ---- monitoring
    sql["envelope_ids_unique"] = "SELECT count(*) AS n, count(*) AS n_ids FROM lineitem"
    sql["dataset_catalog"] = _with(TRIPS + f""",
months AS (SELECT DISTINCT {_PICKUP_PARTS} FROM trips)""", """
SELECT year, month, true AS has_files, true AS has_bytes,
  (SELECT count(*) FROM months) AS total_months FROM months""")
    trip_columns = ("trip_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                    "DOLocationID", "passenger_count", "trip_distance", "total_amount",
                    "payment_type")
    sql["completeness"] = _with(TRIPS, " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS present, count(*) AS total, "
        f"count({c}) / CAST(count(*) AS DOUBLE) AS completeness FROM trips" for c in trip_columns))
    fences = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, min(v) FILTER (WHERE place = ceil(0.25 * n)) AS q1,
  min(v) FILTER (WHERE place = ceil(0.75 * n)) AS q3 FROM (
    SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS place, count(*) OVER () AS n FROM clean)"""
                               for c in R.FENCED)
    values = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS v FROM clean"
                                for c in R.FENCED)
    sql["outliers"] = _with(CLEAN + f", quartiles AS ({fences}), long AS ({values})", """
, fenced AS (
  SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS low, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS high
  FROM quartiles)
SELECT column_name, q1, q3, low, high, count(*) AS total,
  count(*) FILTER (WHERE v < low OR v > high) AS n_outliers
FROM fenced JOIN long USING (column_name) GROUP BY ALL""")
    binned = " UNION ALL ".join(f"""
SELECT '{name}' AS feature, tpep_pickup_datetime >= TIMESTAMP '{R.DRIFT_FROM}' AS now,
  CASE WHEN {name} < {low} THEN 0 WHEN {name} >= {high} THEN {bins + 1}
       ELSE floor(({name} - CAST({low} AS DOUBLE)) / CAST({(high - low) / bins!r} AS DOUBLE)) + 1
  END AS bin FROM clean""" for name, (low, high, bins) in R.DRIFT_EDGES.items())
    drift = CLEAN + f""", binned AS ({binned}),
counted AS (
  SELECT feature, bin, count(*) FILTER (WHERE NOT now) AS e, count(*) FILTER (WHERE now) AS a
  FROM binned WHERE bin IS NOT NULL GROUP BY ALL),
shares AS (
  SELECT feature, greatest(e / CAST(sum(e) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS e,
    greatest(a / CAST(sum(a) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS a FROM counted),
drift AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM shares GROUP BY feature)"""
    sql["feature_drift"] = _with(drift, "SELECT feature, round(psi, 6) AS psi FROM drift")
    sql["drift_alert"] = _with(drift, "SELECT feature, psi > 0.2 AS alert FROM drift")
    index = """sum((greatest(a / CAST(ta AS DOUBLE), 1e-6) - greatest(e / CAST(te AS DOUBLE), 1e-6))
  * ln(greatest(a / CAST(ta AS DOUBLE), 1e-6) / greatest(e / CAST(te AS DOUBLE), 1e-6)))"""
    sql["route_drift"] = _with(CLEAN + f""",
routes AS (
  SELECT PU_DO, count(*) FILTER (WHERE tpep_pickup_datetime < TIMESTAMP '{R.DRIFT_FROM}') AS e,
    count(*) FILTER (WHERE tpep_pickup_datetime >= TIMESTAMP '{R.DRIFT_FROM}') AS a
  FROM clean GROUP BY PU_DO),
totals AS (SELECT sum(e) AS te, sum(a) AS ta FROM routes),
bins AS (
  SELECT CASE WHEN e >= CAST({monitoring.HEAVY_SHARE} AS DOUBLE) * te THEN PU_DO END AS bin,
    sum(e) AS e, sum(a) AS a, any_value(te) AS te, any_value(ta) AS ta FROM routes, totals GROUP BY 1)""",
        f"SELECT 'PU_DO' AS feature, round({index}, 6) AS psi FROM bins")
    deciles = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, list(DISTINCT v) AS edges FROM (
  SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS place, count(*) OVER () AS n FROM clean
  WHERE tpep_pickup_datetime < TIMESTAMP '{R.DRIFT_FROM}')
WHERE list_contains(list_transform(range(1, {R.DECILES}), lambda i: CAST(ceil(i / {R.DECILES} * n)
  AS BIGINT)), place)""" for c in R.FENCED)
    unpivoted = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS v, tpep_pickup_datetime >= TIMESTAMP '{R.DRIFT_FROM}' AS now "
        "FROM clean" for c in R.FENCED)
    sql["quantile_drift"] = _with(CLEAN + f""", cut AS ({deciles}), long AS ({unpivoted}),
counted AS (
  SELECT feature, len(list_filter(edges, lambda x: x < v)) AS bin, count(*) FILTER (WHERE NOT now) AS e,
    count(*) FILTER (WHERE now) AS a FROM long JOIN cut USING (feature) GROUP BY ALL),
bins AS (
  SELECT *, sum(e) OVER (PARTITION BY feature) AS te, sum(a) OVER (PARTITION BY feature) AS ta
  FROM counted)""", f"SELECT feature, round({index}, 6) AS psi FROM bins GROUP BY feature")
    rated = CLEAN + f""",
asked AS (
  SELECT trip_id, tpep_pickup_datetime AS asked_at,
    CASE WHEN PULocationID = DOLocationID THEN 15 ELSE trip_distance / CAST(0.4 AS DOUBLE) END
      AS prediction FROM clean),
told AS (
  SELECT trip_id, duration, tpep_dropoff_datetime AS ended,
    (CAST(PULocationID AS INTEGER) + CAST(DOLocationID AS INTEGER)) % 10 AS kind FROM clean),
actuals AS (
  SELECT trip_id, duration, ended + to_minutes(CASE WHEN kind = 1 THEN {R.LATE_MINUTES}
    ELSE kind END) AS came_at FROM told WHERE kind > 0),
earliest AS (
  SELECT * FROM actuals
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY came_at, duration) = 1),
came AS (SELECT * FROM asked LEFT JOIN earliest USING (trip_id)),
closed AS (
  SELECT least((SELECT max(asked_at) FROM asked), (SELECT max(came_at) FROM actuals))
    - INTERVAL '{R.ACTUAL_DELAY}' AS closed_at),
judged AS (
  SELECT *, CASE WHEN came_at >= asked_at AND came_at <= asked_at + to_seconds({R.ACTUAL_WITHIN})
    THEN 'matched'
    WHEN pending AND asked_at + to_seconds({R.ACTUAL_WITHIN}) >= closed_at THEN 'pending'
    WHEN came_at IS NOT NULL THEN 'late' ELSE 'missing' END AS outcome
  FROM came, closed, (SELECT {{}} AS pending)),
errors AS (
  SELECT *, CASE WHEN outcome = 'matched' THEN duration END AS y,
    CASE WHEN outcome = 'matched' THEN duration - prediction END AS error FROM judged)"""
    rates = """
SELECT CAST(year(asked_at) AS INTEGER) AS year, count(*) AS n,
  count(*) FILTER (WHERE outcome = 'matched') AS n_matched,
  count(*) FILTER (WHERE outcome = 'late') AS n_late,
  count(*) FILTER (WHERE outcome = 'missing') AS n_missing,
  count(*) FILTER (WHERE outcome = 'pending') AS n_pending,
  round(sqrt(avg(error * error)), 4) AS rmse, round(avg(abs(error)), 4) AS mae,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum(error * error) / (var_pop(y) * count(y)) END, 4) AS r2
FROM errors GROUP BY 1"""
    sql["model_quality"] = _with(rated.format("false"), rates)
    sql["stream_model_quality"] = _with(rated.format("true"), rates)

    # ---- streams
    sql["stream_score"] = _with(ENTRIES, """
SELECT sequence_number, ride_id, timestamp, PULocationID, DOLocationID, trip_distance,
  false AS is_default, year, month, day, true AS same_as_batch FROM entries""")
    sql["stream_quarantine"] = _with(REQUESTS, """
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason,
  count(*) AS n, count(*) FILTER (WHERE reason IS NULL AND PULocationID = DOLocationID) AS defaults
FROM requests GROUP BY 1, 2""")
    sql["stream_ingest_validated"] = _with(TIMED + f", enveloped AS ({_envelopes()})", """
SELECT trip_id, event_id, reason AS error, reason IS NULL AS valid FROM enveloped""")
    sql["stream_latest_predictions"] = sql["latest_predictions"]
    sql["ride_id_lookup_stored"] = sql["ride_id_lookup"]
    return sql
