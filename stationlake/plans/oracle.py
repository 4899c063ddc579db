"""DuckDB-runnable oracle SQL for every registered query.

The oracles read the original test tables and re-derive the adapters with
plain SQL, so they check our Spark plans independently. Sums and averages
of doubles are taken over DECIMAL and cast back to DOUBLE on both sides,
so results do not depend on the order partial sums are merged.
"""

from __future__ import annotations


def _sid(col: str) -> str:
    return f"('ST' || lpad(CAST({col} AS VARCHAR), 9, '0'))"


ELEMENT_CASE = ("CASE l_linenumber WHEN 1 THEN 'TMAX' WHEN 2 THEN 'TMIN' WHEN 3 THEN 'TAVG' "
                "WHEN 4 THEN 'PRCP' WHEN 5 THEN 'SNOW' WHEN 6 THEN 'SNWD' WHEN 7 THEN 'WT01' END")

OBS_LI = f"""obs AS (
  SELECT {_sid('l_suppkey')} AS station_id,
         CAST(l_shipdate AS DATE) AS date,
         {ELEMENT_CASE} AS element,
         CAST(l_extendedprice AS DOUBLE) AS value,
         CAST(NULL AS VARCHAR) AS measurement_flag,
         NULLIF(l_returnflag, 'N') AS quality_flag,
         l_linestatus AS source_flag,
         CAST(NULL AS TIMESTAMP) AS observation_time,
         CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS year,
         CAST(EXTRACT(MONTH FROM l_shipdate) AS INTEGER) AS month
  FROM lineitem)"""

ST_SUP = f"""st AS (
  SELECT {_sid('s_suppkey')} AS station_id, s_name AS name,
         CAST((s_suppkey * 37) % 180 - 90 AS DOUBLE) AS latitude,
         CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS longitude,
         CAST(s_acctbal AS DOUBLE) AS elevation,
         n_name AS country, r_name AS state,
         1995 AS first_year, 2001 AS last_year
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def dsum(x: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def davg(x: str, scale: int = 2) -> str:
    return f"({dsum(x, scale)} / COUNT({x}))"


DAILY = """daily AS (
  SELECT t.*, s.name AS station_name, s.latitude, s.longitude, s.elevation, s.country, s.state
  FROM (SELECT station_id, date,
          MAX(CASE WHEN element = 'TMAX' THEN value END) AS max_temp_celsius,
          MAX(CASE WHEN element = 'TMIN' THEN value END) AS min_temp_celsius,
          MAX(CASE WHEN element = 'TAVG' THEN value END) AS avg_temp_celsius,
          MAX(CASE WHEN element = 'PRCP' THEN value END) AS precipitation_mm,
          MAX(CASE WHEN element = 'SNOW' THEN value END) AS snowfall_mm,
          MAX(CASE WHEN element = 'SNWD' THEN value END) AS snow_depth_mm
        FROM obs WHERE element IN ('TMAX', 'TMIN', 'TAVG', 'PRCP', 'SNOW', 'SNWD')
        GROUP BY station_id, date) t
  JOIN st s ON t.station_id = s.station_id)"""

MONTHLY = f"""monthly AS (
  SELECT station_id, station_name, country, state, latitude, longitude,
         CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
         CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month,
         {davg('max_temp_celsius')} AS avg_max_temp,
         {davg('min_temp_celsius')} AS avg_min_temp,
         {davg('avg_temp_celsius')} AS avg_temp,
         MAX(max_temp_celsius) AS highest_max_temp,
         MIN(min_temp_celsius) AS lowest_min_temp,
         {dsum('precipitation_mm')} AS total_precipitation,
         CAST(COUNT(date) AS BIGINT) AS days_in_month
  FROM daily
  WHERE max_temp_celsius IS NOT NULL OR min_temp_celsius IS NOT NULL OR precipitation_mm IS NOT NULL
  GROUP BY station_id, station_name, country, state, latitude, longitude,
           CAST(EXTRACT(YEAR FROM date) AS INTEGER), CAST(EXTRACT(MONTH FROM date) AS INTEGER))"""

ANNUAL_SELECT = f"""SELECT station_id, station_name, country, state, latitude, longitude, year,
         {davg('avg_max_temp', 4)} AS yearly_avg_max_temp,
         {davg('avg_min_temp', 4)} AS yearly_avg_min_temp,
         {davg('avg_temp', 4)} AS yearly_avg_temp,
         MAX(highest_max_temp) AS yearly_highest_max_temp,
         MIN(lowest_min_temp) AS yearly_lowest_min_temp,
         {dsum('total_precipitation')} AS yearly_total_precipitation,
         CAST(SUM(days_in_month) AS BIGINT) AS days_with_data
  FROM monthly {{where}}
  GROUP BY station_id, station_name, country, state, latitude, longitude, year"""

CHAIN = f"WITH {OBS_LI},\n{ST_SUP},\n{DAILY},\n{MONTHLY}"


ORACLES: dict[str, str] = {}

ORACLES["daily_summary"] = f"WITH {OBS_LI},\n{ST_SUP},\n{DAILY}\nSELECT * FROM daily"
ORACLES["monthly_summary"] = f"{CHAIN}\nSELECT * FROM monthly"
ORACLES["annual_summary"] = f"{CHAIN}\n" + ANNUAL_SELECT.format(where="")
ORACLES["temp_anomaly"] = f"""{CHAIN},
base AS (SELECT station_id, month, {davg('avg_temp', 4)} AS baseline_temp
         FROM monthly WHERE year BETWEEN 1995 AND 1997 GROUP BY station_id, month)
SELECT c.year, c.month, c.station_id, c.station_name, c.country, c.state, c.latitude, c.longitude,
       c.avg_temp, b.baseline_temp, c.avg_temp - b.baseline_temp AS temp_anomaly
FROM monthly c JOIN base b ON c.station_id = b.station_id AND c.month = b.month
WHERE c.year >= 1999"""


OBS = f"WITH {OBS_LI}\n"
OBS_COLS = ("station_id, date, element, value, measurement_flag, quality_flag, source_flag, "
            "observation_time, year, month")
ST_COLS = "station_id, name, latitude, longitude, elevation, country, state, first_year, last_year"

ORACLES["month_distribution"] = OBS + "SELECT year, month, CAST(COUNT(*) AS BIGINT) AS row_count FROM obs GROUP BY year, month"
ORACLES["dq_row_counts"] = f"""WITH {OBS_LI}, {ST_SUP}
SELECT 'stations' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM st
UNION ALL
SELECT 'observations' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM obs WHERE date = DATE '1998-06-15'"""
ORACLES["semi_join_stations"] = f"""WITH {OBS_LI}, {ST_SUP}
SELECT * FROM obs WHERE station_id IN (SELECT station_id FROM st WHERE state IN ('AMERICA', 'EUROPE'))"""
ORACLES["scan_partition_filter"] = OBS + "SELECT station_id, date, element, value FROM obs WHERE year = 1998 AND month = 1"
ORACLES["derive_partitions"] = OBS + "SELECT * FROM obs"
ORACLES["scale_units"] = OBS + """SELECT station_id, date, element,
  CASE WHEN element IN ('TMIN', 'TMAX', 'TAVG', 'PRCP') THEN value / 10.0 ELSE value END AS value FROM obs"""
ORACLES["scan_limit"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders ORDER BY o_orderkey LIMIT 10"""
ORACLES["temp_trend"] = f"""{CHAIN}
SELECT country, year, month, {davg('avg_temp', 4)} AS avg_temp, CAST(COUNT(avg_temp) AS BIGINT) AS station_months
FROM monthly GROUP BY country, year, month"""
ORACLES["region_grid"] = f"""{CHAIN}
SELECT CAST(floor(latitude / 30.0) * 30.0 AS DOUBLE) AS grid_lat, CAST(floor(longitude / 30.0) * 30.0 AS DOUBLE) AS grid_lon,
       year, {davg('avg_temp', 4)} AS avg_temp, MAX(highest_max_temp) AS highest_max_temp,
       MIN(lowest_min_temp) AS lowest_min_temp, CAST(COUNT(*) AS BIGINT) AS station_months
FROM monthly GROUP BY 1, 2, year"""
ORACLES["precip_year_over_year"] = f"""{CHAIN}
SELECT c.station_id, c.year, c.month, c.total_precipitation, p.total_precipitation AS prev_year_precipitation,
       c.total_precipitation - p.total_precipitation AS precipitation_change
FROM monthly c LEFT JOIN monthly p ON c.station_id = p.station_id AND c.month = p.month AND c.year = p.year + 1"""
ORACLES["current_vs_history"] = f"""{CHAIN},
m AS (SELECT * FROM monthly WHERE avg_temp IS NOT NULL),
latest AS (SELECT station_id, year, month, avg_temp AS latest_avg_temp FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY year DESC, month DESC) AS rn FROM m) WHERE rn = 1)
SELECT l.station_id, l.year, l.month, l.latest_avg_temp,
       CAST(SUM(CAST(h.avg_temp AS DECIMAL(38,4))) AS DOUBLE) / COUNT(h.avg_temp) AS historical_avg_temp,
       l.latest_avg_temp - CAST(SUM(CAST(h.avg_temp AS DECIMAL(38,4))) AS DOUBLE) / COUNT(h.avg_temp) AS difference
FROM latest l LEFT JOIN m h ON h.station_id = l.station_id AND h.month = l.month AND h.year < l.year
GROUP BY l.station_id, l.year, l.month, l.latest_avg_temp"""
ORACLES["temp_precip_corr"] = f"""{CHAIN}
SELECT station_id, CAST(COUNT(*) AS BIGINT) AS n_months,
       round(corr(avg_max_temp, total_precipitation), 6) AS temp_precip_corr,
       round(regr_slope(total_precipitation, avg_max_temp), 6) AS precip_per_degree
FROM monthly WHERE avg_max_temp IS NOT NULL AND total_precipitation IS NOT NULL GROUP BY station_id"""
ORACLES["annual_materialize"] = f"{CHAIN}\n" + ANNUAL_SELECT.format(where="")
ORACLES["annual_refresh"] = f"{CHAIN}\n" + ANNUAL_SELECT.format(where="WHERE year <= 2000")
ORACLES["src_parquet_declared_schema"] = OBS + "SELECT * FROM obs"
ORACLES["sink_append_stations"] = f"WITH {ST_SUP} SELECT * FROM st"
ORACLES["sink_append_partitioned"] = OBS + "SELECT * FROM obs"
ORACLES["sink_register_files"] = OBS + "SELECT * FROM obs"
ORACLES["sink_create_table"] = f"""WITH {OBS_LI}, {ST_SUP}
SELECT 'stations' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM st
UNION ALL SELECT 'observations', CAST(COUNT(*) AS BIGINT) FROM obs"""
ORACLES["describe_table"] = OBS + """SELECT * FROM (VALUES
  ('station_id', 'string', 1, false), ('date', 'date', 2, false), ('element', 'string', 3, false),
  ('value', 'double', 4, false), ('measurement_flag', 'string', 5, false), ('quality_flag', 'string', 6, false),
  ('source_flag', 'string', 7, false), ('observation_time', 'timestamp_ntz', 8, false),
  ('year', 'int', 9, true), ('month', 'int', 10, true)) v(column_name, data_type, ordinal_position, is_partition)
JOIN (UNPIVOT (SELECT CAST(COUNT(station_id) AS BIGINT) AS station_id, CAST(COUNT(date) AS BIGINT) AS date,
   CAST(COUNT(element) AS BIGINT) AS element, CAST(COUNT(value) AS BIGINT) AS value,
   CAST(COUNT(measurement_flag) AS BIGINT) AS measurement_flag, CAST(COUNT(quality_flag) AS BIGINT) AS quality_flag,
   CAST(COUNT(source_flag) AS BIGINT) AS source_flag, CAST(COUNT(observation_time) AS BIGINT) AS observation_time,
   CAST(COUNT(year) AS BIGINT) AS year, CAST(COUNT(month) AS BIGINT) AS month FROM obs)
  ON COLUMNS(*) INTO NAME column_name VALUE non_null_count) c USING (column_name)"""
ORACLES["table_files"] = OBS + "SELECT year, month, CAST(COUNT(*) AS BIGINT) AS row_count FROM obs GROUP BY year, month"
ORACLES["sink_register_outside"] = OBS + "SELECT * FROM obs"
ORACLES["annual_table"] = ORACLES["annual_refresh"]
ORACLES["monthly_summary_ordered"] = ORACLES["monthly_summary"].replace(
    "SELECT * FROM monthly", "SELECT *, row_number() OVER (ORDER BY station_id, year, month) AS position FROM monthly")
ORACLES["temp_anomaly_ordered"] = f"""SELECT *, row_number() OVER (ORDER BY year, month, station_id) AS position
FROM ({ORACLES["temp_anomaly"]})"""
ORACLES["column_profile"] = OBS + """SELECT * FROM (VALUES
  ('station_id', 'string', 1, false), ('date', 'date', 2, false), ('element', 'string', 3, false),
  ('value', 'double', 4, false), ('measurement_flag', 'string', 5, false), ('quality_flag', 'string', 6, false),
  ('source_flag', 'string', 7, false), ('observation_time', 'timestamp_ntz', 8, false),
  ('year', 'int', 9, true), ('month', 'int', 10, true)) v(column_name, data_type, ordinal_position, is_partition)
JOIN (UNPIVOT (SELECT CAST(COUNT(station_id) AS BIGINT) AS station_id, CAST(COUNT(date) AS BIGINT) AS date,
   CAST(COUNT(element) AS BIGINT) AS element, CAST(COUNT(value) AS BIGINT) AS value,
   CAST(COUNT(measurement_flag) AS BIGINT) AS measurement_flag, CAST(COUNT(quality_flag) AS BIGINT) AS quality_flag,
   CAST(COUNT(source_flag) AS BIGINT) AS source_flag, CAST(COUNT(observation_time) AS BIGINT) AS observation_time,
   CAST(COUNT(year) AS BIGINT) AS year, CAST(COUNT(month) AS BIGINT) AS month FROM obs)
  ON COLUMNS(*) INTO NAME column_name VALUE non_null_count) c USING (column_name)"""
ORACLES["compact_files"] = OBS + "SELECT * FROM obs"


# Raw-file fixtures, re-derived from the source columns (not from the text).
LI_CSV = f"""li AS (
  SELECT l_orderkey % 50 AS d, l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity, l_returnflag,
         l_linestatus, {_sid('l_suppkey')} AS station_id,
         CAST(l_shipdate AS DATE) AS date, {ELEMENT_CASE} AS element,
         CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS q,
         NULLIF(l_returnflag, 'N') AS quality_flag, l_linestatus AS source_flag,
         CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS year,
         CAST(EXTRACT(MONTH FROM l_shipdate) AS INTEGER) AS month
  FROM lineitem),
acc AS (
  SELECT station_id, date, element,
         CASE WHEN element IN ('TMIN', 'TMAX', 'TAVG', 'PRCP') THEN q / 10.0 ELSE q END AS value,
         CAST(NULL AS VARCHAR) AS measurement_flag, quality_flag, source_flag,
         CASE d WHEN 4 THEN CAST(date + INTERVAL 1 DAY AS TIMESTAMP)
                WHEN 5 THEN CAST(date AS TIMESTAMP) + INTERVAL 7 HOUR
                WHEN 6 THEN CAST(date AS TIMESTAMP) + INTERVAL 450 MINUTE END AS observation_time,
         year, month, d, l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity, l_returnflag, l_linestatus,
         CASE d WHEN 4 THEN '2400' WHEN 5 THEN '0700' WHEN 6 THEN '07:30' WHEN 7 THEN '700' ELSE '' END AS time_text
  FROM li WHERE d NOT IN (0, 2, 3))"""

ORACLES["src_observations_csv"] = f"WITH {LI_CSV}\nSELECT {OBS_COLS} FROM acc"
ORACLES["parse_dates"] = f"""WITH {LI_CSV}
SELECT station_id,
       CASE WHEN d = 2 THEN strftime(date, '%Y') || '13' || strftime(date, '%d') ELSE strftime(date, '%Y%m%d') END AS date_text,
       CASE WHEN d = 2 THEN NULL ELSE date END AS date
FROM li WHERE d <> 0"""
ORACLES["observation_time_batch"] = f"WITH {LI_CSV}\nSELECT station_id, date, element, time_text, observation_time FROM acc"
ORACLES["reject_report"] = f"""WITH {LI_CSV}
SELECT 'observations' AS source,
       CASE d WHEN 0 THEN 'too_few_fields' WHEN 2 THEN 'invalid_date' ELSE 'invalid_value' END AS reject_reason,
       CAST(COUNT(*) AS BIGINT) AS row_count
FROM li WHERE d IN (0, 2, 3) GROUP BY 2
UNION ALL
SELECT 'stations', CASE s_suppkey % 10 WHEN 7 THEN 'short_line' WHEN 3 THEN 'invalid_number' ELSE 'invalid_year' END,
       CAST(COUNT(*) AS BIGINT)
FROM supplier WHERE s_suppkey % 10 IN (3, 5, 7) GROUP BY 2"""
# (messages are added to reject_report below, once their oracle CTEs exist)
ORACLES["src_stations_fixed_width"] = f"""SELECT {_sid('s_suppkey')} AS station_id, s_name AS name,
       CAST((s_suppkey * 37) % 180 - 90 AS DOUBLE) AS latitude,
       CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS longitude,
       CASE WHEN s_suppkey % 10 = 9 THEN 0.0 ELSE CAST(floor(s_acctbal) AS DOUBLE) END AS elevation,
       CASE WHEN s_suppkey % 2 = 0 THEN 'US' ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS country,
       CASE WHEN s_suppkey % 2 = 0 THEN substr(r_name, 1, 2) ELSE '' END AS state,
       1995 AS first_year, 2001 AS last_year
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 10 NOT IN (3, 5, 7)"""


# Messages: the outcome of each event follows from event_id % 20.
EV = f"""ev AS (
  SELECT event_id, event_id % 20 AS c, {_sid('user_id')} AS station_id, CAST(ts AS DATE) AS date,
         CASE event_type WHEN 'purchase' THEN 'TMAX' WHEN 'signup' THEN 'TMIN' WHEN 'view' THEN 'TAVG'
              WHEN 'click' THEN 'PRCP' WHEN 'error' THEN 'SNOW' END AS element,
         value, ts, user_id,
         CAST(EXTRACT(YEAR FROM ts) AS INTEGER) AS year, CAST(EXTRACT(MONTH FROM ts) AS INTEGER) AS month
  FROM events),
rr AS (
  SELECT *, CASE c WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'missing_station_id' WHEN 2 THEN 'value_not_numeric'
                   WHEN 3 THEN 'invalid_date' WHEN 4 THEN 'station_id_not_string' WHEN 7 THEN 'value_wrong_type'
                   WHEN 8 THEN 'invalid_observation_time' WHEN 11 THEN 'date_not_string'
                   WHEN 12 THEN 'not_an_object' END AS reject_reason
  FROM ev),
acc_msgs AS (
  SELECT event_id, station_id, date, element, CASE WHEN c = 10 THEN 1.0 ELSE value END AS value,
         '' AS measurement_flag, '' AS quality_flag, '' AS source_flag,
         CASE WHEN c = 6 THEN NULL ELSE date_trunc('minute', ts) END AS observation_time, year, month
  FROM rr WHERE reject_reason IS NULL)"""

# Records of queue events: an envelope inside a record is not decoded, so it lacks the fields.
EVQ = EV.replace("WHEN 12 THEN 'not_an_object' END", "WHEN 12 THEN 'not_an_object' WHEN 5 THEN 'missing_station_id' END")

ORACLES["validate_messages"] = f"WITH {EV}\nSELECT event_id, reject_reason FROM rr"
ORACLES["message_status"] = f"""WITH {EV}
SELECT event_id, reject_reason,
       CASE WHEN reject_reason IS NULL THEN 200
            WHEN reject_reason IN ('value_wrong_type', 'date_not_string', 'invalid_observation_time') THEN 500
            ELSE 400 END AS status_code,
       CASE WHEN reject_reason IS NULL THEN 'Success'
            WHEN reject_reason = 'invalid_json' THEN 'Error: Invalid JSON in message'
            WHEN reject_reason IN ('value_wrong_type', 'date_not_string', 'invalid_observation_time')
                 THEN 'Error processing message'
            ELSE 'Error: Invalid message format or data' END AS status_message
FROM rr"""
ORACLES["message_batch_status"] = f"""WITH {EVQ},
b AS (SELECT event_id // 10 AS batch_id, CAST(COUNT(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) AS processed,
             CAST(COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS BIGINT) AS failed
      FROM rr GROUP BY event_id // 10)
SELECT batch_id, processed, failed,
       CASE WHEN failed > 0 AND processed = 0 THEN 500 ELSE 200 END AS status_code,
       CASE WHEN failed > 0 THEN 'Processed ' || processed || ' messages, failed ' || failed
            ELSE 'Successfully processed ' || processed || ' messages' END AS status_message
FROM b"""
ORACLES["src_envelope_base64"] = f"""WITH {EV}
SELECT event_id, c = 5 AS envelope,
       CASE WHEN c IN (0, 1, 12) THEN NULL WHEN c = 4 THEN CAST(user_id AS VARCHAR) ELSE station_id END AS station_id
FROM ev"""
ORACLES["observation_time_stream"] = f"""WITH {EV}
SELECT event_id, CASE c WHEN 6 THEN '' WHEN 8 THEN '2400' ELSE strftime(ts, '%H:%M') END AS observation_time_text,
       CASE WHEN c IN (6, 8) THEN NULL ELSE date_trunc('minute', ts) END AS observation_time
FROM rr WHERE reject_reason IS NULL OR reject_reason = 'invalid_observation_time'"""
# Files: every tenth batch lies there as plain messages, whose envelopes are decoded.
EVF = EVQ.replace("WHEN 5 THEN 'missing_station_id'", "WHEN 5 THEN CASE WHEN (event_id // 10) % 10 > 0 THEN 'missing_station_id' END")
ORACLES["src_json_file"] = f"WITH {EVF}\nSELECT {OBS_COLS} FROM acc_msgs"
ORACLES["src_message_batch"] = f"WITH {EVQ}\nSELECT event_id, {OBS_COLS} FROM acc_msgs"
ORACLES["stream_ingest"] = f"WITH {EVQ}\nSELECT event_id, {OBS_COLS} FROM acc_msgs"


# Order change log: commits 1..7 append a year each, 8 deletes, 9 updates.
ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
CHG = f"""chg AS (
  SELECT {ORD}, 'append' AS op, CAST(EXTRACT(YEAR FROM o_orderdate) - 1994 AS BIGINT) AS commit_id FROM orders
  UNION ALL
  SELECT {ORD}, 'delete', CAST(8 AS BIGINT) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 4 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, 'update', CAST(9 AS BIGINT)
  FROM orders WHERE o_orderkey % 10 = 1 AND NOT (o_orderstatus = 'P' AND o_orderkey % 4 = 0)),
commits AS (
  SELECT commit_id, CASE WHEN commit_id > 1 THEN commit_id - 1 END AS parent_id,
         CASE WHEN commit_id <= 7 THEN make_timestamp(CAST(commit_id + 1994 AS BIGINT), 12, 31, 0, 0, 0)
              ELSE make_timestamp(2002, 1, CAST(commit_id - 7 AS BIGINT), 0, 0, 0) END AS committed_at,
         CASE first_op WHEN 'append' THEN 'append' WHEN 'delete' THEN 'delete' ELSE 'overwrite' END AS operation,
         added_rows, updated_rows, deleted_rows
  FROM (SELECT commit_id, min(op) AS first_op,
               CAST(COUNT(*) FILTER (WHERE op = 'append') AS BIGINT) AS added_rows,
               CAST(COUNT(*) FILTER (WHERE op = 'update') AS BIGINT) AS updated_rows,
               CAST(COUNT(*) FILTER (WHERE op = 'delete') AS BIGINT) AS deleted_rows
        FROM chg GROUP BY commit_id))"""


def state_at(bound: str) -> str:
    return f"""(SELECT {ORD} FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY commit_id DESC) AS rn
      FROM chg WHERE commit_id <= {bound}) WHERE rn = 1 AND op <> 'delete')"""


ORACLES["asof_snapshot_id"] = f"WITH {CHG}\nSELECT * FROM {state_at('3')}"
ORACLES["asof_timestamp"] = f"""WITH {CHG}
SELECT * FROM {state_at("(SELECT max(commit_id) FROM commits WHERE committed_at <= TIMESTAMP '1999-06-30 00:00:00')")}"""
ORACLES["asof_minutes_ago"] = f"""WITH {CHG}
SELECT * FROM {state_at("(SELECT max(commit_id) FROM commits WHERE committed_at <= TIMESTAMP '2002-01-02 00:30:00' - INTERVAL 60 MINUTE)")}"""
ORACLES["asof_latest"] = f"WITH {CHG}\nSELECT * FROM {state_at('9')}"
ORACLES["asof_where_limit"] = f"""WITH {CHG}
SELECT * FROM {state_at('9')} s WHERE o_orderstatus = 'F' AND o_totalprice > 100000 ORDER BY o_orderkey LIMIT 10"""
ORACLES["list_snapshots"] = f"""WITH {CHG}
SELECT commit_id, parent_id, committed_at, strftime(committed_at, '%Y-%m-%d %H:%M:%S.%g') AS committed_at_text,
       epoch_ms(committed_at) AS timestamp_ms, operation, added_rows, updated_rows, deleted_rows, added_files,
       CAST(0 AS BIGINT) AS deleted_files,
       CAST(SUM(added_rows - deleted_rows) OVER (ORDER BY commit_id) AS BIGINT) AS total_rows,
       CAST(SUM(added_files) OVER (ORDER BY commit_id) AS BIGINT) AS total_files
FROM (SELECT *, (added_rows + updated_rows + deleted_rows + 999) // 1000 AS added_files FROM commits)"""
DIFF_SELECT = """SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change_type,
       a.o_custkey AS before_o_custkey, a.o_orderstatus AS before_o_orderstatus, a.o_totalprice AS before_o_totalprice,
       a.o_orderdate AS before_o_orderdate,
       b.o_custkey AS after_o_custkey, b.o_orderstatus AS after_o_orderstatus, b.o_totalprice AS after_o_totalprice,
       b.o_orderdate AS after_o_orderdate
FROM {a} a FULL OUTER JOIN {b} b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
   OR a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
   OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderdate IS DISTINCT FROM b.o_orderdate"""
ORACLES["version_diff"] = f"WITH {CHG}\n" + DIFF_SELECT.format(a=state_at('7'), b=state_at('9'))
ORACLES["version_restore"] = f"""WITH {CHG}, d AS ({DIFF_SELECT.format(a=state_at('7'), b=state_at('9'))})
SELECT o_orderkey,
       CASE WHEN change_type = 'added' THEN after_o_custkey ELSE before_o_custkey END AS o_custkey,
       CASE WHEN change_type = 'added' THEN after_o_orderstatus ELSE before_o_orderstatus END AS o_orderstatus,
       CASE WHEN change_type = 'added' THEN after_o_totalprice ELSE before_o_totalprice END AS o_totalprice,
       CASE WHEN change_type = 'added' THEN after_o_orderdate ELSE before_o_orderdate END AS o_orderdate,
       CASE change_type WHEN 'added' THEN 'delete' WHEN 'removed' THEN 'append' ELSE 'update' END AS op,
       CAST(10 AS BIGINT) AS commit_id
FROM d"""
BAG = """bag AS (
  SELECT l_suppkey AS suppkey, NULLIF(l_returnflag, 'N') AS flag, l_linestatus AS status, l_linenumber AS line, l_returnflag AS rf,
         EXTRACT(YEAR FROM l_shipdate) - 1994 AS commit_id
  FROM lineitem),
up AS (SELECT suppkey, flag, status, commit_id FROM bag
       UNION ALL SELECT suppkey, flag, status, 9 FROM bag WHERE rf = 'A' AND line = 2),
down AS (SELECT suppkey, flag, status, 8 AS commit_id FROM bag WHERE rf = 'R' AND line = 1)"""


def both_ways(before: str, after: str) -> str:
    return f"""SELECT suppkey, flag, status, 'added' AS change_type, CAST(COUNT(*) AS BIGINT) AS copies
FROM (({after}) EXCEPT ALL ({before})) GROUP BY ALL
UNION ALL
SELECT suppkey, flag, status, 'removed', CAST(COUNT(*) AS BIGINT)
FROM (({before}) EXCEPT ALL ({after})) GROUP BY ALL"""


def bag_at(bound: int) -> str:
    return (f"SELECT suppkey, flag, status FROM up WHERE commit_id <= {bound} "
            f"EXCEPT ALL SELECT suppkey, flag, status FROM down WHERE commit_id <= {bound}")


ORACLES["version_diff_bag"] = f"WITH {BAG}\n" + both_ways(bag_at(5), bag_at(9))
ORACLES["table_diff_bag"] = f"WITH {BAG}\n" + both_ways(
    "SELECT suppkey, flag, status FROM up WHERE commit_id <= 7", "SELECT suppkey, flag, status FROM up WHERE commit_id <> 2")
ORACLES["version_audit"] = f"""WITH {CHG}
SELECT c.commit_id, c.o_orderkey, c.o_custkey, c.o_orderstatus, c.o_totalprice, c.o_orderdate, c.op,
       m.committed_at, m.operation AS commit_operation
FROM chg c JOIN commits m ON c.commit_id = m.commit_id
WHERE c.o_orderkey IN (SELECT o_orderkey FROM chg GROUP BY o_orderkey HAVING COUNT(*) > 1)"""
FOLD = """SELECT {ord}, 'append' AS op, CAST({r} AS BIGINT) AS commit_id FROM {state}
UNION ALL SELECT {ord}, op, commit_id FROM chg WHERE commit_id > {r}"""
ORACLES["expire_older_than"] = f"""WITH {CHG}
{FOLD.format(ord=ORD, r="(SELECT COALESCE(MIN(commit_id) FILTER (WHERE committed_at >= TIMESTAMP '2001-06-01 00:00:00'), MAX(commit_id)) FROM commits)", state=state_at("(SELECT COALESCE(MIN(commit_id) FILTER (WHERE committed_at >= TIMESTAMP '2001-06-01 00:00:00'), MAX(commit_id)) FROM commits)"))}"""
ORACLES["expire_retain_last"] = f"""WITH {CHG}
{FOLD.format(ord=ORD, r="(SELECT MIN(commit_id) FROM (SELECT commit_id FROM commits ORDER BY commit_id DESC LIMIT 2))", state=state_at("(SELECT MIN(commit_id) FROM (SELECT commit_id FROM commits ORDER BY commit_id DESC LIMIT 2))"))}"""


# JOB-1: parsed stations x accepted CSV observations of loaded stations -> annual.
ST_FW = ORACLES["src_stations_fixed_width"]
ORACLES["daily_job"] = (f"WITH {LI_CSV},\nst AS ({ST_FW}),\n"
                        f"obs AS (SELECT * FROM acc WHERE station_id IN (SELECT station_id FROM st)),\n"
                        f"{DAILY},\n{MONTHLY}\n" + ANNUAL_SELECT.format(where=""))

ORACLES["daily_job_rerun"] = ORACLES["daily_job"]

ORACLES["reject_report"] = ORACLES["reject_report"].replace(f"WITH {LI_CSV}", f"WITH {LI_CSV},\n{EV}", 1) + """
UNION ALL
SELECT 'messages', reject_reason, CAST(COUNT(*) AS BIGINT) FROM rr WHERE reject_reason IS NOT NULL GROUP BY 2"""
