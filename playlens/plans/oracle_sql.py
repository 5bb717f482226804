"""DuckDB SQL for every query of ``catalog``: the correctness oracle.

Written from the definitions, not from the Spark plans: pairing is the direct
join of each start with every later finish plus ``min`` (as the original
pipelines did it), the full-weight scoring uses a real FULL OUTER JOIN, and so
on. Thresholds, weights and labels are written out here. The views ``lineitem orders part customer`` are expected to exist.
"""

from __future__ import annotations

from playlens.plans.catalog import COHORT, FILTER_AGE, FILTER_GENDER, MONTHLY

# fixed values: classes, thresholds (fraction x 30 days in double arithmetic) and weights
LABELS = ("active", "semiactive", "rare", "inactive")
THRESHOLDS = (3.0, 1.7999999999999998, 0.8999999999999999, 0.0)
ABSOLUTE = (("active", 5.0), ("semiactive", 3.0), ("rare", 1.0), ("not active", 0.0))
WEIGHTS = (0.0, 0.33, 0.67, 1.0)

START, FINISH, CONNECT = "'ITEM_PLAY_STARTED'", "'ITEM_PLAY_FINISHED'", "'DEVICE_FIRST_TIME_CONNECTED'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ymd(s: str) -> tuple[str, str, str]:
    d = f"split_part({s}, 'T', 1)"
    return tuple(f"try_cast(split_part({d}, '-', {i}) AS INTEGER)" for i in (1, 2, 3))  # type: ignore[return-value]


def _ym(s: str) -> str:
    y, m, _ = _ymd(s)
    return f"({y} * 12 + {m} - 1)"


def _day(s: str) -> str:
    return _ymd(s)[2]


def _tp(s: str) -> str:
    return f"split_part({s}, 'T', 2)"


def _from_idx(idx: str, day: str, tp: str) -> str:
    y = f"CAST(floor(({idx}) / 12.0) AS BIGINT)"
    m = f"(({idx}) - 12 * {y} + 1)"
    return (f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || "
            f"lpad(CAST({day} AS VARCHAR), 2, '0') || 'T' || {tp})")


def _tod(s: str) -> str:
    hms = f"split_part(split_part({s}, 'T', 2), '.', 1)"
    h, m, x = (f"try_cast(split_part({hms}, ':', {i}) AS INTEGER)" for i in (1, 2, 3))
    return f"({h} * 3600 + {m} * 60 + {x})"


def _dn(s: str) -> str:
    y, m, d = _ymd(s)
    return f"({y} * 365 + {m} * 30 + {d})"


def _len(x: str, strict: bool = False) -> str:
    m = f"try_cast(split_part({x}, ':', 1) AS INTEGER)"
    s = f"try_cast(split_part({x}, ':', 2) AS INTEGER)"
    if not strict:
        return f"CAST({m} * 60 + {s} AS INTEGER)"
    return (f"CAST(CASE WHEN {m} BETWEEN 0 AND 59 AND {s} BETWEEN 0 AND 59 "
            f"AND len(string_split({x}, ':')) = 2 THEN {m} * 60 + {s} END AS INTEGER)")


def _epoch_text(s: str) -> str:
    return (f"(CAST(date_diff('day', DATE '1970-01-01', try_cast(split_part({s}, 'T', 1) AS DATE)) AS BIGINT)"
            f" * 86400 + {_tod(s)})")


def _item(p: str) -> str:
    return f"CASE WHEN json_valid({p}) THEN split_part(json_extract_string({p}, '$.item_name'), '.', 1) END"


def _flag(p: str) -> str:
    return (f"coalesce(CASE WHEN json_valid({p}) THEN "
            f"trim(json_extract_string({p}, '$.did_reach_end_of_stream')) END = 'true', false)")


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _activity(count: str, thresholds, labels, otherwise: str = "null") -> str:
    arms = " ".join(f"WHEN {count} >= {_d(t)} THEN {_q(lbl)}" for t, lbl in zip(thresholds, labels))
    return f"CASE {arms} ELSE {_q(otherwise)} END"


def _weight(p: str, full: bool) -> str:
    w1, w2, w3, w4 = (_d(w) for w in WEIGHTS)
    q = (f"WHEN {p} >= 0.0 AND {p} < 0.25 THEN {w1} WHEN {p} >= 0.25 AND {p} < 0.5 THEN {w2} "
         f"WHEN {p} >= 0.5 AND {p} < 0.75 THEN {w3}")
    if full:
        return f"CASE {q} ELSE {w4} END"
    return f"CASE {q} WHEN {p} >= 0.75 AND {p} <= 1.0 THEN {w4} END"


def _ctes() -> str:
    c, m = COHORT, MONTHLY
    cap_active = (f"CASE WHEN duration >= length THEN 1 WHEN length >= {c.long_item_duration_threshold} AND "
                  f"CAST(duration AS DOUBLE) / CAST(length AS DOUBLE) >= {_d(c.long_item_active_percentage)} "
                  f"THEN 1 ELSE 0 END")
    m_active = (f"CASE WHEN duration >= length THEN 1 WHEN length > {m.long_item_duration_threshold} AND "
                f"CAST(duration AS DOUBLE) / CAST(length AS DOUBLE) > {_d(m.long_item_active_percentage)} "
                f"THEN 1 ELSE 0 END")
    off = "l_linenumber * 12000 + (l_orderkey * 7919) % 3600"
    iso = "'%Y-%m-%dT%H:%M:%S'"
    return f"""
plays AS (
  SELECT l_orderkey AS ok, CAST(o_custkey AS VARCHAR) AS device_id,
         'item' || CAST(l_partkey % 20 AS VARCHAR) || '.mp3' AS nm,
         l_returnflag = 'A' AS flag,
         l_shipdate + to_seconds(CAST({off} AS BIGINT)) AS st,
         l_shipdate + to_seconds(CAST({off} + CAST(l_quantity AS INTEGER) * 13 AS BIGINT)) AS en
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
play_log AS (
  SELECT ok, device_id, {START} AS event,
         CASE WHEN ok % 101 = 0 THEN NULL WHEN ok % 107 = 0 THEN 'not json' WHEN ok % 109 = 0 THEN '{{"category":"Songs"}}'
              ELSE '{{"category":"Songs","item_name":"' || nm || '"}}' END AS payload,
         CASE WHEN ok % 103 <> 0 THEN strftime(st, {iso}) END AS time FROM plays
  UNION ALL
  SELECT ok, CASE WHEN ok % 127 <> 0 THEN device_id END, {FINISH},
         CASE WHEN ok % 113 = 0 THEN '{{"item_name":'
              ELSE '{{"did_reach_end_of_stream":' || CASE WHEN flag THEN 'true' ELSE 'false' END
                   || ',"category":"Songs","item_name":"' || nm || '"}}' END,
         strftime(en, {iso}) FROM plays),
first_day AS (
  SELECT device_id, CAST(substr(min(time), 1, 10) AS DATE) AS day FROM play_log
  WHERE event = {START} AND device_id IS NOT NULL AND time IS NOT NULL GROUP BY device_id),
log AS (
  SELECT device_id, event, payload, time FROM play_log
  UNION ALL SELECT device_id, event, payload, time FROM play_log WHERE ok % 50 = 0
  UNION ALL SELECT device_id, {CONNECT}, '', strftime(day, '%Y-%m-%dT00:00:00') FROM first_day
  UNION ALL SELECT device_id, {CONNECT}, '', strftime(day + INTERVAL 40 DAY, '%Y-%m-%dT00:00:00') FROM first_day
            WHERE CAST(device_id AS BIGINT) % 3 = 0),
content AS (
  SELECT CASE k WHEN 17 THEN 'item17x' WHEN 19 THEN 'item5' ELSE 'item' || CAST(k AS VARCHAR) END AS title,
         CASE WHEN k = 13 THEN 'abc' ELSE
         CAST(size * 13 // 60 AS VARCHAR) || ':' || lpad(CAST(size * 13 % 60 AS VARCHAR), 2, '0') END AS length
  FROM (SELECT p_partkey % 20 AS k, arg_max(p_size, p_partkey) AS size FROM part GROUP BY p_partkey % 20) g),
profile AS (
  SELECT CASE WHEN c_custkey % 10 = 7 THEN 'x' ELSE '' END || CAST(c_custkey AS VARCHAR) AS device_id,
         CAST(1 + c_nationkey % 6 AS VARCHAR) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
  FROM customer),
ftu AS (
  SELECT device_id, setup_time,
         CAST({_ym('setup_time')} - {_ym(_q(c.reference_date))} AS INTEGER) AS shift_factor,
         {_from_idx(f"{_ym('setup_time')} + {c.analysis_duration // 30}", _day('setup_time'), _tp('setup_time'))} AS cutoff
  FROM (SELECT device_id, min(time) AS setup_time FROM log
        WHERE event = {CONNECT} AND time < {_q(c.cutoff_date)} AND time > {_q(c.reference_date)}
          AND device_id IS NOT NULL
        GROUP BY device_id) x),
shifted AS (
  SELECT l.device_id, l.event, l.payload, l.time,
         {_from_idx(f"{_ym('l.time')} - f.shift_factor", _day('l.time'), _tp('l.time'))} AS time_shifted,
         {_from_idx(f"{_ym('f.setup_time')} - f.shift_factor", _day('f.setup_time'), _tp('f.setup_time'))} AS reference
  FROM log l JOIN ftu f ON l.device_id = f.device_id
  WHERE l.time BETWEEN f.setup_time AND f.cutoff),
cap_ev AS (
  SELECT DISTINCT device_id, {_item('payload')} AS item_name, reference, time_shifted AS t,
         event = {FINISH} AS is_end
  FROM shifted WHERE event IN ({START}, {FINISH})),
cap_sessions AS (
  SELECT s.device_id, s.t AS start_time, s.item_name, min(e.t) AS end_time, s.reference
  FROM cap_ev s JOIN cap_ev e
    ON e.device_id = s.device_id AND e.item_name = s.item_name AND e.reference = s.reference AND e.t > s.t
  WHERE NOT s.is_end AND e.is_end
  GROUP BY s.device_id, s.t, s.item_name, s.reference),
cap_bucketed AS (
  SELECT device_id, start_time, item_name, end_time,
         CAST(floor(({_dn('start_time')} - {_dn('reference')}) / {float(c.bin_duration)!r}) + 1 AS INTEGER) AS bucket
  FROM cap_sessions),
cap_priced AS (
  SELECT * FROM (
    SELECT b.device_id, b.start_time, b.item_name, b.end_time, b.bucket, c.title,
           {_len('c.length')} AS length,
           CAST({_tod('b.end_time')} - {_tod('b.start_time')} AS INTEGER) AS duration
    FROM cap_bucketed b JOIN content c ON b.item_name = c.title) x
  WHERE duration >= 0 AND duration <= length),
cap_usage AS (
  SELECT device_id, bucket, CAST(sum({cap_active}) AS BIGINT) AS "count"
  FROM cap_priced GROUP BY device_id, bucket),
cap_typed AS (
  SELECT device_id, bucket, "count", {_activity('"count"', THRESHOLDS, LABELS)} AS activity_type
  FROM cap_usage),
cap_segments AS (
  SELECT p.age, p.gender, u.activity_type, u.bucket, count(*) AS "count"
  FROM cap_typed u JOIN profile p ON u.device_id = p.device_id
  GROUP BY p.age, p.gender, u.activity_type, u.bucket),
cap_play_counts AS (
  SELECT device_id, bucket, count(*) AS "Activity Count" FROM cap_bucketed GROUP BY device_id, bucket),
dash AS (
  SELECT CAST(bucket AS INTEGER) AS time_period, try_cast(age AS INTEGER) AS age, gender,
         activity_type AS type, CAST("count" AS BIGINT) AS "count"
  FROM cap_segments),
scp_ev AS (
  SELECT DISTINCT device_id, {_item('payload')} AS item_name, try_cast(time AS TIMESTAMP) AS t,
         event = {FINISH} AS is_end,
         CASE WHEN event = {FINISH} THEN {_flag('payload')} END AS flag
  FROM log WHERE event IN ({START}, {FINISH})),
scp_sessions AS (
  SELECT s.device_id, s.item_name, s.t AS "start", min(e.t) AS "end", e.flag AS reach_end_of_stream
  FROM scp_ev s JOIN scp_ev e ON e.device_id = s.device_id AND e.item_name = s.item_name AND e.t >= s.t
  WHERE NOT s.is_end AND e.is_end
  GROUP BY s.device_id, s.item_name, s.t, e.flag),
scp_played AS (
  SELECT device_id, split_part(item_name, '.', 1) AS item_name,
         CAST(floor(epoch("end")) AS BIGINT) - CAST(floor(epoch("start")) AS BIGINT) AS played
  FROM scp_sessions),
content_len AS (SELECT title, {_len('length', strict=True)} AS len FROM content),
scp_scored AS (
  SELECT device_id, item_name, pct AS "PercentPlayed", weight FROM (
    SELECT device_id, item_name, pct, {_weight('pct', full=False)} AS weight FROM (
      SELECT s.device_id, s.item_name,
             CASE WHEN c.len = 0 THEN NULL ELSE CAST(s.played AS DOUBLE) / CAST(c.len AS DOUBLE) END AS pct
      FROM scp_played s JOIN content_len c ON s.item_name = c.title) x) y
  WHERE weight IS NOT NULL),
scp_scored_full AS (
  SELECT device_id, item_name, pct AS "PercentPlayed", {_weight('pct', full=True)} AS weight FROM (
    SELECT s.device_id, coalesce(s.item_name, c.title) AS item_name,
           CASE WHEN c.len = 0 THEN NULL ELSE CAST(s.played AS DOUBLE) / CAST(c.len AS DOUBLE) END AS pct
    FROM scp_played s FULL OUTER JOIN content_len c ON s.item_name = c.title) x),
m_ftu AS (
  SELECT device_id, min(time) AS setup_time FROM log
  WHERE event = {CONNECT} AND time < {_q(m.cutoff_date)} AND time > {_q(m.reference_date)}
    AND device_id IS NOT NULL
  GROUP BY device_id),
m_shift AS (
  SELECT device_id, CAST({_ym('setup_time')} - {_ym(_q(m.reference_date))} AS INTEGER) AS shift_factor FROM m_ftu),
m_ev AS (
  SELECT DISTINCT l.device_id, {_item('l.payload')} AS item_name, f.shift_factor, l.time AS t,
         l.event = {FINISH} AS is_end
  FROM log l JOIN m_shift f ON l.device_id = f.device_id
  WHERE l.event IN ({START}, {FINISH})),
m_pairs AS (
  SELECT s.device_id, s.t AS start_time, s.item_name, min(e.t) AS end_time, s.shift_factor
  FROM m_ev s JOIN m_ev e ON e.device_id = s.device_id AND e.item_name = s.item_name AND e.t > s.t
  WHERE NOT s.is_end AND e.is_end
  GROUP BY s.device_id, s.t, s.item_name, s.shift_factor),
m_sessions AS (
  SELECT device_id, start_time, item_name, end_time, month FROM (
    SELECT *, CAST({_ym('shifted')} - {_ym(_q(m.reference_date))} AS INTEGER) AS month
    FROM (SELECT *, {_from_idx(f"{_ym('start_time')} - shift_factor", _day('start_time'), _tp('start_time'))} AS shifted
          FROM m_pairs) w) x
  WHERE month > 0 AND month <= {m.analysis_duration}),
m_usage AS (
  SELECT device_id, month, CAST(sum({m_active}) AS BIGINT) AS "count" FROM (
    SELECT s.device_id, s.month, {_len('c.length')} AS length,
           CAST({_epoch_text('s.end_time')} - {_epoch_text('s.start_time')} AS INTEGER) AS duration
    FROM m_sessions s JOIN content c ON s.item_name = c.title) x
  WHERE length IS NOT NULL AND duration IS NOT NULL
  GROUP BY device_id, month)
"""


def _with(select: str) -> str:
    return f"WITH {_ctes()}\n{select}"


def oracle_sql() -> dict[str, str]:
    abs_labels = [lbl for lbl, _ in ABSOLUTE]
    abs_thr = [t for _, t in ABSOLUTE]
    chart = ", ".join(f'CAST(sum(CASE WHEN type = {_q(t)} THEN "count" END) AS BIGINT) AS "{t}"'
                      for t in (*LABELS, "null"))
    play_types = ("item_name", "reach_end_of_stream")
    return {
        "read_clean_log": _with(
            "SELECT DISTINCT * FROM log WHERE device_id IS NOT NULL AND event IS NOT NULL "
            "AND payload IS NOT NULL AND time IS NOT NULL"),
        "content_map_load": _with(
            f"SELECT title, length, {_len('length')} AS length_seconds, "
            f"{_len('length', strict=True)} AS length_seconds_strict FROM content"),
        "profile_load": _with("SELECT device_id, age, gender FROM profile"),
        "usage_input_load": _with(
            'SELECT try_cast(device_id AS INTEGER) AS "Device ID", '
            'try_cast(substr(item_name, 5, 10) AS INTEGER) AS "Content ID", '
            'CAST(bucket AS VARCHAR) AS "Time Period" FROM cap_bucketed'),
        "event_filter": _with(f"SELECT * FROM log WHERE event IN ({START}, {FINISH})"),
        "mixed_schema_log": _with(f"SELECT * FROM log WHERE event IN ({START}, {FINISH})"),
        "first_time_users": _with("SELECT device_id, setup_time, shift_factor, cutoff FROM ftu"),
        "shifted_log": _with("SELECT * FROM shifted"),
        "parse_payload": _with(
            f"SELECT device_id, event, time, {_item('payload')} AS {play_types[0]}, "
            f"{_flag('payload')} AS {play_types[1]} FROM log WHERE event IN ({START}, {FINISH})"),
        "parse_payload_tolerant": _with(
            f"SELECT device_id, event, time, {_item('payload')} AS {play_types[0]}, "
            f"{_flag('payload')} AS {play_types[1]} FROM log WHERE event IN ({START}, {FINISH})"),
        "split_item_names": _with(
            "SELECT device_id, event, time, nullif(rtrim(ltrim(split_part(payload, ':', "
            f"CASE WHEN event = {FINISH} THEN 4 ELSE 3 END), '\"'), '\"}}'), '') AS item_name "
            f"FROM log WHERE event IN ({START}, {FINISH}) AND payload LIKE '%category%'"),
        "pair_plays_strict": _with("SELECT * FROM cap_sessions"),
        "pair_plays_by_flag": _with("SELECT * FROM scp_sessions"),
        "day_bucket": _with("SELECT * FROM cap_bucketed"),
        "priced_sessions": _with("SELECT * FROM cap_priced"),
        "usage_counts": _with("SELECT * FROM cap_usage"),
        "resumed_usage": _with("SELECT * FROM cap_usage"),
        "incremental_usage": _with("SELECT * FROM cap_usage"),
        "play_counts": _with("SELECT * FROM cap_play_counts"),
        "activity_types": _with("SELECT * FROM cap_typed"),
        "activity_types_absolute": _with(
            f'SELECT *, {_activity(chr(34) + "Activity Count" + chr(34), abs_thr, abs_labels)} AS "Activity Type" '
            f"FROM cap_play_counts"),
        "users_by_segment": _with("SELECT * FROM cap_segments"),
        "monthly_sessions": _with("SELECT * FROM m_sessions"),
        "monthly_actives": _with(
            'SELECT month, active, non_active, CAST(active AS DOUBLE) / CAST(active + non_active AS DOUBLE) '
            'AS active_share FROM (SELECT month, count(*) FILTER (WHERE "count" >= '
            f'{MONTHLY.active_threshold}) AS active, count(*) FILTER (WHERE "count" < '
            f'{MONTHLY.active_threshold}) AS non_active FROM m_usage GROUP BY month) x '
            "WHERE active > 0 AND non_active > 0"),
        "scored_plays": _with("SELECT * FROM scp_scored"),
        "scored_plays_full_weight": _with("SELECT * FROM scp_scored_full"),
        "content_popularity": _with(
            "SELECT s.item_name, p.age, p.gender, "
            "CAST(0.33 AS DOUBLE) * CAST(count(*) FILTER (WHERE s.weight = CAST(0.33 AS DOUBLE)) AS DOUBLE) "
            "+ CAST(0.67 AS DOUBLE) * CAST(count(*) FILTER (WHERE s.weight = CAST(0.67 AS DOUBLE)) AS DOUBLE) "
            "+ CAST(count(*) FILTER (WHERE s.weight = 1) AS DOUBLE) AS weighted_sum "
            "FROM scp_scored s JOIN profile p ON s.device_id = p.device_id "
            "GROUP BY s.item_name, p.age, p.gender"),
        "rollup_gender": _with(
            'SELECT gender, time_period, type, CAST(sum("count") AS BIGINT) AS "count" FROM dash '
            "GROUP BY gender, time_period, type"),
        "rollup_age": _with(
            'SELECT age, time_period, type, CAST(sum("count") AS BIGINT) AS "count" FROM dash '
            "GROUP BY age, time_period, type"),
        "segmentations": _with(
            "SELECT CASE WHEN grouping(age) = 0 AND grouping(gender) = 0 THEN 'age and gender' "
            "WHEN grouping(age) = 0 THEN 'age' ELSE 'gender' END AS segmentation, age, gender, time_period, "
            "CASE WHEN grouping(type) = 1 THEN 'all' ELSE type END AS type, "
            'CAST(sum("count") AS BIGINT) AS "count" FROM dash GROUP BY GROUPING SETS '
            "((age, time_period, type), (age, time_period), (gender, time_period, type), "
            "(gender, time_period), (age, gender, time_period, type), (age, gender, time_period))"),
        "select_age": _with(
            'SELECT age, time_period, type, CAST(sum("count") AS BIGINT) AS "count" FROM dash '
            f"WHERE age = {FILTER_AGE} GROUP BY age, time_period, type"),
        "select_gender": _with(
            'SELECT gender, time_period, type, CAST(sum("count") AS BIGINT) AS "count" FROM dash '
            f"WHERE gender = {_q(FILTER_GENDER)} GROUP BY gender, time_period, type"),
        "content_map_parquet": _with("SELECT title, length FROM content"),
        "parquet_sink": _with("SELECT device_id, bucket, count FROM cap_usage"),
        "single_parquet_sink": _with("SELECT gender, age, bucket, count FROM cap_segments WHERE activity_type = 'active'"),
        "csv_sink": _with("SELECT age, gender, activity_type, CAST(bucket AS VARCHAR) AS bucket, "
                          'CAST("count" AS VARCHAR) AS "count" FROM cap_segments'),
        "segment_filter": _with(
            f"SELECT * FROM dash WHERE age = {FILTER_AGE} AND gender = {_q(FILTER_GENDER)}"),
        "activity_chart": _with(f"SELECT time_period, {chart} FROM dash GROUP BY time_period"),
        "rejects": _with(
            f"SELECT * FROM (SELECT 'log' AS source, device_id AS id, time, "
            f"CASE WHEN payload IS NULL OR NOT json_valid(payload) THEN 'payload is not JSON' "
            f"WHEN json_extract_string(payload, '$.item_name') IS NULL THEN 'no item_name' "
            f"WHEN try_cast(time AS TIMESTAMP) IS NULL THEN 'time is not readable' "
            f"WHEN device_id IS NULL THEN 'no device_id' END AS reason "
            f"FROM log WHERE event IN ({START}, {FINISH})) x WHERE reason IS NOT NULL "
            f"UNION ALL SELECT 'content', title, CAST(NULL AS VARCHAR), 'length is not M:SS' "
            f"FROM content WHERE {_len('length')} IS NULL"),
        "unreadable_lines": (
            "SELECT 'profile' AS source, 'F,' || c_custkey AS line, TRUE AS file_known FROM customer WHERE c_custkey % 11 = 0 "
            "UNION ALL SELECT 'profile', 'M,' || c_custkey || ',' || c_nationkey || ',more', TRUE FROM customer "
            "WHERE c_custkey % 11 <> 0 AND c_custkey % 13 = 0 "
            "UNION ALL SELECT 'content', 'item' || p_partkey, TRUE FROM part WHERE p_partkey % 17 = 0 "
            "UNION ALL SELECT 'usage', c_custkey || ',' || CASE WHEN c_custkey % 7 = 0 THEN 'd' ELSE '' END || c_custkey || ',' "
            "|| CASE WHEN c_custkey % 19 = 0 THEN '1.5' ELSE CAST(c_nationkey AS VARCHAR) END || ',1', TRUE FROM customer "
            "WHERE c_custkey % 7 = 0 OR c_custkey % 19 = 0"),
    }
