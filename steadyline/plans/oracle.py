"""The same queries as DuckDB SQL, stated independently of the Spark plans."""

from __future__ import annotations

from steadyline.plans.adapter import LATE_SEC, LINES, WIDE_CUTOFF_SEC


def _direction(code: str = "updn_line") -> str:
    return f"(CASE {code} WHEN '0' THEN '상행' WHEN '1' THEN '하행' ELSE '미상' END)"


def _band(ts: str) -> str:
    return f"""(CASE WHEN hour({ts}) BETWEEN 5 AND 6 THEN '새벽' WHEN hour({ts}) BETWEEN 7 AND 9 THEN '출근'
 WHEN hour({ts}) BETWEEN 10 AND 16 THEN '점심' WHEN hour({ts}) BETWEEN 17 AND 19 THEN '퇴근' ELSE '밤' END)"""


def _day_type(ts: str) -> str:
    return f"(CASE dayofweek({ts}) WHEN 0 THEN '휴일' WHEN 6 THEN '토요일' ELSE '평일' END)"


def _week_tag(ts: str) -> str:
    return f"(CASE WHEN dayofweek({ts}) = 0 THEN '3' WHEN dayofweek({ts}) = 6 THEN '2' WHEN {ts} IS NOT NULL THEN '1' END)"


def _inout_tag(code: str = "updn_line") -> str:
    return f"(CASE {code} WHEN '0' THEN '1' WHEN '1' THEN '2' END)"


_FIELDS = """event_id, line, subway_id, train_no, statn_id, statn_nm, statn_tnm, updn_line,
 train_sttus, direct_at, lstcar_at, recptn_dt"""

_VIEWS = {
    "base": """
 SELECT event_id AS seq, ts, value AS amount, user_id, event_type,
  CASE user_id % 3 WHEN 0 THEN '1호선' WHEN 1 THEN '2호선' ELSE '9호선' END AS line,
  CASE user_id % 3 WHEN 0 THEN '1001' WHEN 1 THEN '1002' ELSE '1009' END AS subway_id,
  CAST(user_id AS VARCHAR) AS train_no,
  CASE WHEN event_id % 89 <> 0
   THEN 'S' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) END AS statn_id,
  'station-' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS statn_nm,
  'station-' || (user_id % 10) AS statn_tnm,
  CASE WHEN event_id % 97 = 0 THEN '2' ELSE CAST(event_id % 2 AS VARCHAR) END AS updn_line,
  CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '1' WHEN 'purchase' THEN '2'
   ELSE '3' END AS train_sttus,
  CASE WHEN value > 100 THEN '1' ELSE '0' END AS direct_at,
  '0' AS lstcar_at,
  CASE WHEN event_id % 100 = 0 THEN '' WHEN event_id % 103 = 0 THEN 'bad-time'
   WHEN event_id % 107 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS recptn_dt,
  ts + to_seconds(event_id % 7) AS ingested_at
 FROM events""",
    "positions": """
 SELECT *, train_no || '-' || coalesce(statn_id, '') || '-' || train_sttus || '-'
   || coalesce(substring(recptn_dt, 1, 10), '') AS event_id,
  substring(recptn_dt, 1, 10) AS dt FROM base""",
    "records": """
 SELECT * FROM (
  SELECT *, CAST(to_json(struct_pack(event_id := event_id, line := line, subway_id := subway_id,
   train_no := train_no, statn_id := statn_id, statn_nm := statn_nm, statn_tnm := statn_tnm,
   updn_line := updn_line, train_sttus := train_sttus, direct_at := direct_at,
   lstcar_at := lstcar_at, recptn_dt := recptn_dt,
   ingested_at := strftime(ingested_at, '%Y-%m-%dT%H:%M:%S'))) AS VARCHAR) AS raw_json
  FROM positions)
 WHERE seq % 211 <> 0 AND seq % 223 <> 0""",
    "latest": """
 SELECT * FROM records
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq DESC) = 1""",
    "timed": """
 SELECT *, TRY_CAST(recptn_dt AS TIMESTAMP) AS recptn_ts FROM positions
 WHERE statn_id IS NOT NULL AND recptn_dt IS NOT NULL AND recptn_dt <> ''""",
    "arrivals": """
 SELECT line, train_no, statn_id, statn_nm, statn_tnm, updn_line, direct_at, seq,
  recptn_ts AS arrival_ts, strftime(recptn_ts, '%Y-%m-%d') AS dt
 FROM timed WHERE recptn_ts IS NOT NULL
 QUALIFY statn_id IS DISTINCT FROM lag(statn_id)
  OVER (PARTITION BY train_no ORDER BY recptn_ts, seq)""",
    "labelled": f"""
 SELECT *, {_direction()} AS direction, {_band('arrival_ts')} AS time_band,
  {_day_type('arrival_ts')} AS day_type, CAST(floor(epoch(arrival_ts)) AS BIGINT) AS sec
 FROM arrivals""",
    "freshness": """
 SELECT line, date_trunc('minute', TRY_CAST(recptn_dt AS TIMESTAMP)) AS minute_ts,
  count(*) AS records, count(DISTINCT train_no) AS distinct_trains,
  round(avg(CAST(floor(epoch(ingested_at)) AS BIGINT)
   - CAST(floor(epoch(TRY_CAST(recptn_dt AS TIMESTAMP))) AS BIGINT)), 1) AS ingest_lag_avg_sec
 FROM positions WHERE recptn_dt IS NOT NULL AND recptn_dt <> '' GROUP BY 1, 2""",
    "gaps": """
 SELECT line, minute_ts, CAST(epoch(minute_ts) - lag(epoch(minute_ts))
  OVER (PARTITION BY line ORDER BY minute_ts NULLS FIRST) AS DOUBLE) / 60 AS gap_min
 FROM freshness""",
    "timetable": """
 SELECT event_id AS seq, '09호선' AS line,
  'C' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS station_cd,
  '9' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS fr_code,
  'station-' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS station_nm,
  'C' || user_id AS train_no,
  CASE WHEN hour(ts) < 2 AND event_id % 2 = 0 THEN (hour(ts) + 24) || strftime(ts, ':%M:%S')
   ELSE strftime(ts, '%H:%M:%S') END AS arrive_time,
  CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%H:%M:%S') ELSE '' END AS left_time,
  '0901' AS origin_station, '0938' AS dest_station, 'first' AS origin_nm, 'last' AS dest_nm,
  {week_tag} AS week_tag, CAST(event_id % 2 + 1 AS VARCHAR) AS inout_tag,
  CASE WHEN value > 100 THEN 'E' ELSE 'G' END AS express_yn, '' AS fl_flag,
  CASE WHEN event_id % 3 <> 0 THEN '0' ELSE '' END AS branch_line
 FROM events WHERE event_type = 'signup'""".replace("{week_tag}", _week_tag("(ts - INTERVAL 3 HOUR)")),
    "stations": """
 SELECT station_cd, fr_code, station_nm FROM (
  SELECT 'C' || (s_suppkey % 12) AS station_cd, s_suppkey,
   CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 12 AS VARCHAR) ELSE '' END AS fr_code,
   s_name AS station_nm FROM supplier WHERE s_suppkey % 3 <> 0)
 QUALIFY row_number() OVER (PARTITION BY station_cd ORDER BY s_suppkey DESC) = 1""",
    "grid": """
 SELECT * FROM stations, (SELECT unnest(['1', '2', '3']) AS week_tag),
  (SELECT unnest(['1', '2']) AS inout_tag)""",
    "asked": f"""
 SELECT seq, line, updn_line, direction, time_band, day_type, arrival_ts,
  statn_nm AS station_nm,
  {_week_tag('(arrival_ts - INTERVAL 3 HOUR)')} AS week_tag, {_inout_tag()} AS inout_tag,
  CAST(hour(arrival_ts) * 3600 + minute(arrival_ts) * 60 + second(arrival_ts)
   + CASE WHEN hour(arrival_ts) < 3 THEN 86400 ELSE 0 END AS INTEGER) AS actual_sec
 FROM labelled""",
    "offered": """
 SELECT DISTINCT station_nm, week_tag, inout_tag, CAST(split_part(arrive_time, ':', 1) AS INTEGER) * 3600
  + CASE WHEN CAST(split_part(arrive_time, ':', 1) AS INTEGER) < 3 THEN 86400 ELSE 0 END
  + CAST(split_part(arrive_time, ':', 2) AS INTEGER) * 60
  + CAST(split_part(arrive_time, ':', 3) AS INTEGER) AS scheduled_sec
 FROM timetable""",
    "matched": """
 SELECT seq, station_nm, week_tag, inout_tag, direction, time_band, day_type, actual_sec,
  CASE WHEN later IS NULL OR actual_sec - earlier <= later - actual_sec
   THEN earlier ELSE later END AS scheduled_sec
 FROM (
  SELECT a.*, b.scheduled_sec AS earlier, c.scheduled_sec AS later
  FROM asked a
  ASOF LEFT JOIN offered b ON a.station_nm = b.station_nm AND a.week_tag = b.week_tag
   AND a.inout_tag = b.inout_tag AND a.actual_sec >= b.scheduled_sec
  ASOF LEFT JOIN offered c ON a.station_nm = c.station_nm AND a.week_tag = c.week_tag
   AND a.inout_tag = c.inout_tag AND a.actual_sec <= c.scheduled_sec)
 WHERE earlier IS NOT NULL OR later IS NOT NULL""",
    "delays": f"""
 SELECT *, CAST(actual_sec - scheduled_sec AS BIGINT) AS delay_sec,
  CASE WHEN actual_sec - scheduled_sec > {LATE_SEC} THEN 1 ELSE 0 END AS is_delayed
 FROM matched""",
}

# What each view reads, in definition order.
_READS = {
    "base": (),
    "positions": ("base",),
    "records": ("positions",),
    "latest": ("records",),
    "timed": ("positions",),
    "arrivals": ("timed",),
    "labelled": ("arrivals",),
    "freshness": ("positions",),
    "gaps": ("freshness",),
    "timetable": (),
    "stations": (),
    "grid": ("stations",),
    "asked": ("labelled",),
    "offered": ("timetable",),
    "matched": ("asked", "offered"),
    "delays": ("matched",),
}


def _with(body: str, views: tuple[str, ...], extra: dict[str, str] | None = None) -> str:
    """``body`` behind the views it needs."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for read in _READS[name]:
                visit(read)

    for view in views:
        visit(view)
    parts = [f"{name} AS ({_VIEWS[name]}\n)" for name in _READS if name in needed]
    parts += [f"{name} AS ({text}\n)" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)}\n{body}"


def _headway_view(cutoff: int, extra_key: str = "") -> str:
    keys = "line, statn_id, direction" + (f", {extra_key}" if extra_key else "")
    return f"""
 SELECT line, statn_id, statn_nm, direction, time_band, day_type, direct_at, arrival_ts,
  sec - lag(sec) OVER (PARTITION BY {keys} ORDER BY arrival_ts, statn_nm) AS headway_sec
 FROM labelled WHERE updn_line IN ('0', '1')
 QUALIFY headway_sec BETWEEN 1 AND {cutoff}"""


def _mart_view(extra_key: str = "") -> str:
    keys = "line, statn_id, direction, time_band, day_type" + (f", {extra_key}" if extra_key else "")
    return f"""
 SELECT {keys}, max(statn_nm) AS statn_nm, count(*) AS headway_samples,
  quantile_disc(headway_sec, 0.5) AS p50_sec, quantile_disc(headway_sec, 0.9) AS p90_sec,
  round(avg(headway_sec), 0) AS mean_sec, round(stddev_samp(headway_sec), 1) AS std_sec,
  round(stddev_samp(headway_sec) / avg(headway_sec), 3) AS cv,
  round((count(*) FILTER (headway_sec > 1.5 * middle)) / count(*), 3) AS over_1p5x_ratio
 FROM headways JOIN (SELECT {keys}, quantile_disc(headway_sec, 0.5) AS middle
   FROM headways GROUP BY ALL) USING ({keys})
 GROUP BY {keys}"""


_WIDE = {"headways": _headway_view(WIDE_CUTOFF_SEC)}
_MART = {**_WIDE, "mart": _mart_view()}
_EXPLORE = {
    **_WIDE,
    "explore": """
 SELECT line, statn_id, statn_nm, direction, time_band, count(*) AS n,
  quantile_disc(headway_sec, 0.5) AS p50_sec, quantile_disc(headway_sec, 0.9) AS p90_sec,
  round(stddev_samp(headway_sec) / avg(headway_sec), 3) AS cv
 FROM headways GROUP BY ALL HAVING n >= 15""",
}


def _mart_sql(body: str) -> str:
    return _with(body, ("labelled",), _MART)


def _delay_sql(keys: str, rate: bool = True) -> str:
    rate_col = "round(avg(is_delayed), 3) AS delay_rate, " if rate else ""
    return f"""SELECT {keys}, count(*) AS arrivals, CAST(sum(is_delayed) AS BIGINT) AS delayed,
 {rate_col}round(avg(delay_sec), 1) AS avg_delay_sec FROM delays GROUP BY {keys}"""


_API_COLUMNS = """line, subway_id AS "subwayId", train_no AS "trainNo", statn_id AS "statnId",
 statn_nm AS "statnNm", statn_tnm AS "statnTnm", updn_line AS "updnLine",
 train_sttus AS "trainSttus", direct_at AS "directAt", lstcar_at AS "lstcarAt",
 recptn_dt AS "recptnDt\""""

_TIMETABLE_COLUMNS = """line, station_cd, fr_code, station_nm, train_no, arrive_time, left_time,
 origin_station, dest_station, origin_nm, dest_nm, week_tag, inout_tag, express_yn, fl_flag,
 branch_line"""

_RANKED = """line, statn_nm, direction, time_band, headway_samples AS n, p50_sec, p90_sec, cv,
 over_1p5x_ratio"""

_WORST = "ORDER BY cv DESC NULLS LAST, line, statn_id, statn_nm, direction, time_band, day_type"

ORACLE: dict[str, str] = {
    # sources and sinks
    "read_position_api": _with(
        f"SELECT {_API_COLUMNS} FROM positions WHERE (seq // 50) % 7 NOT IN (1, 2)", ("positions",)
    ),
    "read_position_api_errors": _with(
        """SELECT line, 'ERROR-300' AS code, 'message' AS message
 FROM positions WHERE (seq // 50) % 7 = 2 GROUP BY line, seq // 50""",
        ("positions",),
    ),
    "stream_source": _with(
        """SELECT p.seq, CASE WHEN p.seq % 211 = 0 THEN '{"event_id":"broken","line":'
 WHEN p.seq % 223 = 0 THEN '{"line":"no id"}' ELSE r.raw_json END AS value
 FROM positions p LEFT JOIN records r USING (seq)""",
        ("records",),
    ),
    "keyed_json_records": _with(
        """SELECT train_no AS key, CAST(to_json(struct_pack(line := line, subway_id := subway_id,
 train_no := train_no, statn_id := statn_id, statn_nm := statn_nm, statn_tnm := statn_tnm,
 updn_line := updn_line, train_sttus := train_sttus, direct_at := direct_at,
 lstcar_at := lstcar_at, recptn_dt := recptn_dt, event_id := event_id)) AS VARCHAR) AS value
 FROM positions""",
        ("positions",),
    ),
    "append_log": _with(
        f"SELECT seq, {_FIELDS}, nullif(dt, '') AS dt, CAST(0 AS BIGINT) AS batch_id FROM records", ("records",)
    ),
    "upsert_current": _with(f"SELECT seq, {_FIELDS} FROM latest", ("latest",)),
    "mart_create_or_replace": _with("SELECT * FROM freshness", ("freshness",)),
    "l1_idempotent_write": _with(
        """SELECT line, train_no, statn_id, statn_nm, statn_tnm, updn_line, seq, arrival_ts, dt
 FROM arrivals QUALIFY row_number()
 OVER (PARTITION BY line, train_no, statn_id, arrival_ts ORDER BY seq DESC) = 1""",
        ("arrivals",),
    ),
    "timetable_read_api": _with(
        f"SELECT {_TIMETABLE_COLUMNS} FROM timetable WHERE (seq // 200) % 5 <> 0", ("timetable",)
    ),
    "station_list": _with("SELECT * FROM stations", ("stations",)),
    "timetable_csv": _with(f"SELECT {_TIMETABLE_COLUMNS} FROM timetable", ("timetable",)),
    "export_csv": _with(
        """SELECT CAST(seq AS VARCHAR) AS seq, line, train_no, statn_id, statn_nm, updn_line,
 nullif(recptn_dt, '') AS recptn_dt FROM positions""",
        ("positions",),
    ),
    "arrivals_incremental": _with(
        """SELECT line, train_no, statn_id, statn_nm, statn_tnm, updn_line, seq, arrival_ts, dt
 FROM arrivals QUALIFY row_number()
 OVER (PARTITION BY line, train_no, statn_id, arrival_ts ORDER BY seq DESC) = 1""",
        ("arrivals",),
    ),
    "table_scan_count": "SELECT count(*) AS log_rows FROM events",
    # projections, filters, scalar functions
    "normalize_event": _with(
        """SELECT train_no || '-' || coalesce(statn_id, '') || '-' || train_sttus || '-'
 || coalesce(substring(recptn_dt, 1, 10), '') AS event_id, line, subway_id, train_no, statn_id,
 statn_nm, statn_tnm, updn_line, train_sttus, direct_at, lstcar_at,
 coalesce(recptn_dt, '') AS recptn_dt FROM base""",
        ("base",),
    ),
    "event_id": _with("SELECT seq, event_id FROM positions", ("positions",)),
    "json_extract": _with(f"SELECT {_FIELDS}, raw_json, seq FROM records", ("records",)),
    "valid_event_filter": _with("SELECT seq FROM records", ("records",)),
    "dt_partition_col": _with(
        """SELECT seq, dt AS log_dt,
 strftime(TRY_CAST(recptn_dt AS TIMESTAMP), '%Y-%m-%d') AS arrival_dt FROM positions""",
        ("positions",),
    ),
    "ingest_stamp": _with(
        "SELECT count(*) AS records, count(*) AS stamped, true AS one_stamp FROM records", ("records",)
    ),
    "receive_ts_filter": _with("SELECT seq, recptn_ts FROM timed", ("timed",)),
    "direction_label": _with(
        f"SELECT seq, updn_line, {_direction()} AS direction FROM positions", ("positions",)
    ),
    "time_band_label": f"SELECT event_id, {_band('ts')} AS time_band FROM events",
    "day_type_label": f"SELECT event_id, {_day_type('ts')} AS day_type FROM events",
    "week_tag_map": _with(
        f"""SELECT seq, {_week_tag('TRY_CAST(recptn_dt AS TIMESTAMP)')} AS week_tag,
 {_inout_tag()} AS inout_tag FROM positions""",
        ("positions",),
    ),
    "minute_trunc": "SELECT event_id, date_trunc('minute', ts) AS minute_ts FROM events",
    "bi_filters": _mart_sql(
        "SELECT * FROM mart WHERE headway_samples >= 10 AND line = '2호선' AND time_band = '출근'"
    ),
    "display_label": _mart_sql(
        """SELECT line, statn_nm || '(' || direction || '·' || time_band || ')' AS label, day_type, cv
 FROM mart"""
    ),
    "minute_text": _with(
        """SELECT line, strftime(minute_ts, '%Y-%m-%d %H:%M:%S') AS minute_ts, records
 FROM freshness""",
        ("freshness",),
    ),
    "numeric_scalars": _with(
        """SELECT line, arrival_ts, round(headway_sec / 7, 3) AS rounded,
 nullif(headway_sec % 5, 0) AS without_zero,
 CASE WHEN headway_sec > 1800 THEN 1 ELSE 0 END AS is_long FROM headways""",
        ("labelled",),
        _WIDE,
    ),
    # joins
    "median_self_join": _with(
        """SELECT line, statn_id, statn_nm, direction, time_band, day_type, arrival_ts, headway_sec,
 grp_p50 FROM headways JOIN (SELECT line, statn_id, direction, time_band, day_type,
 quantile_disc(headway_sec, 0.5) AS grp_p50 FROM headways GROUP BY ALL)
 USING (line, statn_id, direction, time_band, day_type)""",
        ("labelled",),
        _WIDE,
    ),
    "nearest_scheduled": _with(
        """SELECT seq, station_nm, week_tag, inout_tag, actual_sec, scheduled_sec, delay_sec
 FROM delays""",
        ("delays",),
    ),
    "station_day_direction_grid": _with("SELECT * FROM grid", ("grid",)),
    "missing_timetable": _with(
        """SELECT * FROM grid g WHERE NOT EXISTS (SELECT 1 FROM timetable t
 WHERE t.station_cd = g.station_cd AND t.week_tag = g.week_tag AND t.inout_tag = g.inout_tag)""",
        ("grid", "timetable"),
    ),
    # windows
    "arrivals_lag": _with("SELECT * FROM arrivals", ("arrivals",)),
    "arrivals_lag_by_day": _with(
        """SELECT line, train_no, statn_id, statn_nm, statn_tnm, updn_line, seq,
 recptn_ts AS arrival_ts, strftime(recptn_ts, '%Y-%m-%d') AS dt
 FROM timed WHERE recptn_ts IS NOT NULL
 QUALIFY statn_id IS DISTINCT FROM lag(statn_id) OVER (
  PARTITION BY line, train_no, CAST(recptn_ts AS DATE) ORDER BY recptn_ts, seq)""",
        ("timed",),
    ),
    "arrivals_pattern": _with(
        """SELECT any_value(line) AS line, train_no, any_value(statn_id) AS statn_id,
 arg_min(statn_nm, (recptn_ts, seq)) AS statn_nm, arg_min(statn_tnm, (recptn_ts, seq)) AS statn_tnm,
 arg_min(updn_line, (recptn_ts, seq)) AS updn_line, arg_min(seq, (recptn_ts, seq)) AS seq,
 min(recptn_ts) AS arrival_ts, strftime(min(recptn_ts), '%Y-%m-%d') AS dt,
 max(recptn_ts) AS last_ts, count(*) AS polls
 FROM (SELECT *, sum(starts) OVER (PARTITION BY train_no ORDER BY recptn_ts, seq) AS run
  FROM (SELECT *, CASE WHEN statn_id IS NOT DISTINCT FROM lag(statn_id)
    OVER (PARTITION BY train_no ORDER BY recptn_ts, seq) THEN 0 ELSE 1 END AS starts
   FROM timed WHERE recptn_ts IS NOT NULL))
 GROUP BY train_no, run""",
        ("timed",),
    ),
    "headway": _with(
        """SELECT line, statn_id, statn_nm, direction, time_band, day_type, arrival_ts, headway_sec
 FROM headways""",
        ("labelled",),
        _WIDE,
    ),
    "minute_gaps": _with("SELECT * FROM gaps", ("gaps",)),
    "section_traversal": _with(
        "SELECT * FROM sections",
        ("arrivals",),
        {
            "sections": """
 SELECT line, train_no, dt, from_statn_id, from_statn_nm, statn_id AS to_statn_id,
  statn_nm AS to_statn_nm, depart_ts, arrival_ts,
  CAST(epoch(arrival_ts) - epoch(depart_ts) AS BIGINT) AS traversal_sec
 FROM (SELECT *, lag(statn_id) OVER w AS from_statn_id, lag(statn_nm) OVER w AS from_statn_nm,
  lag(arrival_ts) OVER w AS depart_ts FROM arrivals
  WINDOW w AS (PARTITION BY train_no, dt ORDER BY arrival_ts, seq))
 WHERE depart_ts IS NOT NULL"""
        },
    ),
    "section_summary": _with(
        """SELECT line, from_statn_id, statn_id AS to_statn_id, count(*) AS trips,
 quantile_disc(sec, 0.5) AS p50_sec, quantile_disc(sec, 0.9) AS p90_sec
 FROM (SELECT line, statn_id, lag(statn_id) OVER w AS from_statn_id,
  CAST(epoch(arrival_ts) - epoch(lag(arrival_ts) OVER w) AS BIGINT) AS sec FROM arrivals
  WINDOW w AS (PARTITION BY train_no, dt ORDER BY arrival_ts, seq))
 WHERE sec IS NOT NULL GROUP BY 1, 2, 3""",
        ("arrivals",),
    ),
    # aggregations
    "group_median": _with(
        """SELECT line, statn_id, direction, time_band, day_type,
 quantile_disc(headway_sec, 0.5) AS grp_p50 FROM headways GROUP BY 1, 2, 3, 4, 5""",
        ("labelled",),
        _WIDE,
    ),
    "headway_mart": _mart_sql("SELECT * FROM mart"),
    "headway_mart_default": _with(
        "SELECT * FROM mart", ("labelled",), {"headways": _headway_view(900), "mart": _mart_view()}
    ),
    "headway_notebook": _with("SELECT * FROM explore", ("labelled",), _EXPLORE),
    "freshness_mart": _with("SELECT * FROM freshness", ("freshness",)),
    "coverage": _with(
        """SELECT line, min(minute_ts) AS first_min, max(minute_ts) AS last_min,
 count(*) AS minutes_with_data, CAST(sum(records) AS BIGINT) AS total_records
 FROM freshness GROUP BY line""",
        ("freshness",),
    ),
    "gap_summary": _with(
        """SELECT line, count(*) FILTER (gap_min > 30) AS window_boundaries,
 count(*) FILTER (gap_min > 1.5 AND gap_min <= 30) AS within_window_hiccups,
 round(max(gap_min) FILTER (gap_min <= 30), 1) AS max_hiccup_min
 FROM gaps WHERE gap_min IS NOT NULL GROUP BY line""",
        ("gaps",),
    ),
    "mean_cv_by_line_band": _mart_sql(
        """SELECT line, time_band, round(avg(CAST(cv AS DECIMAL(18, 3))), 3) AS avg_cv,
 round(avg(p50_sec), 0) AS avg_headway_sec, count(*) AS n_groups
 FROM mart WHERE headway_samples >= 10 GROUP BY line, time_band"""
    ),
    "mean_cv_notebook": _with(
        """SELECT line, time_band, count(*) AS groups, round(avg(CAST(cv AS DECIMAL(18, 3))), 3) AS avg_cv,
 round(avg(p50_sec), 0) AS avg_p50_sec FROM explore GROUP BY line, time_band""",
        ("labelled",),
        _EXPLORE,
    ),
    "arrival_delay": _with(
        """SELECT seq, station_nm, direction, time_band, day_type, delay_sec, is_delayed
 FROM delays""",
        ("delays",),
    ),
    "delay_by_station": _with(_delay_sql("station_nm"), ("delays",)),
    "delay_by_timeband": _with(_delay_sql("day_type, time_band"), ("delays",)),
    "delay_stats": _with(_delay_sql("direction", rate=False), ("delays",)),
    "rows_by_dt": _with("SELECT dt, count(*) AS cnt FROM records GROUP BY dt", ("records",)),
    "arrivals_by_line": _with("SELECT line, count(*) AS cnt FROM arrivals GROUP BY line", ("arrivals",)),
    "dedup_ratio": _with(
        """SELECT (SELECT count(*) FROM records) AS log_rows,
 (SELECT count(*) FROM latest) AS current_rows, (SELECT count(*) FROM kept) AS arrival_rows""",
        ("latest",),
        {
            "kept": """
 SELECT TRY_CAST(recptn_dt AS TIMESTAMP) AS moment, seq FROM records
 WHERE statn_id IS NOT NULL AND moment IS NOT NULL
 QUALIFY statn_id IS DISTINCT FROM lag(statn_id) OVER (
  PARTITION BY train_no ORDER BY moment, seq)"""
        },
    ),
    "mean_cv_pivot": _mart_sql(
        "SELECT line, "
        + ", ".join(
            f"""coalesce(round(avg(CAST(cv AS DECIMAL(18, 3))) FILTER (WHERE time_band = '{band}'), 3), 0) AS "{band}\""""
            for band in ('새벽', '출근', '점심', '퇴근', '밤')
        )
        + " FROM mart WHERE headway_samples >= 10 GROUP BY line"
    ),
    "heartbeat_pivot": _with(
        "SELECT minute_ts, "
        + ", ".join(
            f"""CAST(sum(records) FILTER (WHERE line = '{line}') AS BIGINT) AS "{line}\""""
            for line in LINES
        )
        + " FROM freshness GROUP BY minute_ts",
        ("freshness",),
    ),
    "express_split": _with(
        "SELECT * FROM mart",
        ("labelled",),
        {
            "headways": _headway_view(WIDE_CUTOFF_SEC, "direct_at"),
            "mart": _mart_view("direct_at"),
        },
    ),
    # sort, limit, top-k
    "top_unstable_rush": _mart_sql(
        f"""SELECT {_RANKED} FROM mart
 WHERE time_band IN ('출근', '퇴근') AND headway_samples >= 5 {_WORST} LIMIT 15"""
    ),
    "top_unstable_bi": _mart_sql(
        f"SELECT {_RANKED} FROM mart WHERE headway_samples >= 10 {_WORST} LIMIT 20"
    ),
    "top_unstable_notebook": _with(
        """SELECT line, statn_nm, direction, time_band, n, p50_sec, p90_sec, cv FROM explore
 WHERE time_band IN ('출근', '퇴근')
 ORDER BY cv DESC NULLS LAST, line, statn_id, statn_nm, direction, time_band LIMIT 20""",
        ("labelled",),
        _EXPLORE,
    ),
    "latest_positions": _with(
        """SELECT train_no, statn_nm, statn_tnm, updn_line, train_sttus, recptn_dt FROM latest
 ORDER BY recptn_dt DESC NULLS LAST, event_id LIMIT 10""",
        ("latest",),
    ),
    "train_sequence": _with(
        """SELECT statn_nm, statn_tnm, updn_line, arrival_ts FROM arrivals WHERE train_no = '7'
 ORDER BY arrival_ts, seq LIMIT 40""",
        ("arrivals",),
    ),
    "top_delayed_stations": _with(
        _delay_sql("station_nm") + " ORDER BY delayed DESC, delay_rate DESC, station_nm LIMIT 5",
        ("delays",),
    ),
    # streaming
    "bronze_fanout_log": _with(
        f"SELECT seq, {_FIELDS}, nullif(dt, '') AS dt FROM records", ("records",)
    ),
    "bronze_fanout_current": _with(f"SELECT seq, {_FIELDS} FROM latest", ("latest",)),
    "bronze_batch_log": _with(f"SELECT {_FIELDS}, raw_json, seq, dt FROM records", ("records",)),
    "bronze_batch_current": _with(f"SELECT {_FIELDS}, raw_json, seq FROM latest", ("latest",)),
}
# What is kept by date adds up to what a run over everything gives.
ORACLE |= {
    f"{name}_incremental": ORACLE[name]
    for name in ("headway_mart", "freshness_mart", "coverage", "gap_summary")
}
