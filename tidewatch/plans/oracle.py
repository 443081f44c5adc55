"""Independent DuckDB SQL for each registered query.

Written from the operator definitions, not from the Spark plans: windows
are enumerated arithmetically, streaks use the textbook gaps-and-islands
form over a whole-device window, repeated polls use ``arg_min``.  The
driver pre-registers the tables as views.

Epoch milliseconds are ``epoch_us(ts) // 1000`` (DuckDB's ``epoch_ms``
rounds, Spark's ``unix_millis`` truncates).
"""

from __future__ import annotations

from tidewatch.config import EVENTS

P = EVENTS
_MS = {"minute": 60_000, "minutes": 60_000, "hour": 3_600_000, "hours": 3_600_000,
       "second": 1_000, "seconds": 1_000}


def _ms(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * _MS[unit]


SIZE_MS = _ms(P.window_size)
SLIDE_MS = _ms(P.window_slide)
N_WIN = SIZE_MS // SLIDE_MS
SLIDE_US = SLIDE_MS * 1000
FMT = "'%Y-%m-%d:%H:%M:%S'"

EDGES = ", ".join(f"CAST({P.bin_start + i * P.bin_step} AS DOUBLE)" for i in range(P.bin_count))
LAST_EDGE = f"CAST({P.bin_start + (P.bin_count - 1) * P.bin_step} AS DOUBLE)"
BIN = f"coalesce(list_filter([{EDGES}], lambda e: e >= value)[1], {LAST_EDGE})"

READINGS = """
r AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, event_type AS dataset_id,
         epoch_us(ts) // 1000 AS ts_ms, epoch_us(ts) AS us, value, event_id AS seq
  FROM events
)"""

EXTREMES = f"""{READINGS},
x AS (SELECT dataset_id, us, value, unnest(range({N_WIN})) AS k FROM r),
w AS (SELECT dataset_id, (us // {SLIDE_US} - k) * {SLIDE_US} AS s_us, value FROM x),
ext AS (
  SELECT dataset_id, s_us, s_us // 1000 AS win_start_ms, s_us // 1000 + {SIZE_MS} AS win_end_ms,
         strftime(make_timestamp(s_us), {FMT}) AS winstart,
         max(value) AS max_value, min(value) AS min_value, count(*) AS n
  FROM w GROUP BY dataset_id, s_us
)"""

STREAKS = f"""{READINGS},
t AS (SELECT device_id, ts_ms, seq, value FROM r WHERE dataset_id = '{P.temperature}'),
f AS (
  SELECT *, CASE WHEN lag(value) OVER w IS NULL OR lag(value) OVER w >= value THEN 1 ELSE 0 END AS rs
  FROM t WINDOW w AS (PARTITION BY device_id ORDER BY ts_ms, seq)
),
g AS (
  SELECT *, sum(rs) OVER (PARTITION BY device_id ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) AS run
  FROM f
),
h AS (
  SELECT *, row_number() OVER (PARTITION BY device_id, run ORDER BY ts_ms, seq) AS cnt,
         first_value(ts_ms) OVER (PARTITION BY device_id, run ORDER BY ts_ms, seq) AS start_ms
  FROM g
),
alerts AS (
  SELECT device_id, start_ms, CAST(cnt AS BIGINT) AS counts, ts_ms FROM h WHERE cnt >= {P.streak_limit}
),
upserts AS (SELECT device_id, start_ms, max(counts) AS counts FROM alerts GROUP BY device_id, start_ms),
latest AS (
  SELECT device_id, start_ms, strftime(make_timestamp(start_ms * 1000), {FMT}) AS starttime, counts
  FROM upserts ORDER BY start_ms DESC, counts DESC, device_id ASC LIMIT 1
)"""

#: Where the table is cut into two batches, and what late readings make of them.
MIDDLE = "m AS (SELECT (min(event_id) + max(event_id)) // 2 AS middle FROM events)"
ARRIVALS = f"""{READINGS}, {MIDDLE},
t0 AS (SELECT r.*, CASE WHEN seq < middle AND seq % 10 <> 3 THEN 0 ELSE 1 END AS turn FROM r, m),
c AS (
  SELECT max(us) FILTER (WHERE turn = 0) - {_ms(P.lateness) * 1000} AS closed, max(us) - {_ms(P.lateness) * 1000} AS closed_later FROM t0
),
a AS (SELECT t0.*, turn = 1 AND us // {SLIDE_US} * {SLIDE_US} + {SIZE_MS * 1000} <= c.closed AS late FROM t0, c)"""

HIST = f"""hist AS (
  SELECT {BIN} AS bin, count(*) AS cnt FROM events
  WHERE event_type = '{P.temperature}' AND value IS NOT NULL GROUP BY 1
)"""

TOP5 = """top5 AS (
  SELECT dataset_id, winstart, max_value AS value,
         CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY s_us DESC) AS BIGINT) AS rn
  FROM ext QUALIFY rn <= 5
)"""

LINES = """lines AS (
  SELECT event_id, ts,
         concat_ws(',', CAST(user_id AS VARCHAR), event_type, CAST(epoch_us(ts) // 1000 AS VARCHAR),
                   CAST(value AS VARCHAR)) AS line
  FROM events
)"""


def _hash_uniform(salt: str) -> str:
    key = f"concat_ws('|', '{salt}', CAST(user_id AS VARCHAR), event_type, CAST(event_id AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({key}), 1, 13)) AS UBIGINT) / 4503599627370496.0)"


def _deny(col: str) -> str:
    return " AND ".join(f"NOT contains({col}, '{m}')" for m in P.deny)


def _allow(col: str) -> str:
    return "(" + " OR ".join(f"contains({col}, '{m}')" for m in P.allow) + ")"


ORACLE_SQL: dict[str, str] = {
    "sliding_extremes": f"""WITH {EXTREMES}
SELECT dataset_id, win_start_ms, win_end_ms, winstart, max_value, min_value, n FROM ext""",

    "salted_extremes": f"""WITH {EXTREMES}
SELECT dataset_id, win_start_ms, win_end_ms, winstart, max_value, min_value, n FROM ext""",

    "parse_readings": f"""WITH {LINES},
kept AS (SELECT string_split(line, ',') AS p FROM lines WHERE {_deny('line')} AND {_allow('line')}),
typed AS (SELECT p[1] AS device_id, p[2] AS dataset_id, TRY_CAST(trim(p[3]) AS BIGINT) AS ts_ms,
                 TRY_CAST(trim(p[4]) AS DOUBLE) AS value, len(p) AS nf FROM kept)
SELECT device_id, dataset_id, ts_ms, value FROM typed
WHERE nf >= 4 AND ts_ms IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""",

    "decode_responses": """WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, event_type AS dataset_id, epoch_us(ts) // 1000 AS ts_ms, value,
         event_id % 10 AS turn
  FROM events WHERE event_type NOT IN ('error', 'signup') AND value IS NOT NULL AND NOT isnan(value))
SELECT device_id, dataset_id, ts_ms, value FROM e WHERE turn NOT IN (1, 2, 3, 6)
UNION ALL
SELECT device_id, dataset_id, ts_ms + 1, value FROM e WHERE turn = 5""",

    "quarantine_lines": """WITH l AS (
  SELECT concat_ws(',', coalesce(CAST(user_id AS VARCHAR), 'null'), coalesce(event_type, 'null'),
                   coalesce(CAST(epoch_us(ts) // 1000 AS VARCHAR), 'null'),
                   CASE WHEN event_type = 'error' THEN 'n/a' ELSE coalesce(CAST(value AS VARCHAR), 'null') END)
         AS line
  FROM events
), p AS (
  SELECT line, string_split(line, ',') AS f FROM l
), t AS (
  SELECT line, len(f) AS nf, TRY_CAST(trim(f[3]) AS BIGINT) AS ts_ms, TRY_CAST(trim(f[4]) AS DOUBLE) AS v FROM p
)
SELECT line,
       CASE WHEN nf < 4 THEN 'too few fields' WHEN ts_ms IS NULL THEN 'bad timestamp'
            WHEN v IS NULL THEN 'bad value' ELSE 'NaN value' END AS reason
FROM t
WHERE nf < 4 OR ts_ms IS NULL OR v IS NULL OR isnan(v)""",

    "response_quarantine": """WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, event_type = 'signup' AS empty, event_id % 10 AS turn,
         value, value IS NULL AS absent
  FROM events WHERE event_type <> 'error'),
q AS (
  SELECT device_id, CAST(NULL AS INTEGER) AS position,
         CASE WHEN empty THEN 'no body' WHEN turn = 1 THEN 'unreadable body' ELSE 'no status' END AS reason
  FROM e WHERE empty OR turn IN (1, 2, 3)
  UNION ALL
  SELECT device_id, 1, CASE WHEN turn = 6 THEN 'bad timestamp' WHEN absent THEN 'bad value' ELSE 'NaN value' END
  FROM e WHERE NOT empty AND (turn = 6 OR turn NOT IN (1, 2, 3) AND (absent OR isnan(value)))
  UNION ALL
  SELECT device_id, 2, CASE WHEN turn = 4 OR absent THEN 'bad value' ELSE 'NaN value' END
  FROM e WHERE NOT empty AND (turn = 4 OR turn = 5 AND (absent OR isnan(value))))
SELECT device_id, 200 AS status_code, position, reason FROM q""",

    "histogram": f"WITH {HIST} SELECT bin, cnt FROM hist",

    "histogram_changelog": f"""WITH t AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id, epoch_us(ts) // 1000 AS ts_ms, {BIN} AS bin
  FROM events WHERE event_type = '{P.temperature}' AND value IS NOT NULL
)
SELECT event_id, device_id, ts_ms, bin,
       count(*) OVER (PARTITION BY bin ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS cnt
FROM t""",

    "rising_streaks": f"WITH {STREAKS} SELECT device_id, start_ms, counts, ts_ms FROM alerts",

    "streak_upserts": f"WITH {STREAKS} SELECT device_id, start_ms, counts FROM upserts",

    "latest_streak": f"WITH {STREAKS} SELECT device_id, start_ms, starttime, counts FROM latest",

    "drop_repeated_polls": f"""WITH {READINGS},
twice AS (
  SELECT device_id, dataset_id, ts_ms, value, seq FROM r
  UNION ALL
  SELECT device_id, dataset_id, ts_ms, CASE WHEN seq % 3 = 0 THEN value + 0.5 ELSE value END, seq + 1000000000 FROM r)
SELECT device_id, dataset_id, ts_ms, arg_min(value, seq) AS value, min(seq) AS seq
FROM twice GROUP BY device_id, dataset_id, ts_ms""",

    "distinct_readings": f"""WITH {READINGS},
twice AS (SELECT * FROM r UNION ALL SELECT * FROM r)
SELECT DISTINCT device_id, dataset_id, ts_ms FROM twice""",

    "latest_windows": f"WITH {EXTREMES}, {TOP5} SELECT dataset_id, winstart, value, rn FROM top5",

    "latest_windows_10": f"""WITH {EXTREMES}
SELECT dataset_id, winstart, max_value AS value FROM ext WHERE dataset_id = '{P.temperature}'
ORDER BY s_us DESC LIMIT 10""",

    "ordered_histogram": f"""WITH {HIST}
SELECT CAST(row_number() OVER (ORDER BY bin) AS BIGINT) AS pos, bin, cnt FROM hist""",

    "temp_humi_by_window": f"""WITH {EXTREMES}
SELECT win_start_ms, winstart,
       max(max_value) FILTER (WHERE dataset_id = '{P.temperature}') AS temp_max,
       max(max_value) FILTER (WHERE dataset_id = '{P.humidity}') AS humi_max
FROM ext WHERE dataset_id IN ('{P.temperature}', '{P.humidity}')
GROUP BY win_start_ms, winstart""",

    "dashboard_snapshot": f"""WITH {STREAKS}, {HIST},
x AS (SELECT dataset_id, us, value, unnest(range({N_WIN})) AS k FROM r),
w AS (SELECT dataset_id, (us // {SLIDE_US} - k) * {SLIDE_US} AS s_us, value FROM x),
ext AS (
  SELECT dataset_id, s_us, strftime(make_timestamp(s_us), {FMT}) AS winstart, max(value) AS max_value
  FROM w GROUP BY dataset_id, s_us
),
{TOP5}
SELECT (SELECT starttime FROM latest) AS starttime,
       (SELECT counts FROM latest) AS counts,
       (SELECT string_agg(printf('%.2f', bin), ';' ORDER BY bin) FROM hist) AS tempinterval,
       (SELECT string_agg(CAST(cnt AS VARCHAR), ';' ORDER BY bin) FROM hist) AS intervalcount,
       (SELECT string_agg(winstart, ';' ORDER BY rn) FROM top5 WHERE dataset_id = '{P.temperature}') AS tempwinstart,
       (SELECT string_agg(printf('%.2f', value), ';' ORDER BY rn) FROM top5
         WHERE dataset_id = '{P.temperature}') AS tempvalues,
       (SELECT string_agg(winstart, ';' ORDER BY rn) FROM top5 WHERE dataset_id = '{P.humidity}') AS humiwinstart,
       (SELECT string_agg(printf('%.2f', value), ';' ORDER BY rn) FROM top5
         WHERE dataset_id = '{P.humidity}') AS humivalues""",

    "dashboard_arrays": f"""WITH {EXTREMES}, {TOP5}
SELECT dataset_id, string_agg(winstart, ';' ORDER BY rn) AS winstarts,
       string_agg(printf('%.2f', value), ';' ORDER BY rn) AS "values"
FROM top5 GROUP BY dataset_id""",

    "only_dataset": f"""WITH {READINGS}
SELECT device_id, dataset_id, ts_ms, value, seq FROM r WHERE dataset_id = '{P.temperature}'""",

    "route_topic": f"""WITH {LINES}
SELECT event_id AS seq,
       CASE WHEN contains(line, '{P.route_marker}') THEN 'topic_start' ELSE 'topic_event' END AS topic
FROM lines""",

    "tag_headers": """SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS device_id,
       '{"datasetId":"' || event_type || '"}' AS headers
FROM events""",

    "archive_layout": """SELECT strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour, count(*) AS lines
FROM events GROUP BY 1, 2""",

    "uniform_noise": f"""SELECT event_id AS seq, round(value + {_hash_uniform('u')}, 6) AS value FROM events""",

    "gaussian_noise": f"""SELECT event_id AS seq,
       round(value + sqrt(-2.0 * ln(1.0 - {_hash_uniform('g1')})) * cos(2.0 * pi() * {_hash_uniform('g2')}), 6)
       AS value
FROM events""",

    "upsert_final_state": """SELECT CAST(user_id AS VARCHAR) AS device_id, arg_max(value, event_id) AS value,
       max(event_id) AS seq
FROM events GROUP BY 1""",
    "changelog_resumed": f"""WITH {READINGS}, {MIDDLE},
        b AS (
          SELECT seq, {BIN} AS bin, CAST(row_number() OVER (PARTITION BY {BIN} ORDER BY ts_ms, seq) AS BIGINT) AS cnt
          FROM r WHERE dataset_id = '{P.temperature}' AND value IS NOT NULL)
        SELECT seq, bin, cnt FROM b, m WHERE seq >= middle""",
    "streaks_resumed": f"""WITH {STREAKS}, {MIDDLE}
        SELECT device_id, start_ms, CAST(cnt AS BIGINT) AS counts, ts_ms FROM h, m WHERE cnt >= {P.streak_limit} AND seq >= middle""",
    "late_readings": f"WITH {ARRIVALS} SELECT seq, device_id, dataset_id, ts_ms, value FROM a WHERE late",
    "closed_windows": f"""WITH {ARRIVALS},
        x AS (SELECT dataset_id, us, value, turn, unnest(range({N_WIN})) AS k FROM a WHERE NOT late),
        y AS (SELECT dataset_id, (us // {SLIDE_US} - k) * {SLIDE_US} AS s_us, value, turn FROM x),
        z AS (SELECT y.* FROM y, c WHERE turn = 0 OR s_us + {SIZE_MS * 1000} > c.closed)
        SELECT dataset_id, s_us // 1000 AS win_start_ms, s_us // 1000 + {SIZE_MS} AS win_end_ms,
               strftime(make_timestamp(s_us), {FMT}) AS winstart,
               max(value) AS max_value, min(value) AS min_value, count(*) AS n
        FROM z, c WHERE s_us + {SIZE_MS * 1000} > c.closed AND s_us + {SIZE_MS * 1000} <= c.closed_later
        GROUP BY dataset_id, s_us""",
    "maintained_windows": f"""WITH {EXTREMES}
        SELECT dataset_id, winstart, max_value AS value, CAST(rn AS BIGINT) AS rn FROM (
          SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY s_us DESC) AS rn FROM ext) WHERE rn <= 5""",
    "lines_round_trip": f"""WITH {READINGS}
        SELECT 'dev-1' AS device_id, dataset_id, ts_ms, value FROM r
        WHERE dataset_id IN ({", ".join(repr(x) for x in P.allow)}) AND value IS NOT NULL""",
    "archive_round_trip": f"""WITH {READINGS}
        SELECT strftime(make_timestamp(us), '%Y%m%d') AS day, strftime(make_timestamp(us), '%H') AS hour,
               device_id || ',' || dataset_id || ',' || ts_ms || ',' || value AS value FROM r""",
    "upsert_table": f"""WITH {READINGS}
        SELECT device_id, arg_max(value, seq) AS value, max(seq) AS seq FROM r GROUP BY device_id""",
    "append_table": f"""WITH {READINGS}, {MIDDLE},
        x AS (SELECT dataset_id, us, value, CAST(seq >= middle AS BIGINT) AS batch, unnest(range({N_WIN})) AS k FROM r, m),
        y AS (SELECT dataset_id, (us // {SLIDE_US} - k) * {SLIDE_US} AS s_us, value, batch FROM x)
        SELECT dataset_id, s_us // 1000 AS win_start_ms, s_us // 1000 + {SIZE_MS} AS win_end_ms,
               strftime(make_timestamp(s_us), {FMT}) AS winstart,
               max(value) AS max_value, min(value) AS min_value, count(*) AS n, batch
        FROM y GROUP BY dataset_id, s_us, batch""",
}
