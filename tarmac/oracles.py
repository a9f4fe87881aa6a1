"""The same results in SQL over the same tables, to check the Spark queries against."""

from __future__ import annotations

from tarmac.queries import MIN_FLIGHTS
from tarmac.settings import WINDOWS_MS

FLIGHTS = """
events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
),
flagged AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS event_time, k, value,
    ['AA', 'DL', 'UA', 'WN', 'B6', 'OO'][1 + k % 6] AS carrier,
    CAST(10001 + user_id % 40 AS INT) AS origin, CAST(20001 + event_id % 20 AS INT) AS dest,
    CASE WHEN event_type = 'error' AND k % 4 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS cancelled,
    CASE WHEN event_type = 'view' AND k % 10 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS diverted
  FROM events_k
),
flights AS (
  SELECT seq, event_time, carrier, origin, dest, cancelled, diverted,
    CASE WHEN cancelled = 1.0 OR k = 7 THEN NULL
         ELSE CAST(floor(value) AS DOUBLE) - 20 END AS dep_delay
  FROM flagged
),
flown AS (
  SELECT seq, event_time, carrier, origin, dest, coalesce(dep_delay, 0.0) AS dep_delay
  FROM flights WHERE cancelled < 1.0 AND diverted < 1.0
)"""

MINUTES = """
timed AS (
  SELECT *, make_timestamp(event_time * 1000) AS departs,
    event_time - event_time % 60000 AS minute_ms,
    CASE WHEN dep_delay > 15 THEN dep_delay END AS late_aircraft
  FROM flights
)"""


def stamp(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"


def text2(value: str) -> str:
    return f"format('{{:.2f}}', {value})"


def carriers(rows: str = "flights") -> str:
    return f"""
hours AS (
  SELECT event_time - event_time % 3600000 AS ws, carrier,
    count(*) AS num,
    count(*) FILTER (cancelled < 1 AND diverted < 1) AS completed,
    count(*) FILTER (cancelled >= 1) AS cancelled,
    count(*) FILTER (diverted >= 1) AS diverted,
    coalesce(sum(coalesce(dep_delay, 0.0)) FILTER (cancelled < 1), 0.0) AS total,
    count(*) FILTER (cancelled < 1) AS departed,
    count(*) FILTER (cancelled < 1 AND dep_delay > 15) AS late
  FROM {rows} WHERE carrier IN ('AA', 'DL', 'UA', 'WN') GROUP BY 1, 2
),
stats AS (
  SELECT {stamp("ws")} AS window_start, {stamp("ws + 3600000")} AS window_end,
    carrier AS airline, num AS num_flights, completed, cancelled, diverted,
    CASE WHEN departed > 0 THEN total / departed ELSE 0.0 END AS dep_delay_mean,
    cancelled / num * 100.0 AS cancellation_rate,
    CASE WHEN departed > 0 THEN late / departed * 100.0 ELSE 0.0 END AS late_departure_rate
  FROM hours
)"""


def q1(rows: str = "flights", more: str = "") -> str:
    return f"WITH {FLIGHTS}{more}, {carriers(rows)} SELECT * FROM stats"


def bounds(size: str) -> tuple[str, str]:
    if size == "global":
        return "min(event_time) OVER ()", "max(event_time) OVER () + 1"
    step = WINDOWS_MS[size]
    start = f"event_time - event_time % {step}"
    return start, f"{start} + {step}"


def airports(size: str, name: str = "airports", first: str = "min(seq)") -> str:
    start, end = bounds(size)
    return f"""
{name}_rows AS (SELECT *, {start} AS ws, {end} AS we FROM flown),
{name} AS (
  SELECT ws, we, origin, count(*) AS num, count(*) FILTER (dep_delay > 30) AS severe,
    sum(dep_delay) AS sum_delay, max(dep_delay) AS max_delay, {first} AS tie
  FROM {name}_rows GROUP BY ALL
)"""


def ranking(source: str = "airports", name: str = "ranked", least: int = 30, top: int = 10) -> str:
    return f"""
{name} AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY ws, we ORDER BY severe DESC, num DESC, tie, origin) AS INT) AS rank
  FROM {source} WHERE num >= {least} QUALIFY rank <= {top}
)"""


RANKING_COLUMNS = f"""{stamp("ws")} AS ts, rank, origin AS origin_airport_id, num AS num_flights,
  severe AS severe_delays, sum_delay / num AS dep_delay_mean, max_delay AS dep_delay_max"""
RANKING_TEXT = f"""{stamp("ws")} AS ts, rank, origin AS origin_airport_id, num AS num_flights,
  severe AS severe_delays, {text2("sum_delay / num")} AS dep_delay_mean,
  {text2("max_delay")} AS dep_delay_max"""
PREAGG_COLUMNS = f"""{stamp("ws")} AS window_start, {stamp("we")} AS window_end,
  origin AS airport_id, num, severe, sum_delay, max_delay"""
ARRIVAL = "dep_delay DESC, seq"
KEYS_DOWN = "dep_delay DESC, carrier DESC, dest DESC"


def worst(order: str = ARRIVAL, source: str = "ranked", name: str = "worst") -> str:
    """The listed flights of each row of `source`, by a range join."""
    return f"""
{name} AS (
  SELECT r.ws, r.we, r.origin, f.seq, f.carrier, f.dest, f.dep_delay,
    CAST(row_number() OVER (PARTITION BY r.ws, r.we, r.origin ORDER BY {order}) AS INT) AS place
  FROM {source} r JOIN flown f
    ON f.origin = r.origin AND f.event_time >= r.ws AND f.event_time < r.we
  WHERE f.dep_delay > 30 QUALIFY place <= 20
)"""


BRACKETS = f"""
lists AS (
  SELECT ws, we, origin, '[' || string_agg('(' || carrier || ',' || dest || ',' ||
    {text2("dep_delay")} || ')', ', ' ORDER BY place) || ']' AS text
  FROM worst GROUP BY ALL
)"""
PIPES = f"""
lists AS (
  SELECT ws, we, origin, string_agg(carrier || '|' || dest || '|' || {text2("dep_delay")},
    ';' ORDER BY place) AS text
  FROM worst GROUP BY ALL
)"""


def top_airports(size: str) -> str:
    return f"""WITH {FLIGHTS}, {airports(size)}, {ranking(least=MIN_FLIGHTS[size])}
SELECT {RANKING_COLUMNS} FROM ranked"""


def delayed(size: str) -> str:
    return f"""WITH {FLIGHTS}, {airports(size)}, {ranking(least=MIN_FLIGHTS[size])}, {worst()}
SELECT {stamp("ws")} AS ts, rank, origin AS origin_airport_id, place, carrier, dest, dep_delay
FROM ranked JOIN worst USING (ws, we, origin)"""


def report(size: str) -> str:
    return f"""WITH {FLIGHTS}, {airports(size)}, {ranking(least=MIN_FLIGHTS[size])}, {worst()},
{BRACKETS}
SELECT {RANKING_TEXT}, coalesce(text, '[]') AS delayed_flights
FROM ranked LEFT JOIN lists USING (ws, we, origin)"""


def preagg(size: str) -> str:
    return f"WITH {FLIGHTS}, {airports(size)} SELECT {PREAGG_COLUMNS} FROM airports"


def rolled_up(first: str = "NULL") -> str:
    return f"""
rolled AS (
  SELECT min(min(ws)) OVER () AS ws, max(max(we)) OVER () AS we, origin, sum(num)::BIGINT AS num,
    sum(severe)::BIGINT AS severe, sum(sum_delay) AS sum_delay, max(max_delay) AS max_delay,
    {first} AS tie
  FROM airports GROUP BY origin
)"""


def post_report(size: str) -> str:
    if size == "global":
        steps = f"{airports('1h', first='0')}, {rolled_up('0')}, {ranking('rolled')}"
    else:
        steps = f"{airports(size, first='0')}, {ranking(least=MIN_FLIGHTS[size])}"
    return f"""WITH {FLIGHTS}, {steps}, {worst(KEYS_DOWN)}, {BRACKETS}
SELECT {RANKING_TEXT}, coalesce(text, '[]') AS delayed_flights
FROM ranked LEFT JOIN lists USING (ws, we, origin)"""


DELAYED_LIST_TEXT = f"""WITH {FLIGHTS}, {airports("6h")}, {worst(source="airports")}, {BRACKETS}
SELECT {stamp("ws")} AS ts, origin AS origin_airport_id, severe AS severe_delays,
  coalesce(text, '[]') AS delayed_flights
FROM airports LEFT JOIN lists USING (ws, we, origin)"""

def preagg_top20(size: str) -> str:
    return f"""WITH {FLIGHTS}, {airports(size)}, {worst(source="airports")}, {PIPES}
SELECT {PREAGG_COLUMNS}, coalesce(text, '') AS top_str
FROM airports LEFT JOIN lists USING (ws, we, origin)"""


PREAGG_TOP20_TEXT = preagg_top20("6h")

WINDOWS_GROUPED = f"""WITH {FLIGHTS}, {airports("6h")}
SELECT {stamp("ws")} AS window_start, {stamp("we")} AS window_end, count(*) AS airports,
  count(*) FILTER (num >= {MIN_FLIGHTS["6h"]}) AS qualifying,
  sum(num)::BIGINT AS flights, sum(severe)::BIGINT AS severe_delays
FROM airports GROUP BY ws, we"""

RUN_COUNTS = f"""WITH {FLIGHTS}, {airports("6h")}
SELECT count(*) AS rows, count(*) FILTER (num >= {MIN_FLIGHTS["6h"]}) AS qualifying_rows,
  count(DISTINCT ws) FILTER (num >= {MIN_FLIGHTS["6h"]}) AS qualifying_windows
FROM airports"""

GLOBAL_FROM_PREAGG = f"""WITH {FLIGHTS}, {airports("1h", first="0")}, {rolled_up("0")},
{ranking("rolled")}
SELECT {RANKING_COLUMNS} FROM ranked"""

INTERVAL_JOIN = f"""WITH {FLIGHTS}, {airports("1h", first="0")},
{airports("6h", "six_hours", first="0")}, {rolled_up("0")},
{ranking("airports", "top_1h", MIN_FLIGHTS["1h"])},
{ranking("six_hours", "top_6h", MIN_FLIGHTS["6h"])}, {ranking("rolled", "top_all")},
winners AS (
  SELECT ws, we, origin FROM top_1h UNION ALL SELECT ws, we, origin FROM top_6h
  UNION ALL SELECT ws, we, origin FROM top_all
)
SELECT {stamp("w.ws")} AS window_start, {stamp("w.we")} AS window_end, w.origin AS airport_id,
  f.seq, f.carrier, f.dest, f.dep_delay
FROM winners w JOIN flown f
  ON f.origin = w.origin AND f.event_time >= w.ws AND f.event_time < w.we
WHERE f.dep_delay > 30"""

CALENDAR = """CAST(year(departs) AS INT) AS "YEAR", CAST(month(departs) AS INT) AS "MONTH",
  CAST(day(departs) AS INT) AS "DAY_OF_MONTH\""""
CLOCK = "CAST(hour(departs) * 100 + minute(departs) AS INT) AS \"CRS_DEP_TIME\""

EVENT_TIME = f"""WITH {FLIGHTS}, {MINUTES}
SELECT seq, {CALENDAR}, {CLOCK}, minute_ms AS event_time, {stamp("minute_ms")} AS event_stamp
FROM timed"""


def event_columns(time: str, security: str = "CAST(NULL AS DOUBLE)") -> str:
    return f"""{CALENDAR}, carrier AS "OP_UNIQUE_CARRIER", origin AS "ORIGIN_AIRPORT_ID",
  dest AS "DEST_AIRPORT_ID", {CLOCK}, dep_delay AS "DEP_DELAY", dep_delay - 5 AS "ARR_DELAY",
  cancelled AS "CANCELLED", diverted AS "DIVERTED", CAST(NULL AS DOUBLE) AS "CARRIER_DELAY",
  CAST(NULL AS DOUBLE) AS "WEATHER_DELAY", CAST(NULL AS DOUBLE) AS "NAS_DELAY",
  {security} AS "SECURITY_DELAY", late_aircraft AS "LATE_AIRCRAFT_DELAY",
  {time} AS event_time"""


UNION_SORTED = f"""WITH {FLIGHTS}, {MINUTES}
SELECT {event_columns("minute_ms")},
  row_number() OVER (ORDER BY minute_ms, timed.seq) - 1 AS seq
FROM timed"""

EVENT_TABLE = f"""WITH {FLIGHTS}, {MINUTES}
SELECT {event_columns("event_time")}, seq FROM timed"""

SCAN = f"""WITH {FLIGHTS}
SELECT carrier, origin, dest, dep_delay, cancelled, diverted, event_time, seq FROM flights"""

SCAN_TOLERANT = f"""WITH {FLIGHTS}
SELECT carrier, origin, dest, coalesce(dep_delay, 0.0) AS dep_delay, cancelled, diverted,
  event_time, seq FROM flights"""

# Lines of these destinations are damaged; see the table of damages beside the lines themselves.
PARSE_Q1 = f"""WITH {FLIGHTS}
SELECT carrier, coalesce(dep_delay, 0.0) AS dep_delay,
  CASE WHEN dest = 20006 THEN 0.0 ELSE cancelled END AS cancelled, diverted, event_time, seq
FROM flights
WHERE carrier IN ('AA', 'DL', 'UA', 'WN') AND dest NOT IN (20002, 20003, 20008, 20010)"""

PARSE_Q2 = f"""WITH {FLIGHTS}
SELECT origin, carrier, dest, coalesce(dep_delay, 0.0) AS dep_delay, event_time, seq
FROM flights
WHERE dest NOT IN (20002, 20003, 20005, 20008, 20010)
  AND (cancelled < 1 OR dest = 20006) AND diverted < 1"""

PARSE_FULL = f"""WITH {FLIGHTS}, {MINUTES}
SELECT {CALENDAR}, carrier AS "OP_UNIQUE_CARRIER", origin AS "ORIGIN_AIRPORT_ID",
  dest AS "DEST_AIRPORT_ID", {CLOCK},
  CASE WHEN dest NOT IN (20002, 20010) THEN coalesce(dep_delay, 0.0) END AS "DEP_DELAY",
  coalesce(dep_delay - 5, 0.0) AS "ARR_DELAY",
  CASE WHEN dest = 20006 THEN 0.0 ELSE cancelled END AS "CANCELLED", diverted AS "DIVERTED",
  0.0::DOUBLE AS "CARRIER_DELAY", 0.0::DOUBLE AS "WEATHER_DELAY", 0.0::DOUBLE AS "NAS_DELAY",
  0.0::DOUBLE AS "SECURITY_DELAY", coalesce(late_aircraft, 0.0) AS "LATE_AIRCRAFT_DELAY",
  event_time
FROM timed WHERE dest <> 20003"""

# Cancelled flights come last: they count only in hours the watermark has not closed by then.
LATE = q1(
    "in_time",
    """,
seen AS (
  SELECT max(event_time) - 60000 AS mark FROM flights
  WHERE carrier IN ('AA', 'DL', 'UA', 'WN') AND cancelled < 1
),
in_time AS (
  SELECT flights.* FROM flights, seen
  WHERE cancelled < 1 OR event_time - event_time % 3600000 + 3600000 > mark
)""",
)

def top20(size: str) -> str:
    return f"""WITH {FLIGHTS}, {airports(size)}, {worst(source="airports")}
SELECT {stamp("ws")} AS window_start, {stamp("we")} AS window_end, origin AS airport_id,
  place, carrier, dest, dep_delay
FROM worst"""

def report_lines(report: str, quote: bool = False) -> str:
    """The lines of a report file in its order; the list is quoted always or when it has commas."""
    listed = """'"' || delayed_flights || '"'"""
    if not quote:
        listed = f"CASE WHEN contains(delayed_flights, ',') THEN {listed} ELSE delayed_flights END"
    return f"""row_number() OVER (ORDER BY ts, rank) AS nth,
  concat_ws(',', ts, rank, origin_airport_id, num_flights, severe_delays, dep_delay_mean,
    dep_delay_max, {listed}) AS line FROM ({report})"""


SIZES = ("1h", "6h", "global")

ORACLES = {
    "q1_hourly_carrier_stats": q1(),
    "q1_report_text": f"""WITH {FLIGHTS}, {carriers()}
SELECT * REPLACE ({text2("dep_delay_mean")} AS dep_delay_mean,
  {text2("cancellation_rate")} AS cancellation_rate,
  {text2("late_departure_rate")} AS late_departure_rate) FROM stats""",
    **{f"q2_top_airports_{size}": top_airports(size) for size in SIZES},
    **{f"q2_delayed_flights_{size}": delayed(size) for size in SIZES},
    **{f"q2_report_{size}": report(size) for size in SIZES},
    "q2_reports_all": " UNION ALL ".join(
        f"SELECT *, '{size}' AS span FROM ({report(size)})" for size in SIZES
    ),
    "q2_delayed_list_text": DELAYED_LIST_TEXT,
    **{f"q2_preagg_{size}": preagg(size) for size in WINDOWS_MS},
    "q2_preagg_top20_text": PREAGG_TOP20_TEXT,
    "q2_windows_grouped": WINDOWS_GROUPED,
    "q2_run_counts": RUN_COUNTS,
    "preagg_files_roundtrip": preagg("1h"),
    "q2_global_from_preagg": GLOBAL_FROM_PREAGG,
    "q2_post_report_6h": post_report("6h"),
    "q2_post_report_global": post_report("global"),
    "q2_post_reports_all": " UNION ALL ".join(
        f"SELECT *, '{size}' AS report FROM ({post_report(size)})" for size in SIZES
    ),
    "q2_interval_join_winners": INTERVAL_JOIN,
    "prep_event_time": EVENT_TIME,
    "prep_union_sorted": UNION_SORTED,
    "parse_lines_q1": PARSE_Q1,
    "parse_lines_q2": PARSE_Q2,
    "parse_lines_full": PARSE_FULL,
    "scan_csv_roundtrip": SCAN,
    "scan_csv_tolerant": SCAN_TOLERANT,
    "scan_csv_plain": f"""WITH {FLIGHTS}
SELECT carrier, origin, dest, dep_delay, cancelled, diverted, event_time,
  row_number() OVER (ORDER BY event_time, seq) - 1 AS seq FROM flights""",
    "q2_reports_from_plain_csv": " UNION ALL ".join(
        f"SELECT *, '{size}' AS span FROM ({report(size)})" for size in SIZES
    ),
    "event_table_roundtrip": EVENT_TABLE,
    "report_files_roundtrip": " UNION ALL ".join(
        f"SELECT '{size}' AS span, {report_lines(report(size), quote=True)}" for size in SIZES
    ),
    "post_report_files_roundtrip": f"SELECT '6h' AS span, {report_lines(post_report('6h'))}",
    "proc_hour_roundtrip": f"""WITH {FLIGHTS}, {carriers()}
SELECT * REPLACE ({text2("dep_delay_mean")} AS dep_delay_mean,
  {text2("cancellation_rate")} AS cancellation_rate,
  {text2("late_departure_rate")} AS late_departure_rate) FROM stats""",
    "stream_q1": q1(),
    "stream_q1_resumed": q1(),
    "stream_q1_late": LATE,
    **{f"stream_q2_preagg_{size}": preagg(size) for size in WINDOWS_MS},
    "stream_q2_top_airports_6h": top_airports("6h"),
    **{f"stream_q2_top20_{size}": top20(size) for size in WINDOWS_MS},
    "stream_preagg_all_sizes": " UNION ALL ".join(
        f"SELECT *, '{size}' AS span FROM ({preagg(size)})" for size in WINDOWS_MS
    ),
    "stream_preagg_lists_all_sizes": " UNION ALL ".join(
        f"SELECT *, '{size}' AS span FROM ({preagg_top20(size)})" for size in WINDOWS_MS
    ),
    "stream_q2_preagg_top20_6h": PREAGG_TOP20_TEXT,
    "stream_then_post_6h": post_report("6h"),
}
