"""The same queries in SQL, for an independent engine over the same tables."""

from __future__ import annotations

import math


# Fixed values in the SQL below: season months, day bands, position groups, stop labels and failures, as in ``functions.labels``
# and ``plans.race``.


def season(month: str) -> str:
    return (
        f"CASE WHEN {month} BETWEEN 3 AND 5 THEN 'Spring' WHEN {month} BETWEEN 6 AND 8 THEN 'Summer' "
        f"WHEN {month} BETWEEN 9 AND 11 THEN 'Fall' WHEN {month} IN (12, 1, 2) THEN 'Winter' ELSE 'Unknown' END"
    )


def band(time: str, strict: bool = False) -> str:
    night = (
        f"{time} BETWEEN '21:00:00' AND '05:59:59'"
        if strict
        else f"({time} BETWEEN '21:00:00' AND '23:59:59' OR {time} BETWEEN '00:00:00' AND '05:59:59')"
    )
    return (
        f"CASE WHEN {time} BETWEEN '06:00:00' AND '11:59:59' THEN 'Morning' "
        f"WHEN {time} BETWEEN '12:00:00' AND '17:59:59' THEN 'Afternoon' "
        f"WHEN {time} BETWEEN '18:00:00' AND '20:59:59' THEN 'Evening' WHEN {night} THEN 'Night' END"
    )


CLOCK = "strftime(ts, '%H:%M:%S')"


def to_int(text: str) -> str:
    return rf"TRY_CAST(regexp_extract({text}, '^\s*([+-]?\d+)(\.\d*)?\s*$', 1) AS INTEGER)"


def place_group(place: str) -> str:
    return f"CASE WHEN {place} <= 3 THEN 'Top 3' WHEN {place} <= 10 THEN 'Top 10' ELSE 'Outside Top 10' END"


def lap_ms(text: str) -> str:
    return (
        f"(TRY_CAST(split_part({text}, ':', 1) AS INTEGER) * 60000 "
        f"+ CASE WHEN contains({text}, ':') THEN TRY_CAST(split_part({text}, ':', 2) AS DOUBLE) END * 1000)"
    )


def win_rate(table: str, key: str, event: str, won: str, where: str = "TRUE") -> str:
    return f"""
        SELECT {key}, CAST(count(*) FILTER (WHERE {won}) AS BIGINT) AS total_wins,
               count(DISTINCT {event}) AS total_races,
               round(count(*) FILTER (WHERE {won}) / count(DISTINCT {event}), 3) AS win_rate
        FROM {table} WHERE {where} GROUP BY {key}"""


def stops(table: str, keys: str, duration: str, lap: str) -> str:
    return f"""
        SELECT *, round(avg_stop_duration / nullif(avg_laps_between_stops, 0), 2) AS stop_efficiency FROM (
          SELECT {keys}, CAST(sum({duration}) AS BIGINT) AS total_stop_duration,
                 round(avg({duration}), 0) AS avg_stop_duration, count({lap}) AS total_stops,
                 CASE WHEN count({lap}) > 1 THEN round((max({lap}) - min({lap})) / (count({lap}) - 1), 0)
                      ELSE -1.0 END::DOUBLE AS avg_laps_between_stops
          FROM {table} GROUP BY {keys})"""


# The labels of stop frequencies.
LABEL = (
    "CASE WHEN total_stops > 2 THEN 'High Pit Stop Frequency' WHEN total_stops <= 2 "
    "THEN 'Low Pit Stop Frequency' ELSE 'Normal Pit Stop Frequency' END"
)


def mean_by(table: str, keys: str, value: str, digits: int = 4) -> str:
    half = f"1.959963984540054 * stddev_samp({value}) / sqrt(count({value}))"
    return f"""
        SELECT {keys}, count({value}) AS n, round(avg({value}), {digits}) + 0.0 AS mean,
               round(stddev_samp({value}), {digits}) + 0.0 AS stddev,
               round(avg({value}) - {half}, {digits}) + 0.0 AS ci_low,
               round(avg({value}) + {half}, {digits}) + 0.0 AS ci_high
        FROM {table} WHERE {value} IS NOT NULL GROUP BY {keys}"""


def bootstrap(table: str, keys: str, value: str, row_key: str, replicates: int = 200, digits: int = 4) -> str:
    """As ``mean_by``, its interval from Poisson replicates drawn by the MD5 of the row key."""
    modulus = 2**31 - 1
    limits, total = [], 0.0
    for k in range(12):
        total = math.fsum(math.exp(-1) / math.factorial(j) for j in range(k + 1))
        limits.append(math.floor(modulus * total))
    weight = " ".join(f"WHEN place < {limit} THEN {k}" for k, limit in enumerate(limits))
    text = ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '')" for c in row_key.split(","))
    number = "CAST('0x' || substr(md5(concat_ws('|', '123', {})), {}, 8) AS BIGINT) % {}"
    same = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM e.{k.strip()}" for k in keys.split(","))
    return f"""
        SELECT s.* REPLACE (round(lo, {digits}) + 0.0 AS ci_low, round(hi, {digits}) + 0.0 AS ci_high)
        FROM ({mean_by(table, keys, value, digits)}) s LEFT JOIN (
          SELECT {keys}, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM (
            SELECT {keys}, b, sum(w * x) / sum(w) AS m FROM (
              SELECT *, CASE {weight} ELSE 12 END AS w FROM (
                SELECT *, (first + b * second) % {modulus} AS place FROM (
                  SELECT {keys}, {value}::DOUBLE AS x, {number.format(text, 1, modulus)} AS first,
                         {number.format(text, 9, modulus)} AS second
                  FROM {table} WHERE {value} IS NOT NULL), (SELECT range AS b FROM range(1, {replicates + 1}))))
            WHERE w > 0 GROUP BY {keys}, b) GROUP BY {keys}) e ON {same}"""


def histogram(table: str, value: str, bins: int = 20) -> str:
    return f"""
        SELECT b.bin, round(b.low, 6) + 0.0 AS low, round(b.high, 6) + 0.0 AS high, count(v) AS n
        FROM (SELECT CAST(i AS INTEGER) AS bin, lo + (hi - lo) / {bins} * (i - 1) AS low, lo + (hi - lo) / {bins} * i AS high
              FROM (SELECT range AS i FROM range(1, {bins + 1})),
                   (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi FROM {table})) b
        LEFT JOIN (SELECT {value}::DOUBLE AS v FROM {table} WHERE {value} IS NOT NULL) t
          ON v >= b.low AND (v < b.high OR b.bin = {bins})
        GROUP BY b.bin, b.low, b.high"""


def density(table: str, value: str, points: int) -> str:
    return f"""
        SELECT round(lo + i * gap, 6) + 0.0 AS x,
               round(sum(k * exp(-0.5 * pow((lo + i * gap - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
                 + 0.0 AS density
        FROM (SELECT {value}::DOUBLE AS v, count(*) AS k FROM {table} WHERE {value} IS NOT NULL GROUP BY 1),
             (SELECT min({value})::DOUBLE AS lo, (max({value}) - min({value}))::DOUBLE / {points - 1} AS gap,
                     count({value}) AS n, stddev_samp({value}) * pow(count({value}), -0.2) AS h FROM {table}),
             (SELECT range AS i FROM range(0, {points}))
        GROUP BY i, lo, gap"""


def box(table: str, key: str, value: str, digits: int = 4) -> str:
    inside = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"

    def r(c: str, name: str) -> str:
        return f"round({c}, {digits}) + 0.0 AS {name}"

    return f"""
        SELECT t.{key}, count(*) AS n, {r('min(v)', 'low')}, {r('any_value(q1)', 'q1')},
               {r('any_value(median)', 'median')}, {r('any_value(q3)', 'q3')}, {r('max(v)', 'high')},
               {r(f'min(v) FILTER (WHERE {inside})', 'whisker_low')},
               {r(f'max(v) FILTER (WHERE {inside})', 'whisker_high')},
               count(*) FILTER (WHERE NOT ({inside})) AS n_outliers
        FROM (SELECT {key}, {value}::DOUBLE AS v FROM {table} WHERE {value} IS NOT NULL) t
        JOIN (SELECT {key}, quantile_cont({value}::DOUBLE, 0.25) AS q1, quantile_cont({value}::DOUBLE, 0.5) AS median,
                     quantile_cont({value}::DOUBLE, 0.75) AS q3 FROM {table} WHERE {value} IS NOT NULL GROUP BY {key}) q
          ON t.{key} IS NOT DISTINCT FROM q.{key}
        GROUP BY t.{key}"""


def pairs(table: str, x: str, y: str) -> str:
    return f"SELECT {x}, {y}, count(*) AS n FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY {x}, {y}"


def auc(table: str, label: str, score: str, key: str | None = None) -> str:
    by_key = f"PARTITION BY {key} " if key else ""
    tied = f"{key}, {score}" if key else score
    pos, neg = f"count(*) FILTER (WHERE {label} = 1)", f"count(*) FILTER (WHERE {label} = 0)"
    return f"""
        SELECT {f'{key}, ' if key else ''}round((sum(r) FILTER (WHERE {label} = 1) - {pos} * ({pos} + 1) / 2)
                 / ({pos}::DOUBLE * {neg}), 6) + 0.0 AS auc
        FROM (SELECT *, rank() OVER ({by_key}ORDER BY {score})
                        + (count(*) OVER (PARTITION BY {tied}) - 1) / 2 AS r FROM {table})
        {f'GROUP BY {key}' if key else ''}"""


# The derived race tables, then their cleaned forms.
RACE = f"""
WITH raw_races AS (
  SELECT DISTINCT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS day_no,
         CAST(o_orderdate AS DATE) AS date FROM orders),
races AS (
  SELECT CAST(day_no AS INTEGER) AS raceId, CAST(year(date) AS INTEGER) AS year,
         'Meeting ' || lpad(CAST(month(date) AS VARCHAR), 2, '0') AS name, date, {season('month(date)')} AS season_name,
         {band("CASE WHEN day_no % 11 <> 3 THEN lpad(CAST(day_no * 7 % 24 AS VARCHAR), 2, '0') || ':30:00' END")}
           AS time_of_day
  FROM raw_races),
raw_drivers AS (
  SELECT c_custkey AS driverId, DATE '1960-01-01' + CAST(c_custkey * 37 % 12000 AS INTEGER) AS born,
         c_mktsegment || ' ' || c_name AS driver_name
  FROM customer WHERE c_custkey % 97 <> 5),
raw_results AS (
  SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS raceId,
         o_custkey AS driverId, constructorId,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 + o_orderkey % 9 ELSE 11 + o_orderkey % 2 END AS INTEGER)
           AS statusId,
         CAST(1 + o_orderkey * 7 % 24 AS INTEGER) AS positionOrder,
         CAST(greatest(0, 26 - 2 * (1 + o_orderkey * 7 % 24)) AS DOUBLE) AS points, laps,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(5000000 + o_orderkey * 13 % 900000 AS INTEGER) END AS milliseconds,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(1 + o_orderkey % 60 AS INTEGER) ELSE 0 END AS fastestLap,
         CASE WHEN o_orderkey % 6 <> 0 THEN CAST(1 + o_orderkey % 22 AS INTEGER) ELSE 0 END AS rank,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(140 + o_orderkey % 120 AS DOUBLE) END AS fastestLapSpeed,
         CASE WHEN o_orderkey % 5 <> 0 THEN (60000 + (10 + o_orderkey % 50) * 1000 + o_orderkey % 1000) / 1000 END
           AS avg_lap_time_seconds
  FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS constructorId, CAST(count(*) AS INTEGER) AS laps
                    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey),
results AS (
  SELECT raceId, driverId, constructorId, statusId, positionOrder, points, laps,
         coalesce(milliseconds, CAST(trunc((SELECT avg(milliseconds) FROM raw_results)) AS INTEGER)) AS milliseconds,
         fastestLap, rank,
         coalesce(fastestLapSpeed, (SELECT avg(fastestLapSpeed) FROM raw_results)) AS fastestLapSpeed,
         coalesce(avg_lap_time_seconds, (SELECT avg(avg_lap_time_seconds) FROM raw_results)) AS avg_lap_time_seconds,
         {place_group('positionOrder')} AS position_group,
         count(raceId) OVER (PARTITION BY driverId ORDER BY raceId) AS driver_experience,
         max(CASE WHEN positionOrder <= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY constructorId) AS constructor_success
  FROM raw_results),
wins AS ({win_rate('raw_results', 'driverId', 'raceId', 'positionOrder = 1')}),
drivers AS (
  SELECT d.driverId, CAST(2018 - year(born) AS INTEGER) AS age, total_wins AS totalWins, total_races AS totalRaces,
         win_rate AS winRate
  FROM raw_drivers d LEFT JOIN wins w ON d.driverId = w.driverId),
constructors AS (
  SELECT s_suppkey AS constructorId, lower(s_name) AS constructorRef, s_name AS constructor_name,
         n_name AS constructor_nationality
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
status AS (
  SELECT * FROM (VALUES (1, 'Finished'), (2, 'Engine'), (3, 'Spun-off'), (4, 'Collision'), (5, 'Gearbox-off'),
    (6, 'Accident'), (7, 'Hydraulics'), (8, 'Suspension'), (9, 'Brakes'), (10, 'Clutch'), (11, '+1 Lap'),
    (12, 'Retired')) v(statusId, status)),
lines AS (
  SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS raceId,
         o_custkey AS driverId, l_linenumber AS lap, CAST(1 + l_partkey % 20 AS INTEGER) AS position,
         CASE WHEN l_partkey % 40 <> 0 THEN CAST(20 + l_quantity AS INTEGER) END AS seconds, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lapTimes AS (
  SELECT *, coalesce(round((1 - abs(avg_position_change) / nullif(max_position - 1, 0))
                           * CASE WHEN avg_position_change > 0 THEN 1 ELSE -1 END, 0) + 0.0, 1.0) AS position_change_index
  FROM (SELECT raceId, driverId, round(avg(change), 0) + 0.0 AS avg_position_change, max(position) AS max_position
        FROM (SELECT *, coalesce(lag(position) OVER (PARTITION BY raceId, driverId ORDER BY lap, position) - position, -1)
                AS change FROM lines)
        GROUP BY raceId, driverId)),
pitStops AS (
  SELECT raceId, driverId, total_stop_duration AS total_pitStop_duration, avg_stop_duration AS avg_pitStop_duration,
         total_stops AS total_pitStops, avg_laps_between_stops AS avg_laps_between_pitstops,
         stop_efficiency AS pitStop_efficiency, {LABEL} AS pitStopFrequencyLabel
  FROM ({stops("(SELECT * FROM lines WHERE l_returnflag = 'R')", 'raceId, driverId', 'seconds', 'lap')})
  WHERE total_stop_duration IS NOT NULL AND stop_efficiency IS NOT NULL),
with_drivers AS (SELECT * FROM results JOIN races USING (raceId) JOIN drivers USING (driverId)),
with_teams AS (SELECT * FROM with_drivers JOIN constructors USING (constructorId)),
with_laps AS (SELECT * FROM with_teams JOIN status USING (statusId) JOIN lapTimes USING (raceId, driverId)),
base AS (SELECT * FROM with_laps JOIN pitStops USING (raceId, driverId))
"""

# The statuses that mean a failure.
FAILURES = (
    "('Engine', 'Spun-off', 'Collision', 'Gearbox-off', 'Accident', 'Hydraulics', 'Suspension', 'Brakes', 'Clutch')"
)

DOCS = "(SELECT l.doc_id, quality, toxic, lang, source, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
RULE = f"(SELECT *, CASE WHEN n_chars > 500 AND toxic = 0 THEN 1 ELSE 0 END AS prediction FROM {DOCS})"
POSITIONS = "(SELECT event_id, user_id, ts, CAST(floor(value) AS INTEGER) AS position FROM events)"
CHANGES = (
    "(SELECT *, CASE WHEN before IS NULL THEN -1 ELSE before - position END AS position_change FROM "
    f"(SELECT *, lag(position) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {POSITIONS}))"
)
LINE_STOPS = stops(
    "(SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS duration FROM lineitem)",
    "l_orderkey", "duration", "l_linenumber",
)
FINISHED = "o_orderstatus = 'F'"
GAPPY = (
    "(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice < 200000 THEN o_totalprice END "
    "AS price FROM orders)"
)
CUSTOMER_WINS = f"({win_rate('orders', 'o_custkey', 'o_orderkey', FINISHED)})"


def summary(scale: int, digits: int) -> str:
    return f"""
        SELECT user_id, round(mean_change, {digits}) + 0.0 AS avg_position_change, max_position,
               coalesce(round((1 - abs(mean_change) / nullif(max_position - 1, 0))
                              * CASE WHEN mean_change > 0 THEN 1 ELSE -1 END, {scale}) + 0.0, 1.0) AS position_change_index
        FROM (SELECT user_id, round(avg(position_change), 0) AS mean_change, max(position) AS max_position
              FROM {CHANGES} GROUP BY user_id)"""


def described(column: str, numeric: bool) -> str:
    n = [f"round(avg({column}), 4) + 0.0", f"round(stddev_samp({column}), 4) + 0.0", f"min({column})::DOUBLE",
         f"max({column})::DOUBLE"]
    none = ["NULL::DOUBLE"] * 4
    texts = ["NULL::VARCHAR"] * 2 if numeric else [f"min({column})", f"max({column})"]
    names = ["mean", "stddev", "min_value", "max_value", "min_text", "max_text"]
    fields = ", ".join(f"{v} AS {name}" for v, name in zip((n if numeric else none) + texts, names))
    return f"SELECT '{column}' AS column_name, count({column}) AS n, {fields} FROM lineitem"


def distinct(column: str) -> str:
    return f"SELECT '{column}' AS column_name, count(DISTINCT {column}) AS n_distinct FROM lineitem"


CLASS_METRICS = f"""
    WITH c AS (SELECT lang, quality AS y, prediction AS p, count(*) AS n FROM {RULE} GROUP BY ALL),
    k AS (SELECT DISTINCT lang, y AS cls FROM c UNION SELECT DISTINCT lang, p FROM c),
    m AS (SELECT k.lang, cls,
                 (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = k.lang AND y = cls)::DOUBLE AS support,
                 (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = k.lang AND p = cls)::DOUBLE AS predicted,
                 (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = k.lang AND y = cls AND p = cls)::DOUBLE AS hits
          FROM k),
    r AS (SELECT lang, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS prec,
                 coalesce(hits / nullif(support, 0), 0) AS rec FROM m)
    SELECT lang, round(sum(hits) / sum(support), 6) + 0.0 AS accuracy,
           round(sum(support * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)) / sum(support), 6) + 0.0 AS f1,
           round(sum(support * prec) / sum(support), 6) + 0.0 AS weighted_precision,
           round(sum(support * rec) / sum(support), 6) + 0.0 AS weighted_recall
    FROM r GROUP BY lang"""


def indexed(column: str) -> str:
    return (
        f"SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_index "
        f"FROM known GROUP BY {column}"
    )


ORACLES: dict[str, str] = {
    "q_win_rate": win_rate("orders", "o_custkey", "o_orderkey", "o_orderstatus = 'F'"),
    "q_win_rate_as_of": """
        SELECT o_custkey, day, CAST(coalesce(sum(wins) OVER w, 0) AS BIGINT) AS wins_before,
               count(*) OVER w AS races_before,
               round(coalesce(sum(wins) OVER w, 0) / nullif(count(*) OVER w, 0), 3) AS win_rate_before
        FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
                     count(*) FILTER (WHERE o_orderstatus = 'F') AS wins FROM orders GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY o_custkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "q_profile_left_join": f"""
        SELECT key AS o_custkey, c_mktsegment, total_wins, total_races, win_rate
        FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END AS key, c_mktsegment FROM customer)
        LEFT JOIN ({win_rate('orders', 'o_custkey', 'o_orderkey', "o_orderstatus = 'F'")})
          ON key = o_custkey""",
    "q_entry_dates": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, count(*) AS n, max(l_linenumber) AS top
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "q_age_in_year": """
        SELECT o_custkey, CASE WHEN o_custkey % 3 < 2 THEN CAST(2018 - year(min(o_orderdate)) AS INTEGER) END AS age
        FROM orders GROUP BY o_custkey""",
    "q_full_name_clean": """
        SELECT s_suppkey, n_name || ' ' || s_name AS full_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "q_experience": """
        SELECT o_orderkey, o_custkey, count(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS experience
        FROM orders""",
    "q_experience_many_ties": """
        SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
               count(*) OVER (PARTITION BY event_type ORDER BY strftime(ts, '%Y-%m-%d')) AS experience FROM events""",
    "q_position_change": f"SELECT event_id, user_id, position, position_change FROM {CHANGES}",
    "q_position_summary_index": summary(0, 0),
    "q_position_summary_direct": summary(3, 3),
    "q_stop_summary": LINE_STOPS,
    "q_stop_clean_label": f"""
        SELECT *, {LABEL} AS stop_frequency_label FROM ({LINE_STOPS}) WHERE stop_efficiency IS NOT NULL""",
    "q_global_mean": f"SELECT round(avg(total_stops), 6) + 0.0 AS mean_stops FROM ({LINE_STOPS})",
    "q_group_success": """
        SELECT l_orderkey, l_linenumber, l_quantity,
               CASE WHEN min(l_quantity) OVER (PARTITION BY l_orderkey) <= 3 THEN 1 ELSE 0 END AS group_success
        FROM lineitem""",
    "q_season": f"SELECT o_orderkey, {season('month(o_orderdate)')} AS season_name FROM orders",
    "q_time_band": f"SELECT event_id, {band(CLOCK)} AS time_of_day FROM events",
    "q_time_band_strict": f"SELECT event_id, {band(CLOCK, True)} AS time_of_day FROM events",
    "q_lap_time": f"""
        SELECT event_id, round({lap_ms('lap')}, 3) AS lap_ms FROM (
          SELECT event_id, CASE WHEN event_type = 'error' THEN '\\N' ELSE
                   (c // 6000) || ':' || lpad(CAST((c // 100) % 60 AS VARCHAR), 2, '0') || '.'
                   || lpad(CAST(c % 100 AS VARCHAR), 2, '0') END AS lap
          FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events))""",
    "q_clean_numeric": f"""
        SELECT event_id, {to_int('text')} AS amount FROM (
          SELECT event_id, CASE event_type WHEN 'error' THEN '16:44.718' WHEN 'signup' THEN '\\N'
                                           ELSE CAST(value AS VARCHAR) END AS text FROM events)""",
    "q_position_group": f"""
        SELECT {place_group('CASE WHEN l_quantity < 50 THEN l_quantity END')} AS position_group, count(*) AS n
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "q_binary_label": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders",
    "q_filters": """
        SELECT count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_null,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS n_equal,
               count(*) FILTER (WHERE year(o_orderdate) IN (1996, 1997, 1998)) AS n_member,
               count(*) FILTER (WHERE month(o_orderdate) BETWEEN 3 AND 5) AS n_between,
               count(*) FILTER (WHERE year(o_orderdate) = 1996) AS n_text_between,
               count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderpriority LIKE '%-%') AS n_dash,
               count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderpriority LIKE '%/%') AS n_slash,
               count(*) FILTER (WHERE isnan(o_totalprice) OR o_totalprice > 250000) AS n_either
        FROM orders WHERE o_orderstatus <> 'P'""",
    "q_filter_rows": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "q_null_profile": f"""
        SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS n_null FROM {GAPPY}
        UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders
        UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders
        UNION ALL SELECT 'priority', count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority = '5-LOW') FROM orders
        UNION ALL SELECT 'status', count(*) - count(status) FROM {GAPPY}
        UNION ALL SELECT 'price', count(*) - count(price) FROM {GAPPY}""",
    "q_null_rows": f"SELECT o_orderkey, status FROM {GAPPY} WHERE status IS NULL",
    "q_cardinality": " UNION ALL ".join(
        distinct(c)
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice")
    ),
    "q_describe": " UNION ALL ".join(
        described(c, numeric)
        for c, numeric in (
            *((c, True) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                  "l_discount", "l_tax")),
            *((c, False) for c in ("l_returnflag", "l_linestatus", "l_shipdate")),
        )
    ),
    "q_impute_zero_mean": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN l_linenumber ELSE 0 END AS rank,
               round(CASE WHEN l_quantity < 45 THEN l_quantity ELSE m END, 6) + 0.0 AS speed,
               CAST(CASE WHEN l_quantity < 45 THEN l_quantity ELSE trunc(m) END AS INTEGER) AS speed_int
        FROM lineitem, (SELECT avg(l_quantity) AS m FROM lineitem WHERE l_quantity < 45)""",
    "q_preview": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
    "q_base_table": """
        SELECT o_orderkey, o_custkey AS custkey, o_orderstatus, c_mktsegment, n_name, r_name, quantity, visits
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        JOIN (SELECT user_id, count(*) AS visits FROM events GROUP BY 1) ON user_id = o_custkey""",
    "q_composite_join": """
        SELECT l_orderkey, l_suppkey, sum(l_quantity) AS quantity, count(*) FILTER (WHERE l_returnflag = 'R') AS stops
        FROM lineitem GROUP BY 1, 2 HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0""",
    "q_top_k_winners": """
        SELECT o_custkey, wins, points, c_name FROM (
          SELECT o_custkey, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS wins,
                 CAST(sum(floor(o_totalprice)) AS BIGINT) AS points
          FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1
          ORDER BY wins DESC NULLS LAST, o_custkey LIMIT 10)
        LEFT JOIN customer ON o_custkey = c_custkey""",
    "q_wins_sorted": """
        SELECT s_suppkey, s_name, count(*) FILTER (WHERE l_returnflag = 'R') AS wins
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
        HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0 ORDER BY wins DESC, s_suppkey""",
    "q_histogram": histogram("(SELECT year(o_orderdate) AS y FROM orders)", "y"),
    "q_density": density("(SELECT year(o_orderdate) AS y FROM orders)", "y", 50),
    "q_density_binned": density("lineitem", "l_quantity", 50),
    "q_pairs": pairs(CUSTOMER_WINS, "total_races", "total_wins"),
    "q_corr": f"SELECT round(corr(total_races, total_wins), 6) + 0.0 AS corr FROM {CUSTOMER_WINS}",
    "q_mean_by": mean_by("lineitem", "l_linenumber", "l_quantity"),
    "q_mean_by_two": mean_by(
        f"(SELECT event_type, {band(CLOCK)} AS time_of_day, floor(value) AS whole FROM events)",
        "event_type, time_of_day", "whole",
    ),
    "q_box_stats": box("lineitem", "l_returnflag", "l_extendedprice"),
    "q_top_status": """
        SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20""",
    "q_status_value_counts": """
        SELECT l_quantity, l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R', 'X') GROUP BY 1, 2""",
    "q_string_index": f"""
        WITH known AS (SELECT o_orderpriority AS priority, o_orderstatus AS status FROM orders
                       WHERE o_orderpriority <> '5-LOW')
        SELECT priority, priority_index, status, status_index, count(*) AS n
        FROM known JOIN ({indexed('priority')}) USING (priority) JOIN ({indexed('status')}) USING (status)
        GROUP BY ALL""",
    "q_split_sizes": """
        SELECT CASE WHEN CAST('0x' || substr(md5('123|' || o_orderkey), 1, 8) AS BIGINT) / 4294967296 < 0.7
                    THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM orders GROUP BY 1""",
    "q_confusion": f"SELECT quality AS label, prediction, count(*) AS n FROM {RULE} GROUP BY 1, 2",
    "q_confusion_metrics": CLASS_METRICS,
    "q_auc": auc(DOCS, "quality", "n_chars"),
    "q_auc_by_key": auc(
        "(SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice FROM lineitem)",
        "label", "l_extendedprice", "l_linestatus",
    ),
    "q_race_drivers": RACE + "SELECT * FROM drivers",
    "q_race_laps": RACE + "SELECT * FROM lapTimes",
    "q_race_stops": RACE + "SELECT * FROM pitStops",
    "q_race_results": RACE + """
        SELECT * REPLACE (round(fastestLapSpeed, 6) AS fastestLapSpeed,
                          round(avg_lap_time_seconds, 6) AS avg_lap_time_seconds) FROM results""",
    "q_race_base_table": RACE + """
        SELECT * REPLACE (round(fastestLapSpeed, 4) AS fastestLapSpeed, strftime(date, '%Y-%m-%d') AS date,
                          round(avg_lap_time_seconds, 4) AS avg_lap_time_seconds) FROM base""",
    "q_race_training_table": RACE + """
        SELECT CASE WHEN status = 'Finished' THEN 1 ELSE 0 END AS status, position_group, season_name, time_of_day,
               pitStopFrequencyLabel, count(*) AS n, CAST(sum(driver_experience) AS BIGINT) AS experience,
               CAST(sum(age) AS BIGINT) AS ages
        FROM base GROUP BY ALL""",
    "q_race_races_per_year": RACE + histogram("races", "year"),
    "q_race_races_per_year_density": RACE + density("races", "year", 200),
    "q_race_top_drivers": RACE + """
        SELECT driverId, wins, points, driver_name FROM (
          SELECT driverId, nullif(count(*) FILTER (WHERE positionOrder = 1), 0) AS wins, round(sum(points), 4) AS points
          FROM base WHERE year BETWEEN 1996 AND 1998 GROUP BY 1 ORDER BY wins DESC NULLS LAST, driverId LIMIT 10)
        LEFT JOIN raw_drivers USING (driverId)""",
    "q_race_constructor_wins": RACE + """
        SELECT constructorId, constructor_name, count(*) FILTER (WHERE positionOrder = 1) AS wins FROM with_teams
        GROUP BY 1, 2 HAVING count(*) FILTER (WHERE positionOrder = 1) > 0""",
    "q_race_position_groups": RACE + "SELECT position_group, count(*) AS n FROM results GROUP BY 1",
    "q_race_races_vs_wins": RACE + pairs("with_drivers", "totalRaces", "totalWins"),
    "q_race_races_wins_correlation": RACE
    + "SELECT round(corr(totalRaces, totalWins), 6) + 0.0 AS corr FROM with_drivers",
    "q_race_win_rates": RACE + histogram("with_drivers", "winRate"),
    "q_race_win_rates_density": RACE + density("with_drivers", "winRate", 200),
    "q_race_rank_by_experience": RACE + mean_by("with_drivers", "driver_experience", "rank"),
    "q_race_wins_by_race_and_season": RACE + mean_by("with_laps", "name, season_name", "totalWins"),
    "q_race_lap_seconds_by_season": RACE + box("with_laps", "season_name", "avg_lap_time_seconds"),
    "q_race_position_change_by_season": RACE + box("with_laps", "season_name", "avg_position_change"),
    "q_race_stops_by_season": RACE + mean_by("base", "season_name", "total_pitStops"),
    "q_race_stops_by_season_and_time": RACE + mean_by(
        "(SELECT * FROM base WHERE time_of_day IS NOT NULL)", "season_name, time_of_day", "total_pitStops"
    ),
    "q_race_stop_duration_by_season": RACE + box("base", "season_name", "avg_pitStop_duration"),
    "q_race_top_statuses": RACE + """
        SELECT status, count(*) AS n FROM with_laps GROUP BY 1 ORDER BY n DESC, status LIMIT 20""",
    "q_race_failures_by_speed": RACE + f"""
        SELECT round(fastestLapSpeed, 4) AS fastestLapSpeed, status, count(*) AS n FROM with_laps
        WHERE status IN {FAILURES} GROUP BY 1, 2""",
    "q_race_speed_by_position": RACE + mean_by("with_laps", "positionOrder", "fastestLapSpeed"),
    "q_race_duration_vs_efficiency": RACE + pairs("base", "avg_pitStop_duration", "pitStop_efficiency"),
    "q_race_efficiency_by_wins": RACE + mean_by("base", "totalWins", "pitStop_efficiency"),
    "q_race_change_by_stop_duration": RACE + mean_by("base", "avg_pitStop_duration", "position_change_index"),
}

LABELLED = """
    (SELECT *, CASE WHEN o_orderkey % 11 < 2 * level THEN 1 ELSE 0 END AS label, CASE WHEN level > 2 THEN 1 ELSE 0 END AS high
     FROM (SELECT o_orderkey, o_orderpriority AS priority, CAST(left(o_orderpriority, 1) AS INTEGER) AS level FROM orders))"""


def share_of(seed: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || o_orderkey), 1, 8) AS BIGINT) / 4294967296"


def rank_auc(table: str, score: str, by: str) -> str:
    """The area under the curve per group, not rounded."""
    pos, neg = "count(*) FILTER (WHERE label = 1)", "count(*) FILTER (WHERE label = 0)"
    return f"""SELECT {by}, (sum(r) FILTER (WHERE label = 1) - {pos} * ({pos} + 1) / 2) / ({pos}::DOUBLE * {neg}) AS auc
        FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY {score})
                        + (count(*) OVER (PARTITION BY {by}, {score}) - 1) / 2 AS r FROM {table}) GROUP BY {by}"""


def group_report(group: str) -> str:
    """Report of a model that knows one column only and gives each of its values the share of its training rows."""
    return f"""
    WITH o AS (SELECT *, CASE WHEN {share_of('123')} < 0.7 THEN 'train' ELSE 'test' END AS split FROM {LABELLED}),
    means AS (SELECT {group}, avg(label) AS mean FROM o WHERE split = 'train' GROUP BY {group}),
    s AS (SELECT *, CASE WHEN mean > 0.5 THEN 1 ELSE 0 END AS guess FROM o JOIN means USING ({group})),
    k AS (SELECT split, cls, count(*) FILTER (WHERE label = cls)::DOUBLE AS support,
                 count(*) FILTER (WHERE guess = cls)::DOUBLE AS predicted,
                 count(*) FILTER (WHERE label = cls AND guess = cls)::DOUBLE AS hits
          FROM s, (VALUES (0), (1)) c(cls) GROUP BY split, cls),
    r AS (SELECT split, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS prec,
                 coalesce(hits / nullif(support, 0), 0) AS rec FROM k),
    m AS (SELECT split, CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 6) AS accuracy,
                 round(sum(support * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)) / sum(support), 6) AS f1,
                 round(sum(support * prec) / sum(support), 6) AS weighted_precision,
                 round(sum(support * rec) / sum(support), 6) AS weighted_recall FROM r GROUP BY split)"""


GROUP_REPORT = group_report("priority")
ORACLES |= {
    "q_string_index_many": """
        SELECT part, CAST(row_number() OVER (ORDER BY n DESC, part) - 1 AS DOUBLE) AS part_index, n
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS part, count(*) AS n FROM lineitem GROUP BY 1)""",
    "q_encoded_features": f"""
        SELECT o_orderkey, 'priority_' || priority AS feature, 1.0::DOUBLE AS value FROM {LABELLED}
        UNION ALL SELECT o_orderkey, 'level', CAST(level AS DOUBLE) FROM {LABELLED}""",
    "q_logistic_means": f"""
        SELECT priority, round(mean, 3) + 0.0 AS finish_probability, CASE WHEN mean > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, n
        FROM (SELECT priority, avg(label) AS mean, count(*) AS n FROM {LABELLED} GROUP BY 1)""",
    "q_log_odds": f"""
        SELECT 'high' AS feature, round(max(ln(p / (1 - p))) FILTER (WHERE high = 1)
                                        - max(ln(p / (1 - p))) FILTER (WHERE high = 0), 3) + 0.0 AS importance
        FROM (SELECT high, avg(label) AS p FROM {LABELLED} GROUP BY high)""",
    "q_tree_majority": f"""
        SELECT priority, CASE WHEN avg(label) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, count(*) AS n
        FROM {LABELLED} GROUP BY 1""",
    "q_svm_apart": f"SELECT o_orderkey, CAST(label AS DOUBLE) AS prediction FROM {LABELLED}",
    "q_group_report": GROUP_REPORT + f"""
        SELECT model, m.*, CASE WHEN model = 'lr' THEN round(auc, 6) END AS auc FROM m JOIN ({rank_auc('s', 'mean', 'split')}) USING (split),
               (VALUES ('lr'), ('tree')) both_models(model)""",
    "q_subset_report": group_report("high") + f"""
        SELECT 'tree' AS model, m.*, round(auc, 6) AS auc FROM m JOIN ({rank_auc('s', 'mean', 'split')}) USING (split)""",
    "q_group_best": GROUP_REPORT + "SELECT 'lr' AS model, split, n, accuracy FROM m WHERE split = 'test'",
    "q_fold_auc": f"""
        WITH f AS (SELECT *, CAST(floor({share_of('fold 123')} * 5) AS INTEGER) AS fold FROM {LABELLED})
        SELECT reg_param, 0.0::DOUBLE AS elastic_net_param, round(avg(auc), 6) + 0.0 AS mean_auc
        FROM ({rank_auc('f', 'level', 'fold')}), (VALUES (0.01::DOUBLE), (0.1::DOUBLE)) g(reg_param) GROUP BY reg_param""",
    "q_race_circuits": "SELECT r_name AS circuit_name FROM region",
    "q_race_constructor_results": "SELECT CAST(o_orderkey % 44 AS DOUBLE) AS points, count(*) AS n FROM orders GROUP BY 1",
    "q_race_pre_race": RACE + f""",
        d AS (SELECT driverId, raceId, count(*) OVER w AS races,
                     coalesce(sum(won) OVER w, 0) AS wins FROM (
                SELECT driverId, raceId, count(*) FILTER (WHERE positionOrder = 1) AS won FROM raw_results GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY driverId ORDER BY raceId ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT constructorId, raceId, count(*) OVER w AS races,
                     coalesce(sum(won) OVER w, 0) AS wins FROM (
                SELECT constructorId, raceId, count(*) FILTER (WHERE positionOrder <= 3) AS won FROM raw_results GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY constructorId ORDER BY raceId ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT r.raceId, r.driverId, r.constructorId, CASE WHEN status = 'Finished' THEN 1 ELSE 0 END AS finished,
               d.races AS driver_experience, coalesce(round(d.wins / nullif(d.races, 0), 3), 0) AS driver_win_rate,
               c.races AS constructor_experience, coalesce(round(c.wins / nullif(c.races, 0), 3), 0) AS constructor_success_rate,
               age, season_name, time_of_day
        FROM raw_results r JOIN races USING (raceId) LEFT JOIN status USING (statusId)
        JOIN d ON d.driverId = r.driverId AND d.raceId = r.raceId
        JOIN c ON c.constructorId = r.constructorId AND c.raceId = r.raceId
        LEFT JOIN drivers ON drivers.driverId = r.driverId""",
}
ORACLES["q_cardinality_one_scan"] = ORACLES["q_cardinality"]
for _name in ("q_position_change", "q_experience", "q_win_rate_as_of", "q_box_stats", "q_auc_by_key"):
    ORACLES[f"{_name}_cut"] = ORACLES[_name]

ENTRY = "raceId, driverId"
HOT = """(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 50 <> 7 THEN o_custkey END AS custkey,
                 CAST(o_orderkey % 24 AS INTEGER) AS place FROM orders)"""
DAMAGED = """(SELECT o_orderkey, CAST(o_custkey % 3 AS INTEGER) AS part, floor(o_totalprice)::DOUBLE AS good_price,
                     CASE WHEN o_orderkey % 19 = 3 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS price,
                     CASE WHEN o_orderkey % 23 = 4 THEN '1997-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
                     o_orderstatus AS status, o_orderkey % 17 AS kind FROM orders)"""
ORACLES |= {
    "q_mean_by_bootstrap": bootstrap("lineitem", "l_linenumber", "l_quantity", "l_orderkey, l_linenumber, l_partkey"),
    "q_race_wins_by_race_and_season_bootstrap": RACE + bootstrap("with_laps", "name, season_name", "totalWins", ENTRY),
    "q_race_stops_by_season_bootstrap": RACE + bootstrap("base", "season_name", "total_pitStops", ENTRY),
    "q_race_stops_by_season_and_time_bootstrap": RACE + bootstrap(
        "(SELECT * FROM base WHERE time_of_day IS NOT NULL)", "season_name, time_of_day", "total_pitStops", ENTRY
    ),
    "q_race_speed_by_position_bootstrap": RACE + bootstrap("with_laps", "positionOrder", "fastestLapSpeed", ENTRY),
    "q_race_efficiency_by_wins_bootstrap": RACE + bootstrap("base", "totalWins", "pitStop_efficiency", ENTRY),
    "q_race_change_by_stop_duration_bootstrap": RACE + bootstrap(
        "base", "avg_pitStop_duration", "position_change_index", ENTRY
    ),
    "q_log_odds_errors": f"""
        WITH c AS (SELECT high, label, count(*)::DOUBLE AS n FROM {LABELLED} GROUP BY 1, 2),
        e AS (SELECT 'high' AS feature, sqrt(sum(1 / n)) AS err,
                     sum(CASE WHEN high = label THEN ln(n) ELSE -ln(n) END) AS coef FROM c
              UNION ALL SELECT '(intercept)', sqrt(sum(1 / n)), sum(CASE WHEN label = 1 THEN ln(n) ELSE -ln(n) END)
              FROM c WHERE high = 0)
        SELECT feature, round(coef, 3) + 0.0 AS coefficient, round(err, 3) + 0.0 AS std_error, round(coef / err, 3) + 0.0 AS z
        FROM e""",
    "q_hash_collisions": """
        SELECT 1 + CAST('0x' || substr(md5(part), 1, 8) AS BIGINT) % 512 AS place, count(*) AS n_values,
               CAST(sum(k) AS BIGINT) AS n
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS part, count(*) AS k FROM lineitem GROUP BY 1)
        GROUP BY 1 HAVING count(*) > 1""",
    "q_history_features": """
        SELECT o_custkey, day, count(*) OVER w AS races_before, CAST(coalesce(sum(entries) OVER w, 0) AS BIGINT) AS entries_before,
               CAST(coalesce(sum(wins) OVER w, 0) AS BIGINT) AS wins_before,
               round(coalesce(sum(wins) OVER w, 0) / nullif(count(*) OVER w, 0), 3) AS win_rate_before
        FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS entries,
                     count(*) FILTER (WHERE o_orderstatus = 'F') AS wins FROM orders GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY o_custkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        QUALIFY day >= '1997-06-01'""",
    "q_history_state": """
        SELECT o_custkey, count(DISTINCT strftime(o_orderdate, '%Y-%m-%d')) AS races, count(*) AS entries,
               CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS wins,
               max(strftime(o_orderdate, '%Y-%m-%d')) AS last_event
        FROM orders GROUP BY 1""",
    "q_heavy_hitters": f"""
        SELECT custkey, count(*) AS n FROM {HOT} GROUP BY custkey
        HAVING count(*) >= 0.01 * (SELECT count(*) FROM orders)""",
    "q_salted_join": f"SELECT h.*, c_name FROM {HOT} h LEFT JOIN customer ON custkey = c_custkey",
    "q_group_success_hot": f"""
        SELECT *, max(CASE WHEN place <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY custkey) AS group_success
        FROM {HOT} WHERE custkey IS NOT NULL""",
    "q_experience_hot": f"""
        SELECT *, count(*) OVER (PARTITION BY custkey ORDER BY day) AS experience
        FROM (SELECT *, CASE WHEN custkey = 1 THEN 1 ELSE place END AS day FROM {HOT})""",
    "q_base_table_hot": f"""
        SELECT h.*, c_nationkey, quantity FROM {HOT} h JOIN customer ON custkey = c_custkey
        JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "q_null_key_merge": f"""
        SELECT h.*, n, worst FROM {HOT} h
        JOIN (SELECT custkey AS k, count(*) AS n, max(place) AS worst FROM {HOT} GROUP BY 1) ON custkey IS NOT DISTINCT FROM k""",
    "q_csv_types": """
        SELECT CAST(position AS INTEGER) AS position, column_name, CASE
            WHEN n = 0 THEN 'string'
            WHEN n = n_bool THEN 'boolean' WHEN n = n_int THEN 'int' WHEN n = n_big THEN 'bigint'
            WHEN n = n_double THEN 'double' WHEN n = n_date THEN 'date' WHEN n = n_time THEN 'timestamp' ELSE 'string' END AS data_type
        FROM (SELECT position, column_name, count(v) AS n,
                     count(*) FILTER (WHERE v IN ('true', 'false')) AS n_bool,
                     count(*) FILTER (WHERE TRY_CAST(v AS INTEGER) IS NOT NULL AND regexp_full_match(v, '-?[0-9]+')) AS n_int,
                     count(*) FILTER (WHERE TRY_CAST(v AS BIGINT) IS NOT NULL AND regexp_full_match(v, '-?[0-9]+')) AS n_big,
                     count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) IS NOT NULL) AS n_double,
                     count(*) FILTER (WHERE TRY_CAST(v AS DATE) IS NOT NULL AND length(v) = 10) AS n_date,
                     count(*) FILTER (WHERE TRY_CAST(v AS TIMESTAMP) IS NOT NULL AND length(v) > 10) AS n_time
              FROM (SELECT unnest(range(10)) AS position, unnest(['o_orderkey', 'big', 'price', 'day', 'moment', 'even', 'gaps',
                                                                 'empty', 'nearly', 'priority']) AS column_name,
                           unnest([CAST(o_orderkey AS VARCHAR), CAST(o_orderkey * 4000000000 AS VARCHAR),
                                   CAST(o_totalprice AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'),
                                   strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), CAST(o_orderkey % 2 = 0 AS VARCHAR),
                                   CAST(nullif(o_orderkey % 7, 0) AS VARCHAR), NULL,
                                   CASE WHEN o_orderkey = 1 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END, o_orderpriority]) AS v
                    FROM orders)
              GROUP BY position, column_name)""",
    "q_csv_base_table": ORACLES["q_race_base_table"],
    "q_csv_damage": f"""
        SELECT part AS folder, column_name, count(*) AS n FROM (
          SELECT part, unnest([CASE WHEN kind IN (1, 2) THEN '_line' END, CASE WHEN price = 'n/a' THEN 'price' END,
                               CASE WHEN kind <> 2 AND day = '1997-02-30' THEN 'day' END]) AS column_name FROM {DAMAGED})
        WHERE column_name IS NOT NULL GROUP BY 1, 2""",
    "q_csv_rescued": f"""
        SELECT part, o_orderkey, CASE WHEN price <> 'n/a' THEN good_price END AS price,
               CASE WHEN kind <> 2 AND day <> '1997-02-30' THEN day END AS day, CASE WHEN kind <> 2 THEN status END AS status,
               CASE WHEN price = 'n/a' THEN price END AS rescued_price,
               CASE WHEN kind <> 2 AND day = '1997-02-30' THEN day END AS rescued_day,
               CASE kind WHEN 1 THEN concat_ws(',', part, o_orderkey, price, day, status, 'more')
                         WHEN 2 THEN concat_ws(',', part, o_orderkey, price) END AS line
        FROM {DAMAGED}""",
}
