"""The same queries as SQL over the driver's tables, written independently of the Spark plans."""

from __future__ import annotations

from tidemark.functions.colors import COLOR_NAMES

SEASON = "2017-2018"
COLOR_ROWS = ", ".join(f"({r}, {g}, {b}, '{name}')" for (r, g, b), name in COLOR_NAMES.items())

WEATHER = """days AS (
  SELECT l_returnflag AS country, CAST(l_shipdate AS DATE) AS date, l_quantity - 20 AS temperature_avg,
         l_quantity - 20 - l_tax * 100 AS temperature_min, l_quantity - 20 + l_discount * 100 AS temperature_max,
         l_extendedprice / 100 AS snow_depth
  FROM lineitem)"""

SENSORS = """readings AS (
  SELECT ts, CASE WHEN event_type = 'click' THEN value * 100 END AS solar,
         CASE WHEN event_type = 'error' THEN value * 100 END AS cooling1,
         CASE WHEN event_type = 'purchase' THEN value * 100 END AS cooling2,
         CASE WHEN event_type = 'signup' THEN value * 100 END AS ventilation,
         CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN value END AS temperature,
         CASE WHEN event_type = 'view' AND user_id % 2 = 1 THEN value END AS price
  FROM events),
hourly AS (
  SELECT date_trunc('hour', ts + INTERVAL {shift} HOUR) AS hour, avg(temperature) AS temperature,
         avg(solar) / 1000 AS produced, (avg(cooling1) + avg(cooling2) + avg(ventilation)) / 1000 AS consumed,
         avg(price) AS price
  FROM readings GROUP BY 1),
daily AS (
  SELECT CAST(hour AS DATE) AS "Date", round(avg(temperature), 2) AS "Temperature",
         round(sum(produced), 2) AS "ProducedEnergy", round(sum(consumed), 2) AS "ConsumedEnergy",
         round(sum((consumed - produced) * price / 1000), 2) AS "DailyCost"
  FROM hourly GROUP BY 1)"""

DAILY_SALES = """daily AS (
  SELECT CAST(l_shipdate AS DATE) AS "orderDate", round(sum(l_extendedprice * CAST(l_quantity AS INTEGER)), 2) AS "totalSales",
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS "totalCount"
  FROM lineitem GROUP BY 1)"""
BEST_DAYS = f'WITH {DAILY_SALES} SELECT * FROM daily ORDER BY "totalSales" DESC, "orderDate" LIMIT 8'

GAMES = """games AS (
  SELECT 'Publisher' || c_nationkey AS publisher, year(o_orderdate) AS y,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS na, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1996 AND 1999),
best AS (SELECT publisher, sum(na) AS s FROM games GROUP BY 1 ORDER BY s DESC, publisher LIMIT 1)"""

INCIDENTS = """incidents AS (
  SELECT 'A-' || o_orderkey AS "ID", o_orderdate AS "Start_Time", 'Order ' || o_orderpriority AS "Description",
         'City' || (o_custkey % 50) AS "City", o_orderstatus AS "State", round(o_totalprice / 5000, 1) AS "Temperature_F",
         o_orderkey
  FROM orders),
latest AS (
  SELECT "ID" || '_Z1' AS "ID", "Start_Time", "Description", "City", "State", "Temperature_F"
  FROM incidents WHERE "City" = 'City7' ORDER BY "Start_Time" DESC, incidents."ID" LIMIT 73),
drifted AS (
  SELECT replace("ID", '_Z1', '_Z2') AS "ID", "Start_Time", "City", "State",
         round(("Temperature_F" - 32) * 5 / 9, 4) AS "Temperature_C", 'prefix-' || "City" AS "AddedColumn1",
         'New column' AS "AddedColumn2"
  FROM latest),
evolved AS (
  SELECT "ID", "Start_Time", "Description", "City", "State", "Temperature_F", CAST(NULL AS DOUBLE) AS "Temperature_C",
         CAST(NULL AS VARCHAR) AS "AddedColumn1", CAST(NULL AS VARCHAR) AS "AddedColumn2"
  FROM incidents
  UNION ALL
  SELECT "ID", "Start_Time", NULL, "City", "State", NULL, "Temperature_C", "AddedColumn1", "AddedColumn2" FROM drifted)"""

LINES = r"""lines AS (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents),
words AS (
  SELECT word FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
  WHERE length(word) > 0 AND NOT regexp_matches(word, '[0-9]'))"""

FOOTBALL = f"""base AS (
  SELECT l_orderkey AS k, l_orderkey % 5 AS c, (l_orderkey // 5) % 10 AS h,
         ((l_orderkey // 5) % 10 + 1 + (l_orderkey // 50) % 9) % 10 AS a,
         l_linenumber AS line, l_quantity AS q, l_discount AS d, l_returnflag AS flag, l_linestatus AS status
  FROM lineitem),
ev AS (
  SELECT k AS "matchId", 'League' || c AS competition, CASE WHEN k % 3 = 0 THEN '2016-2017' ELSE '{SEASON}' END AS season,
         'T' || c || '-' || h AS "homeTeam", 'T' || c || '-' || a AS "awayTeam",
         CASE WHEN line % 2 = 1 THEN 'T' || c || '-' || h ELSE 'T' || c || '-' || a END AS "eventTeam",
         flag, d >= 0.05 AS tagged, CASE WHEN status = 'F' THEN 1 ELSE 2 END AS half, q * 58 + line AS t
  FROM base),
results AS (
  SELECT "matchId", competition, season, "homeTeam", "awayTeam",
         count(*) FILTER (flag = 'R' AND tagged AND "eventTeam" = "awayTeam") AS "homeTeamGoals",
         count(*) FILTER (flag = 'R' AND tagged AND "eventTeam" = "homeTeam") AS "awayTeamGoals"
  FROM ev GROUP BY ALL),
sides AS (
  SELECT competition, season, "homeTeam" AS team, "homeTeamGoals" AS f, "awayTeamGoals" AS g FROM results
  UNION ALL SELECT competition, season, "awayTeam", "awayTeamGoals", "homeTeamGoals" FROM results),
standings AS (
  SELECT competition, season, team, count(*) AS games, count(*) FILTER (f > g) AS wins, count(*) FILTER (f = g) AS draws,
         count(*) FILTER (f < g) AS losses, CAST(sum(f) AS BIGINT) AS "goalsScored", CAST(sum(g) AS BIGINT) AS "goalsConceded",
         3 * count(*) FILTER (f > g) + count(*) FILTER (f = g) AS points
  FROM sides GROUP BY 1, 2, 3),
placed AS (
  SELECT competition, season,
         CAST(row_number() OVER (PARTITION BY competition, season
              ORDER BY points DESC, "goalsScored" - "goalsConceded" DESC, "goalsScored" DESC, team) AS INTEGER) AS "Pos",
         team AS "Team", games AS "Pld", wins AS "W", draws AS "D", losses AS "L", "goalsScored" AS "GF",
         "goalsConceded" AS "GA",
         CASE WHEN "goalsScored" > "goalsConceded" THEN '+' ELSE '' END
           || CAST("goalsScored" - "goalsConceded" AS VARCHAR) AS "GD", points AS "Pts"
  FROM standings),
passes AS (
  SELECT "matchId", competition, season, "eventTeam" AS team, count(*) FILTER (tagged) AS "successfulPasses",
         count(*) AS "totalPasses"
  FROM ev WHERE flag = 'A' GROUP BY 1, 2, 3, 4),
ratios AS (
  SELECT competition, team, round(avg(CAST("successfulPasses" AS DOUBLE) / "totalPasses" * 100), 2) AS ratio
  FROM passes WHERE season = '{SEASON}' GROUP BY 1, 2),
lengths AS (
  SELECT "matchId", CAST(ceil(max(t) / 60) AS INTEGER) + 45 AS len FROM ev WHERE half = 2 AND season = '{SEASON}' GROUP BY 1),
chosen AS (
  SELECT DISTINCT k, 'League' || c AS competition, c * 10 + h AS hn, c * 10 + a AS an, 'T' || c || '-' || h AS ht,
         'T' || c || '-' || a AS away
  FROM base WHERE k % 3 <> 0),
teams AS (
  SELECT k, competition, hn AS n, ht AS team FROM chosen UNION ALL SELECT k, competition, an, away FROM chosen),
subs AS (
  SELECT k, n, i, n * 100 + 11 + i AS p_in, n * 100 + 1 + (k + 3 * i) % 11 AS p_out, 40 + (7 * k + 13 * i) % 50 AS minute
  FROM teams, (VALUES (1), (2), (3)) AS s(i) WHERE (k + i) % 4 <> 0),
came AS (SELECT k, n, p_in AS p, arg_max(minute, i) AS minute FROM subs GROUP BY 1, 2, 3),
went AS (SELECT k, n, p_out AS p, arg_max(minute, i) AS minute FROM subs GROUP BY 1, 2, 3),
intervals AS (
  SELECT t.k AS "matchId", CAST(t.n * 100 + r.i AS INTEGER) AS "playerId", t.competition, '{SEASON}' AS season,
         t.team AS "playerTeam", l.len,
         CAST(coalesce(came.minute, CASE WHEN r.i <= 11 THEN 0 END) AS INTEGER) AS "startMinute",
         CAST(coalesce(went.minute, CASE WHEN came.minute IS NOT NULL OR r.i <= 11 THEN l.len END) AS INTEGER) AS "endMinute"
  FROM teams t JOIN lengths l ON l."matchId" = t.k CROSS JOIN range(1, 15) AS r(i)
  LEFT JOIN came ON came.k = t.k AND came.n = t.n AND came.p = t.n * 100 + r.i
  LEFT JOIN went ON went.k = t.k AND went.n = t.n AND went.p = t.n * 100 + r.i),
timed AS (
  SELECT "matchId", "playerId", competition, season, "playerTeam", "startMinute", "endMinute",
         CASE WHEN "startMinute" IS NULL THEN 0 ELSE "endMinute" - "startMinute" END AS minutes
  FROM intervals),
players AS (
  SELECT id AS "playerId", 'F' || id || ' L' || id AS player, 'Area' || (id % 7) AS "birthArea",
         CASE WHEN i = 1 THEN 'Goalkeeper' WHEN i <= 5 THEN 'Defender' WHEN i <= 9 THEN 'Midfielder' ELSE 'Forward' END AS role
  FROM (SELECT n * 100 + i AS id, i
        FROM (SELECT DISTINCT c * 10 + h AS n FROM base UNION SELECT DISTINCT c * 10 + a FROM base), range(1, 15) AS r(i))),
goals AS (
  SELECT "matchId", "eventTeam" AS loser, half, CASE WHEN half = 2 THEN t / 60 + 45 ELSE t / 60 END AS m
  FROM ev WHERE flag = 'R' AND tagged AND season = '{SEASON}'),
totals AS (
  SELECT "playerId", CAST(sum(CASE
           WHEN NOT coalesce(CASE WHEN half = 1
             THEN "startMinute" < 45 AND "startMinute" <= m AND (m < "endMinute" OR "endMinute" >= 45)
             ELSE "startMinute" <= m AND (m < "endMinute" OR "endMinute" = len) END, false) THEN 0
           WHEN "playerTeam" <> loser THEN 1 ELSE -1 END) AS BIGINT) AS "plusMinus"
  FROM intervals JOIN goals USING ("matchId") GROUP BY 1)"""

PIXELS = f"""names(r, g, b, name) AS (VALUES {COLOR_ROWS}),
raw AS (SELECT l_suppkey AS image, upper(substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS pixel FROM lineitem),
parts AS (
  SELECT image, pixel, CAST('0x' || substr(pixel, 1, 2) AS INTEGER) AS b, CAST('0x' || substr(pixel, 3, 2) AS INTEGER) AS g,
         CAST('0x' || substr(pixel, 5, 2) AS INTEGER) AS r, CAST('0x' || substr(pixel, 7, 2) AS INTEGER) AS alpha
  FROM raw),
named AS (
  SELECT image, pixel, CASE WHEN alpha < 128 THEN 'None' ELSE name END AS color
  FROM parts JOIN names ON names.r = CASE WHEN parts.r < 85 THEN 0 WHEN parts.r < 170 THEN 128 ELSE 255 END
   AND names.g = CASE WHEN parts.g < 85 THEN 0 WHEN parts.g < 170 THEN 128 ELSE 255 END
   AND names.b = CASE WHEN parts.b < 85 THEN 0 WHEN parts.b < 170 THEN 128 ELSE 255 END),
counts AS (SELECT image, color, count(*) AS n FROM named WHERE color <> 'None' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY n DESC, color) AS place FROM counts),
firsts AS (
  SELECT i.image, coalesce(string_agg(color, '-' ORDER BY place) FILTER (place <= 3), '') AS colors
  FROM (SELECT DISTINCT image FROM raw) i LEFT JOIN ranked ON ranked.image = i.image GROUP BY 1)"""

PAGES = f"""names(r, g, b, name) AS (VALUES {COLOR_ROWS}),
raw AS (
  SELECT page_id, unnest(regexp_extract_all(
           translate(hex(encode(html)), '0123456789ABCDEF', '084C2A6E195D3B7F'), '.{{1,8}}')) AS pixel
  FROM pages),
parts AS (
  SELECT page_id, pixel, CASE WHEN length(pixel) = 8 THEN CAST('0x' || pixel AS BIGINT) END AS v FROM raw),
split AS (SELECT page_id, (v >> 24) & 255 AS b, (v >> 16) & 255 AS g, (v >> 8) & 255 AS r, v & 255 AS alpha FROM parts),
named AS (
  SELECT page_id, CASE WHEN alpha >= 128 THEN name ELSE 'None' END AS color
  FROM split LEFT JOIN names ON names.r = CASE WHEN split.r < 85 THEN 0 WHEN split.r < 170 THEN 128 ELSE 255 END
   AND names.g = CASE WHEN split.g < 85 THEN 0 WHEN split.g < 170 THEN 128 ELSE 255 END
   AND names.b = CASE WHEN split.b < 85 THEN 0 WHEN split.b < 170 THEN 128 ELSE 255 END),
hist AS (
  SELECT page_id, upper(to_hex(page_id)) AS hexcode, count(*) AS total_pixels,
         count(*) FILTER (color <> 'None') AS colored, count(*) FILTER (color = 'Red') AS red,
         count(*) FILTER (color = 'Blue') AS blue, count(*) FILTER (color = 'Gray') AS gray
  FROM named GROUP BY 1),
meta AS (
  SELECT page_id, 'page ' || page_id AS annotation,
         CASE WHEN page_id % 3 = 0 THEN 'activities-sport' ELSE 'symbols' END AS grp
  FROM pages)"""

MEASUREMENTS = """measurements AS (
  SELECT month(l_shipdate) - 1 AS month, (l_orderkey * 61 + l_linenumber * 997) % 86400 // 3600 AS hour,
         l_linenumber = 7 AND l_returnflag = 'R' AS no_weather, l_linenumber = 7 AND l_returnflag = 'A' AS no_power,
         l_linenumber = 7 AND l_returnflag = 'N' AS no_price,
         CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|0'), 1, 8) AS BIGINT) % 10000 >= 8000 AS tested
  FROM lineitem)"""
# Each case: what is told, what must be there, and whether the inputs say anything about it.
STUDY = {
    "month_weather": ("month", "NOT no_weather", True),
    "month_power": ("month", "NOT no_power", True),
    "month_all": ("month", "NOT no_weather AND NOT no_power AND NOT no_price", True),
    "hour_weather": ("hour", "NOT no_weather", False),
    "hour_power": ("hour", "NOT no_power", True),
    "hour_all": ("hour", "NOT no_weather AND NOT no_power AND NOT no_price", True),
}
CHOICES = {
    "hour_power_price_tree": ("hour", "NOT no_power AND NOT no_price", True),
    "month_weather_solar_bayes": ("month", "NOT no_weather", True),
}


def study(cases: dict[str, tuple[str, str, bool]]) -> str:
    parts = [
        f"""SELECT '{name}' AS "case", CAST(sum(n) AS BIGINT) AS tested, round(100 * max(n) / sum(n), 6) AS commonest, {better} AS better
        FROM (SELECT {label}, count(*) AS n FROM measurements WHERE tested AND {present} GROUP BY 1)"""
        for name, (label, present, better) in cases.items()
    ]
    return f"WITH {MEASUREMENTS} " + " UNION ALL ".join(parts)


POINTS = """points AS (
  SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice AS y,
         CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|1'), 1, 8) AS BIGINT) % 10000 < 8300 AS train
  FROM lineitem),
line AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM points WHERE train)"""

UPSERT = """changes AS (
  SELECT c_custkey, c_name, c_nationkey, round(c_acctbal + 100, 2) AS c_acctbal FROM customer WHERE c_custkey % 10 = 3
  UNION ALL SELECT -c_custkey, 'New ' || c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 10 = 3)"""

CYCLIC = """scored AS (
  SELECT 'month' AS "case", 12 AS n, month(o_orderdate) - 1 AS y, (month(o_orderdate) - 1 + o_orderkey % 5) % 12 AS p FROM orders
  UNION ALL SELECT 'hour', 24, hour(ts), (hour(ts) + event_id % 7) % 24 FROM events),
away AS (SELECT "case", n, least(abs(y - p), n - abs(y - p)) AS d FROM scored)"""

CUBE = "(event_id % 97) * (event_id % 97) * (event_id % 97) * 1000 + 1"


def sessions(kind: str, name: str) -> str:
    return f"""{name} AS (SELECT user_id, event_id AS id, epoch_us(ts) // 1000 AS a, epoch_us(ts) // 1000 + {CUBE} AS b
        FROM events WHERE event_type = '{kind}')"""


VALUES_SQL = """rowed AS (
  SELECT month(l_shipdate) AS m, (l_orderkey * 61 + l_linenumber * 997) % 86400 // 3600 AS h, 6 - abs(month(l_shipdate) - 7) AS summer,
         12 - abs((l_orderkey * 61 + l_linenumber * 997) % 86400 // 3600 - 12) AS noon, l_linenumber = 7 AS gap, *
  FROM lineitem),
measured AS (
  SELECT m - 1 AS month, h AS hour, CASE WHEN NOT (gap AND l_returnflag = 'R') THEN summer * 5 + l_tax * 50 END AS temperature,
         90 - summer * 4 + l_discount * 100 AS humidity, l_quantity / 10 + CASE WHEN m > 6 THEN 3 ELSE 0 END AS wind_speed,
         CASE WHEN NOT (gap AND l_returnflag = 'A') THEN noon * 100 + l_quantity END AS power_tenants,
         CASE WHEN h > 12 THEN 50 ELSE 20 END + l_tax * 100 AS power_maintenance, noon * summer * 10 + l_discount * 10 AS power_solar_panels,
         CASE WHEN NOT (gap AND l_returnflag = 'N') THEN l_extendedprice / 1000 END AS electricity_price,
         CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|0'), 1, 8) AS BIGINT) % 10000 >= 8000 AS tested
  FROM rowed)"""


def _bayes_case(name: str, label: str, columns: tuple[str, ...]) -> str:
    """Tables ``scores_<name>``: the logarithm of every class for every tested row, and ``told_<name>``."""
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    moments = ", ".join(f"avg({c}) AS m{k}, var_pop({c}) AS v{k}" for k, c in enumerate(columns))
    largest = "greatest(" + ", ".join(f"var_pop({c})" for c in columns) + ")"
    parts = " - ".join(
        f"0.5 * ln(2 * pi() * (v{k} + e)) - ({c} - m{k}) * ({c} - m{k}) / (2 * (v{k} + e))" for k, c in enumerate(columns)
    )
    return f"""
    moments_{name} AS (SELECT {label} AS class, count(*) AS n, {moments} FROM measured WHERE NOT tested AND {present} GROUP BY 1),
    whole_{name} AS (SELECT count(*) AS total, 1e-9 * {largest} AS e FROM measured WHERE NOT tested AND {present}),
    tested_{name} AS (SELECT row_number() OVER () AS r, * FROM measured WHERE tested AND {present}),
    scores_{name} AS (
      SELECT r, {label} AS truth, class, ln(n / total) - {parts} AS score FROM tested_{name}, moments_{name}, whole_{name}),
    told_{name} AS (
      SELECT r, any_value(truth) AS truth, arg_max(class, score) AS told, max(score) AS best, max(score) FILTER (class = truth) AS own
      FROM scores_{name} GROUP BY r),
    sums_{name} AS (SELECT r, sum(exp(score - best)) AS s FROM scores_{name} JOIN told_{name} USING (r) GROUP BY r)"""


BAYES_CASES = {
    "month_weather_solar": ("month", 12, ("temperature", "humidity", "wind_speed", "power_solar_panels")),
    "hour_power_price": ("hour", 24, ("power_tenants", "power_maintenance", "power_solar_panels", "electricity_price")),
}
BAYES = f"WITH {VALUES_SQL}, " + ", ".join(_bayes_case(name, label, columns) for name, (label, _, columns) in BAYES_CASES.items())


def _away(period: int) -> str:
    return f"least(abs(truth - told), {period} - abs(truth - told))"


BAYES_STUDY = BAYES + " UNION ALL ".join(
    f"""
    SELECT '{name}' AS "case", count(*) AS predictions, {", ".join(f"round(100.0 * count_if({_away(period)} <= {k}) / count(*), 5) AS within_{k}" for k in (0, 1, 2))},
      round(avg(coalesce(exp(own - best), 0) / s), 5) AS mean_probability, round(100.0 * count_if(truth = told) / count(*), 5) AS evaluator
    FROM told_{name} JOIN sums_{name} USING (r)"""
    for name, (_, period, _) in BAYES_CASES.items()
)
BAYES_CONFUSION = BAYES + " UNION ALL ".join(
    f"""
    SELECT '{name}' AS "case", CAST(truth AS INTEGER) AS truth, CAST(told AS INTEGER) AS told, count(*) AS rows, CAST({_away(period)} AS INTEGER) AS away
    FROM told_{name} GROUP BY truth, told"""
    for name, (_, period, _) in BAYES_CASES.items()
)


def uniform(keys: str, seed: int, draw: int) -> str:
    return f"(CAST('0x' || substr(md5({keys} || '|{seed}|{draw}'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


LINE_DRAW = "l_orderkey || '|' || l_linenumber"

ORACLES: dict[str, str] = {
    "bayes_study": BAYES_STUDY,
    "bayes_confusion": BAYES_CONFUSION,
    "keyed_random_values": f"""SELECT l_orderkey, l_linenumber, round({uniform(LINE_DRAW, 5, 0)} * 100, 1) AS draw0,
        round({uniform(LINE_DRAW, 5, 1)} * 100, 1) AS draw1,
        round(sqrt(-2 * ln(1 - {uniform(LINE_DRAW, 5, 2)})) * cos(2 * pi() * {uniform(LINE_DRAW, 5, 3)}), 6) AS normal FROM lineitem""",
    "keyed_split": f"""WITH u AS (SELECT o_orderkey, {uniform("o_orderkey", 9, 0)} AS u FROM orders)
        SELECT CAST(CASE WHEN u < 0.6 THEN 0 WHEN u < 0.9 THEN 1 ELSE 2 END AS INTEGER) AS part, count(*) AS rows,
          CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM u GROUP BY 1""",
    "image_file_scan": f"WITH {PAGES} SELECT hexcode, total_pixels, colored, red, blue, gray FROM hist",
    "ranks_with_ties": """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
        rank() OVER w AS rank, dense_rank() OVER w AS dense FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_quantity DESC)""",
    "ranks_of_many_values": """SELECT o_orderkey, o_orderstatus, o_orderdate,
        rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_totalprice DESC) AS rank FROM orders""",
    "top_days_with_ties": """SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS day,
        rank() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_shipdate AS DATE) DESC) AS rank FROM lineitem QUALIFY rank <= 100""",
    "commonest_words_with_ties": f"""WITH {LINES}, counted AS (SELECT word, count(*) AS count FROM words GROUP BY 1)
        SELECT word, count, CAST(length(word) AS INTEGER) AS length,
          rank() OVER (PARTITION BY length(word) ORDER BY count DESC) AS rank FROM counted QUALIFY rank <= 3""",
    "resumed_days_stream": f"WITH {DAILY_SALES} SELECT * FROM daily",
    "events_in_sessions": f"""WITH {sessions("signup", "s")}
        SELECT s.user_id, s.id AS session, count(*) AS clicks, min(e.event_id) AS least, CAST(sum(e.event_id) AS BIGINT) AS ids
        FROM s JOIN events e ON e.user_id = s.user_id AND e.event_type = 'click' AND epoch_us(e.ts) // 1000 >= a AND epoch_us(e.ts) // 1000 < b
        GROUP BY 1, 2""",
    "events_near_errors": """WITH errors AS (SELECT event_id AS error, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'error'),
        others AS (SELECT event_type, epoch_us(ts) // 1000 AS t FROM events)
        SELECT error, count(*) AS events, count_if(event_type = 'purchase')::BIGINT AS purchases
        FROM errors JOIN others ON others.t >= errors.t - 30000 AND others.t < errors.t GROUP BY 1""",
    "overlapping_sessions": f"""WITH {sessions("signup", "s")}, {sessions("purchase", "o")}
        SELECT s.user_id, count(*) AS pairs, CAST(sum(least(s.b, o.b) - greatest(s.a, o.a)) AS BIGINT) AS milliseconds
        FROM s JOIN o ON s.user_id = o.user_id AND s.a < o.b AND o.a < s.b GROUP BY 1""",
    "widening_append": """WITH o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus AS s,
        o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d FROM orders),
        all_rows AS (
          SELECT k AS id, CAST(cents // 100 AS DECIMAL(21, 2)) AS amount, s AS status, NULL AS priority, CAST(NULL AS DATE) AS day FROM o
          UNION ALL SELECT k + 1099511627776, CAST(cents AS DECIMAL(21, 2)), s, p, NULL FROM o
          UNION ALL SELECT k % 1000, CAST(cents / 100.0 AS DECIMAL(21, 2)), CASE WHEN k % 2 = 0 THEN s END, NULL, d FROM o)
        SELECT id, CAST(amount AS VARCHAR) AS amount, status, CAST(priority AS VARCHAR) AS priority, day FROM all_rows""",
    "upsert_touched_files": f"""WITH {UPSERT}, picked AS (SELECT * FROM changes WHERE c_custkey % 1000 < 250)
        SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey,
               coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, c_mktsegment
        FROM customer t FULL OUTER JOIN picked s USING (c_custkey)""",
    "update_touched_files": """SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_custkey BETWEEN 40 AND 90 AND c_acctbal > 0 THEN round(c_acctbal / 2, 3) ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey BETWEEN 40 AND 90 AND c_acctbal > 0 THEN c_mktsegment || '*' ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
    "delete_touched_files": "SELECT * FROM orders WHERE NOT (o_orderpriority = '2-HIGH' AND o_totalprice < 100000)",
    "year_minmax": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, min(o_totalprice) AS price_min,
        max(o_totalprice) AS price_max FROM orders GROUP BY 1""",
    "year_status_stats": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS entries,
        round(min(o_totalprice), 1) AS price_min, round(max(o_totalprice), 1) AS price_max,
        CAST(round(avg(o_totalprice)) AS INTEGER) AS price_avg FROM orders GROUP BY 1, 2""",
    "point_look_ups": f"""WITH {WEATHER}, stats AS (
        SELECT year(date) AS y, country, round(min(temperature_min), 1) AS lo, round(max(temperature_max), 1) AS hi,
               round(avg(snow_depth)) AS depth FROM days GROUP BY 1, 2)
        SELECT (SELECT lo FROM stats WHERE y = 1996 AND country = 'A') AS lowest,
               (SELECT hi FROM stats WHERE y = 1997 AND country = 'N') AS highest,
               (SELECT round(hi - lo, 2) FROM stats WHERE y = 1998 AND country = 'R') AS range,
               (SELECT CAST(round(avg(depth)) AS BIGINT) FROM stats WHERE y = 1995) AS mean_depth""",
    "cond_count_zero_groups": f"""WITH {WEATHER} SELECT CAST(year(date) AS INTEGER) AS year,
        count(*) FILTER (temperature_avg < -18.5) AS count FROM days WHERE country = 'A' GROUP BY 1""",
    "warm_snow_days": f"""WITH {WEATHER} SELECT country, count(*) FILTER (temperature_avg > 5 AND snow_depth > 100) AS count
        FROM days GROUP BY 1""",
    "widest_days": """SELECT o_orderkey AS date,
        round((o_totalprice / 1000 + o_orderkey % 97) - o_totalprice / 1000, 2) AS temperature_diff
        FROM orders ORDER BY 2 DESC, 1 LIMIT 10""",
    "top_range_days": """SELECT CAST(l_shipdate AS DATE) AS day, round(max(l_extendedprice) - min(l_extendedprice), 2) AS price_range
        FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "global_minmax": "SELECT min(l_extendedprice) AS price_min, max(l_extendedprice) AS price_max FROM lineitem",
    "global_average": "SELECT round(avg(l_quantity), 3) AS quantity_avg, max(l_quantity) AS quantity_max FROM lineitem",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "count_distinct": "SELECT count(DISTINCT o_custkey) AS customers FROM orders",
    "distinct_rows": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "first_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 7",
    "last_rows": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 6",
    "ordered_index": """SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""",
    "ordered_index_by_group": """SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (
        PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""",
    "top_per_group": """SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
        FROM orders QUALIFY place <= 3""",
    "lowest_with_ties": """SELECT s_suppkey, s_nationkey, CAST(floor(s_acctbal / 2000) AS BIGINT) AS band FROM supplier
        QUALIFY floor(s_acctbal / 2000) = min(floor(s_acctbal / 2000)) OVER (PARTITION BY s_nationkey)""",
    "stratified_sample": f"""WITH {INCIDENTS}, tagged AS (
        SELECT "ID" || CASE WHEN o_orderkey % 7 = 1 THEN '_Z1' WHEN o_orderkey % 11 = 2 THEN '_Z2' ELSE '' END AS "ID",
               "Start_Time", "Description", "City", "State", "Temperature_F" FROM incidents)
        SELECT * FROM tagged QUALIFY row_number() OVER (
          PARTITION BY CASE WHEN "ID" LIKE '%Z1' THEN 1 WHEN "ID" LIKE '%Z2' THEN 2 ELSE 0 END ORDER BY "ID") <= 3""",
    "share_of_total": """SELECT o_orderstatus, o_orderpriority, count(*) AS orders,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY o_orderstatus), 2) AS share
        FROM orders GROUP BY 1, 2""",
    "poly_sum_max": """SELECT l_returnflag, CAST(sum(l_linenumber ** 3) AS BIGINT) AS sum_of_cubes,
        CAST(max(1 + 9 * l_linenumber - l_linenumber * l_linenumber) AS BIGINT) AS quadratic_max FROM lineitem GROUP BY 1""",
    "fifth_root": "SELECT p_partkey, round(pow(p_retailprice, 0.2), 6) AS root FROM part",
    "int_add": "SELECT p_partkey, p_size + p_partkey AS two, p_size + p_partkey + 7 AS three FROM part",
    "composite_key_join": """SELECT o_custkey, o_orderstatus, count(*) AS orders,
        count(*) FILTER (o_orderpriority LIKE '1%') AS urgent FROM orders GROUP BY 1, 2 HAVING urgent > 0""",
    "forest_study": study(STUDY),
    "classifier_choices": study(CHOICES),
    "parquet_first_schema": f"""WITH {INCIDENTS} SELECT "ID", "Start_Time", "Description", "Temperature_F" FROM incidents
        UNION ALL SELECT "ID", "Start_Time", NULL, NULL FROM drifted""",
    "storage_inventory": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows, CAST(1 AS BIGINT) AS files, TRUE AS sized FROM {name}"
        for name in ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
    ),
    "format_sizes": """SELECT 'csv' AS format, count(*) AS rows, FALSE AS smaller FROM orders
        UNION ALL SELECT 'parquet', count(*), TRUE FROM orders""",
    "csv_text_round_trip": r"""WITH t AS (
        SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' ELSE concat('  "q" \ %0A|', text, chr(13), chr(10), ' ') END AS text
        FROM documents)
        SELECT doc_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS characters,
          TIMESTAMP '2024-03-01' + to_microseconds(doc_id * 1000003) AS moment FROM t""",
    "repeated_hour": f"""WITH {SENSORS.split("hourly AS")[0]}
        folded AS (SELECT TIMESTAMP '2024-10-26' + to_milliseconds(epoch_ms(ts) % 172800000) AS utc, solar, temperature FROM readings),
        hours AS (SELECT date_trunc('hour', utc) AS hour, avg(solar) / 1000 AS produced, avg(temperature) AS temperature FROM folded GROUP BY 1)
        SELECT hour + CASE WHEN hour < TIMESTAMP '2024-10-27 01:00:00' THEN INTERVAL 3 HOUR ELSE INTERVAL 2 HOUR END AS "Time",
          round(produced, 6) AS "ProducedEnergy", round(temperature, 6) AS "AvgTemperature" FROM hours""",
    "hourly_rollup": f"""WITH {SENSORS.format(shift=2)} SELECT hour AS "Time", round(temperature, 6) AS "AvgTemperature",
        round(produced, 6) AS "ProducedEnergy", round(consumed, 6) AS "ConsumedEnergy", round(price, 6) AS "Price" FROM hourly""",
    "daily_rollup": f"WITH {SENSORS.format(shift=2)} SELECT * FROM daily",
    "weekly_cost": f'WITH {SENSORS.format(shift=3)} SELECT round(sum("DailyCost"), 2) AS "TotalPrice" FROM daily',
    "local_hours": "SELECT event_id, date_trunc('hour', ts + INTERVAL 2 HOUR) AS hour FROM events",
    "epoch_month_hour": """SELECT CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS count
        FROM events GROUP BY 1, 2""",
    "best_days": BEST_DAYS,
    "daily_sales_stream": f"WITH {DAILY_SALES} SELECT * FROM daily",
    "best_days_stream": BEST_DAYS,
    "best_publisher": f"WITH {GAMES} SELECT publisher, round(s, 2) AS regional_total FROM best",
    "missing_titles": f"WITH {GAMES} SELECT count(*) AS titles FROM games JOIN best USING (publisher) WHERE na IS NULL",
    "top_group_then_filter": f"""WITH {GAMES} SELECT CAST(y AS INTEGER) AS year, round(sum(na), 2) AS na_total,
        round(sum(total), 2) AS global_total FROM games JOIN best USING (publisher) GROUP BY 1""",
    "line_total": f"WITH {LINES} SELECT count(*) AS lines FROM lines WHERE length(line) > 0",
    "line_starts": f"""WITH {LINES} SELECT substr(line, 1, 60) AS start FROM lines WHERE length(line) > 0
        ORDER BY line LIMIT 8""",
    "word_total": f"WITH {LINES} SELECT count(*) AS words FROM words",
    "word_distinct": f"WITH {LINES} SELECT count(DISTINCT word) AS distinct_words FROM words",
    "word_counts": f"WITH {LINES} SELECT word, count(*) AS count FROM words GROUP BY 1",
    "word_counts_typed": f"WITH {LINES} SELECT word, count(*) AS count FROM words GROUP BY 1",
    "top_word_len7_s": f"""WITH {LINES} SELECT word, count(*) AS count FROM words
        WHERE length(word) = 7 AND word LIKE 's%' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "text_line_scan": f"""WITH {LINES} SELECT count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS characters
        FROM lines WHERE length(line) > 0""",
    "match_results": f"WITH {FOOTBALL} SELECT * FROM results",
    "season_standings": f"WITH {FOOTBALL} SELECT * FROM standings",
    "league_tables": f"WITH {FOOTBALL} SELECT * FROM placed",
    "league_table": f"""WITH {FOOTBALL} SELECT "Pos", "Team", "Pld", "W", "D", "L", "GF", "GA", "GD", "Pts" FROM placed
        WHERE competition = 'League2' AND season = '{SEASON}'""",
    "signed_diff": f'WITH {FOOTBALL} SELECT season, "Team" AS team, "GD" AS difference FROM placed',
    "team_passes": f"WITH {FOOTBALL} SELECT * FROM passes",
    "worst_passers": f"""WITH {FOOTBALL} SELECT competition, team, ratio AS "passSuccessRatio" FROM ratios
        QUALIFY rank() OVER (PARTITION BY competition ORDER BY ratio) = 1""",
    "best_two": f"""WITH {FOOTBALL}, averages AS (
        SELECT *, points / CAST(games AS DOUBLE) AS av FROM standings WHERE season = '{SEASON}'),
        top AS (SELECT *, CAST(rank() OVER (PARTITION BY competition ORDER BY av DESC) AS INTEGER) AS "Pos" FROM averages
                QUALIFY "Pos" <= 2)
        SELECT p."Team", competition AS "League", top."Pos", p."Pld", p."W", p."D", p."L", p."GF", p."GA", p."GD", p."Pts",
               round(av, 2) AS "Avg", ratio AS "PassRatio"
        FROM top JOIN placed p USING (competition, season) JOIN ratios r USING (competition)
        WHERE p."Team" = top.team AND r.team = top.team""",
    "match_length": f'WITH {FOOTBALL} SELECT "matchId", len AS "matchLength" FROM lengths',
    "player_intervals": f"WITH {FOOTBALL} SELECT * FROM timed",
    "player_minutes": f'WITH {FOOTBALL} SELECT "playerId", CAST(sum(minutes) AS BIGINT) AS minutes FROM timed GROUP BY 1',
    "most_minutes_per_role": f"""WITH {FOOTBALL}, sums AS (
        SELECT "playerId", CAST(sum(minutes) AS BIGINT) AS minutes FROM timed GROUP BY 1)
        SELECT role, player, "birthArea", minutes FROM sums JOIN players USING ("playerId")
        QUALIFY rank() OVER (PARTITION BY role ORDER BY minutes DESC) = 1""",
    "plus_minus": f"WITH {FOOTBALL} SELECT * FROM totals",
    "plus_minus_top": f"""WITH {FOOTBALL} SELECT player, "birthArea", role, "plusMinus" FROM totals
        JOIN players USING ("playerId") WHERE "plusMinus" > 20""",
    "pixel_color_name": f"WITH {PIXELS} SELECT pixel, color, count(*) AS count FROM named GROUP BY 1, 2",
    "color_shares": f"""WITH {PIXELS} SELECT image, color, n AS count,
        round(n / CAST(sum(n) OVER (PARTITION BY image) AS DOUBLE) * 100, 2) AS share FROM counts""",
    "top_three_colors": f'WITH {PIXELS} SELECT image, colors AS "leading" FROM firsts',
    "leading_color_images": f"WITH {PIXELS} SELECT count(*) FILTER (colors = 'Green-Blue-Purple') AS images FROM firsts",
    "red_count_top": f"""WITH {PIXELS} SELECT image, count(*) FILTER (color = 'Red') AS pixels FROM named GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 5""",
    "image_histogram": f"WITH {PAGES} SELECT hexcode, total_pixels, colored, red, blue, gray FROM hist",
    "image_pixels_by_columns": f"""WITH {PAGES} SELECT page_id, CAST(total_pixels AS INTEGER) AS total,
        CAST(colored AS INTEGER) AS colored FROM hist""",
    "image_most_colored": f"""WITH {PAGES} SELECT annotation, colored FROM hist JOIN meta USING (page_id)
        ORDER BY colored DESC, annotation LIMIT 4""",
    "image_least_colored": f"""WITH {PAGES} SELECT annotation, round(CAST(colored AS DOUBLE) / total_pixels, 6) AS ratio
        FROM hist JOIN meta USING (page_id) ORDER BY CAST(colored AS DOUBLE) / total_pixels, annotation LIMIT 5""",
    "image_leading_shares": f"""WITH {PAGES}, counts AS (
        SELECT page_id, color, count(*) AS n FROM named WHERE color <> 'None' GROUP BY 1, 2)
        SELECT upper(to_hex(page_id)) AS hexcode,
               CAST(row_number() OVER (PARTITION BY page_id ORDER BY n DESC, color) AS INTEGER) AS place, color, n AS count,
               round(n / CAST(sum(n) OVER (PARTITION BY page_id) AS DOUBLE) * 100, 2) AS share
        FROM counts JOIN meta USING (page_id) QUALIFY place <= 3""",
    "image_most_red_in_group": f"""WITH {PAGES} SELECT annotation, red AS pixels FROM hist JOIN meta USING (page_id)
        WHERE grp LIKE '%activities%' ORDER BY red DESC, annotation LIMIT 5""",
    "rekey_latest": f"WITH {INCIDENTS} SELECT * FROM latest",
    "modified_schema": f"WITH {INCIDENTS} SELECT * FROM drifted",
    "evolve_append": f"WITH {INCIDENTS} SELECT * FROM evolved",
    "parquet_merge_schema": f"""WITH {INCIDENTS} SELECT "ID", "Start_Time", "Description", "Temperature_F", "Temperature_C",
        "AddedColumn1" FROM evolved
        UNION ALL SELECT "ID", "Start_Time", "Description", "Temperature_F", NULL, NULL FROM latest""",
    "csv_drift": f"WITH {INCIDENTS} SELECT * FROM evolved",
    "csv_safe_append": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "csv_inferred_scan": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "parquet_round_trip": "SELECT * FROM customer",
    "json_lines_scan": "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS count FROM events GROUP BY 1",
    "sql_view_scan": "SELECT * FROM nation",
    "bag_union": """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')
        UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""",
    "merge_upsert": f"""WITH {UPSERT}
        SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey,
               coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, c_mktsegment
        FROM customer t FULL OUTER JOIN changes s USING (c_custkey)""",
    "update_where": """SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_acctbal > 0 THEN round((c_acctbal - 32) * 5 / 9, 3) ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_acctbal > 0 THEN c_mktsegment || '*' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "update_everywhere": """SELECT c_custkey, c_name, c_nationkey, round(c_acctbal / 2, 3) AS c_acctbal, c_mktsegment
        FROM customer""",
    "sorted_days_stream": f"""WITH {DAILY_SALES} SELECT "orderDate", "totalSales",
        CAST(row_number() OVER (ORDER BY "totalSales" DESC, "orderDate") AS INTEGER) AS place FROM daily""",
    "hex_numbers": "SELECT p_partkey, upper(to_hex(p_partkey)) AS digits, CAST(p_partkey AS INTEGER) AS number FROM part",
    "named_priorities": """SELECT o_orderpriority, name, count(*) AS orders FROM orders
        JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('3-MEDIUM', 'later')) AS v(priority, name)
        ON o_orderpriority = priority GROUP BY 1, 2""",
    "delete_where": """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS c_acctbal,
        c_mktsegment FROM customer WHERE c_nationkey = 3 OR c_acctbal >= 1000""",
    "latest_per_key": """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "linreg_fit": """SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""",
    "linreg_by_groups": """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, count(*) AS points FROM lineitem GROUP BY 1""",
    "linreg_score": f"""WITH {POINTS} SELECT l_orderkey, l_linenumber, x AS "X", round(s * x + i, 2) AS prediction,
        round(y - (s * x + i), 2) AS error FROM points, line WHERE NOT train""",
    "linreg_rmse": f"""WITH {POINTS} SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part,
        round(sqrt(avg(pow(y - (s * x + i), 2))), 2) AS rmse FROM points, line GROUP BY 1""",
    "hash_split": """SELECT CASE WHEN CAST('0x' || substr(md5(o_orderkey || '|1'), 1, 8) AS BIGINT) % 10000 < 8300
        THEN 'train' ELSE 'test' END AS part, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
        FROM orders GROUP BY 1""",
    "cyclic_eval": f"""WITH {CYCLIC} SELECT "case", count(*) AS predictions,
        round(avg(CASE WHEN d <= 0 THEN 100.0::DOUBLE ELSE 0 END), 4) AS within_0,
        round(avg(CASE WHEN d <= 1 THEN 100.0::DOUBLE ELSE 0 END), 4) AS within_1,
        round(avg(CASE WHEN d <= 2 THEN 100.0::DOUBLE ELSE 0 END), 4) AS within_2,
        round(avg(CASE WHEN d = 0 THEN 0.5::DOUBLE ELSE 0.5 / (n - 1) END), 4) AS mean_probability FROM away GROUP BY 1""",
}
