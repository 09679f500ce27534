"""Plain SQL (DuckDB dialect) for every oracle-checked query.

Each statement starts from the ``events`` view, renders the same lines as
``acctlens.sources.events``, parses them with string functions and computes
the result independently of the Spark operators (window membership by epoch
arithmetic, the as-of lookup by ``ASOF JOIN``, label ranking by
``row_number``).
"""

from __future__ import annotations

from types import SimpleNamespace

US = 1_000_000
HOUR = 3600

# Written down here on purpose, not taken from the engine: cadences of the
# test tables, the accepted date form and the rules of the line adapter.
CFG = SimpleNamespace(bras_agg1_seconds=6 * HOUR, bras_std_dev_anomaly=2, outlier_sigmas=2, alive_watermark_seconds=12960,
                      agg_watermark_seconds=21600, stop_watermark_seconds=14400)
ev = SimpleNamespace(N_SERVERS=10, N_CAUSES=5, BAD_SESSION_TIME_EVERY=97, DECIMAL_OCTETS_EVERY=53, TRUNCATED_LINE_EVERY=211,
                     DATE_ONLY_EVERY=223, STATUS_BY_EVENT={"view": "Alive", "click": "Alive", "error": "Stop",
                                                           "purchase": "Stop", "signup": "Start"})
S1, S2, SC = 6 * HOUR * US, 36 * HOUR * US, 24 * HOUR * US
N = 12
LOOKBACK_US = 180 * HOUR * US

_TIME_RE = r"\d{4}[-/]\d{1,2}[-/]\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?"


def safe_long(x: str, t: str = "BIGINT") -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN COALESCE(TRY_CAST({x} AS {t}), 0) ELSE 0 END)"


_status = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ev.STATUS_BY_EVENT.items())

LINES = f"""
ev AS (
  SELECT event_id, ts, user_id,
         CASE event_type {_status} ELSE event_type END AS status,
         COALESCE(TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT), 0) AS k
  FROM events),
flds AS (
  SELECT event_id, ts, [
    strftime(ts, '%Y/%m/%d %H:%M:%S'),
    CAST(epoch_us(ts) // 1000000 AS VARCHAR),
    status,
    'S' || event_id,
    CASE WHEN event_id % {ev.BAD_SESSION_TIME_EVERY} = 0 THEN 'bad' ELSE CAST((event_id * 7) % 3600 AS VARCHAR) END,
    CASE WHEN event_id % {ev.DECIMAL_OCTETS_EVERY} = 0 THEN CAST(event_id % 100000 AS VARCHAR) || '.5'
         ELSE CAST(event_id % 100000 AS VARCHAR) END,
    CAST(event_id % 4 AS VARCHAR),
    CAST((event_id * 3) % 100000 AS VARCHAR),
    CAST(event_id % 2 AS VARCHAR),
    CAST(event_id % 1000 AS VARCHAR),
    CAST(event_id % 500 AS VARCHAR),
    'bras' || (user_id % {ev.N_SERVERS}),
    '10.0.0.' || (user_id % {ev.N_SERVERS}),
    CAST(user_id % 48 AS VARCHAR),
    'C' || user_id,
    CAST(user_id % 3 AS VARCHAR),
    'user' || user_id,
    CASE WHEN event_id % 3 = 0 THEN 'NODE' || (user_id % 5) || ' atm 0/1' ELSE 'nospace' END,
    CASE WHEN event_id % 3 = 1 THEN 'OLT' || (user_id % 5) || ' xpon 0/2' ELSE '' END,
    'rem',
    '100.64.0.' || (user_id % 250),
    'conn',
    CASE WHEN status = 'Stop' THEN 'cause' || (k % {ev.N_CAUSES}) ELSE '' END,
    '0', '0', '0', '',
    'mac' || user_id
  ] AS f
  FROM ev),
lines AS (
  SELECT event_id,
         CASE WHEN event_id % {ev.TRUNCATED_LINE_EVERY} = 0 THEN array_to_string(f[1:5], ',')
              WHEN event_id % {ev.DATE_ONLY_EVERY} = 0 THEN strftime(ts, '%Y/%m/%d') || ',' || array_to_string(f[2:], ',')
              ELSE array_to_string(f, ',') END AS value
  FROM flds)"""

SPLIT = """
sp AS (SELECT event_id, value, string_split(value, ',') AS f FROM lines),
acc AS (
  SELECT *, (len(f) >= 28 AND regexp_full_match(f[1], '%s')
             AND TRY_CAST(replace(f[1], '/', '-') AS TIMESTAMP) IS NOT NULL) AS ok
  FROM sp)""" % _TIME_RE


def _cols22() -> list[str]:
    sl = safe_long
    return [
        "CAST(replace(f[1], '/', '-') AS TIMESTAMP) AS date", f"{sl('f[2]')} AS timestamp",
        "f[3] AS acctStatusType", "f[4] AS acctSessionId", f"{sl('f[5]')} AS sessionTime",
        f"{sl('f[6]')} AS outputOctets", f"{sl('f[7]')} AS outputGigawords", f"{sl('f[8]')} AS inputOctets",
        f"{sl('f[9]')} AS inputGigawords", "f[12] AS nasIdentifier", "f[13] AS nasIpAddress",
        f"{sl('f[14]')} AS nasPort", "f[15] AS clientId", "f[16] AS accessType", "f[17] AS userName",
        "f[18] AS callingStationId", "f[19] AS circuitId", "f[20] AS remoteId", "f[21] AS framedIPAddress",
        "f[22] AS connectInfo", "f[23] AS terminateCause", "f[28] AS mac",
    ]


ADSL = "nullif(regexp_extract(f[18], '^(.+) .+$', 1), '')"
FIBER = r"nullif(regexp_extract(f[19], '^(.+?)\s.+$', 1), '')"
ACCESS_NODE = f"COALESCE({ADSL}, {FIBER}, '<NONE>')"
DAY = "substr(f[1], instr(f[1], ' '))"

CDR24 = ",\n  ".join(_cols22() + [f"{ACCESS_NODE} AS accessNode", f"{DAY} AS day"])


def _cols28() -> list[str]:
    c = _cols22()
    sl = safe_long
    out = c[:9] + [f"{sl('f[10]')} AS outputPackets", f"{sl('f[11]')} AS inputPackets"] + c[9:13]
    out += [f"{sl('f[16]', 'INTEGER')} AS accessType"] + c[14:21]
    out += [f"{sl('f[24]', 'INTEGER')} AS natStartPort", f"{sl('f[25]', 'INTEGER')} AS natEndPort",
            f"{sl('f[26]', 'INTEGER')} AS delayTime", "f[27] AS natIPAddress", "f[28] AS mac"]
    return out


CDR = f"""
cdr AS (SELECT event_id, f,
  {CDR24}
  FROM acc WHERE ok)"""

BASE = "WITH " + LINES + "," + SPLIT + "," + CDR


def with_ctes(*ctes: str) -> str:
    return BASE + "".join("," + c for c in ctes)


def win_end(col: str, slide_us: int, j: str = "j") -> str:
    return f"make_timestamp(((epoch_us({col}) // {slide_us}) + {j}) * {slide_us})"


ALIVE = f"""
alive AS (
  SELECT 'agg1_cdr_alive_bras' AS aggName, {win_end('date', S1)} AS timestamp,
         count(nasIpAddress) AS value, nasIpAddress AS aggField1
  FROM cdr, (VALUES (1), (2)) w(j) WHERE acctStatusType = 'Alive' GROUP BY 2, 4)"""

STOPS = f"""
stops AS (
  SELECT 'agg1_cdr_stop_bras_termCause' AS aggName, {win_end('date', SC)} AS timestamp,
         count(*) AS value, nasIpAddress AS aggField1, terminateCause AS aggField2
  FROM cdr, (VALUES (1), (2)) w(j) WHERE acctStatusType = 'Stop' GROUP BY 2, 4, 5)"""

STATS_RAW = f"""
s2 AS (
  SELECT {win_end('timestamp', S2)} AS timestamp, aggField1, count(value) AS n,
         CAST(sum(value) AS BIGINT) AS s, CAST(sum(value * value) AS BIGINT) AS q
  FROM alive, (VALUES (1), (2)) w(j) GROUP BY 1, 2)"""

STATS = f"""
stats AS (
  SELECT 'agg2_cdr_alive_bras' AS aggName, timestamp, aggField1, CAST(s // {N} AS DOUBLE) AS mean,
         sqrt(CAST((q - 2 * (s // {N}) * s + (s // {N}) * (s // {N}) * greatest(n, {N})) // {N} AS DOUBLE)) AS stdDev,
         CAST(n AS INTEGER) AS samples
  FROM s2)"""

LATEST = f"""
latest AS (
  SELECT c.aggName, c.timestamp, c.aggField1, c.value,
         CASE WHEN epoch_us(s.timestamp) > epoch_us(c.timestamp) - {LOOKBACK_US} THEN s.timestamp END AS statsTimestamp,
         CASE WHEN epoch_us(s.timestamp) > epoch_us(c.timestamp) - {LOOKBACK_US} THEN s.mean END AS mean,
         CASE WHEN epoch_us(s.timestamp) > epoch_us(c.timestamp) - {LOOKBACK_US} THEN s.stdDev END AS stdDev
  FROM alive c ASOF LEFT JOIN stats s ON c.aggField1 = s.aggField1 AND c.timestamp >= s.timestamp)"""


def _ts_string(col: str) -> str:
    """java.sql.Timestamp.toString of a whole-second or sub-second value."""
    frac = (f"CASE WHEN epoch_us({col}) % 1000000 = 0 THEN '0' "
            f"ELSE rtrim(lpad(CAST(epoch_us({col}) % 1000000 AS VARCHAR), 6, '0'), '0') END")
    return f"(strftime({col}, '%Y-%m-%d %H:%M:%S') || '.' || {frac})"


SQL: dict[str, str] = {}

SQL["parse_cdr"] = BASE + f"\nSELECT * EXCLUDE (event_id, f) FROM cdr"
SQL["parse_cdr_full"] = BASE + "\nSELECT\n  " + ",\n  ".join(_cols28()) + "\nFROM acc WHERE ok"
SQL["cdr_tuple22"] = BASE + "\nSELECT\n  " + ",\n  ".join(_cols22()) + "\nFROM acc WHERE ok"
SQL["quarantine"] = BASE + """
SELECT value, CAST(len(f) AS INTEGER) AS n_fields,
       CASE WHEN len(f) < 28 THEN 'too_few_fields' ELSE 'bad_date' END AS reason
FROM acc WHERE NOT ok"""
SQL["access_node"] = BASE + f"""
SELECT acctSessionId, callingStationId, circuitId, {ADSL} AS adslNode, {FIBER} AS fiberNode, accessNode
FROM cdr"""
SQL["alive_count"] = with_ctes(ALIVE) + "\nSELECT * FROM alive"
SQL["stop_cause_count"] = with_ctes(STOPS) + "\nSELECT * FROM stops"
SQL["first_order_3"] = BASE + f"""
SELECT 'agg1_cdr_bras_node_status' AS aggName, {win_end('date', S1)} AS timestamp, count(*) AS value,
       nasIpAddress AS aggField1, accessNode AS aggField2, acctStatusType AS aggField3
FROM cdr, (VALUES (1), (2)) w(j) GROUP BY 2, 4, 5, 6"""
SQL["first_order_4"] = BASE + f"""
SELECT 'agg1_cdr_stop_bras_node_type_cause' AS aggName, {win_end('date', SC)} AS timestamp, count(*) AS value,
       nasIpAddress AS aggField1, accessNode AS aggField2, accessType AS aggField3, terminateCause AS aggField4
FROM cdr, (VALUES (1), (2)) w(j) WHERE acctStatusType = 'Stop' GROUP BY 2, 4, 5, 6, 7"""
SQL["agg_lines"] = with_ctes(ALIVE) + f"""
SELECT {_ts_string('timestamp')} || '-' || aggField1 AS key,
       aggName || ',' || {_ts_string('timestamp')} || ',' || aggField1 || ',' || CAST(value AS VARCHAR) AS value
FROM alive"""
SQL["agg_line_roundtrip"] = with_ctes(ALIVE) + "\nSELECT aggName, timestamp, value, aggField1 FROM alive"
SQL["second_order_values"] = with_ctes(ALIVE) + f""",
v AS (
  SELECT {win_end('timestamp', S2)} AS timestamp, aggField1, list_sort(list(value)) AS vals
  FROM alive, (VALUES (1), (2)) w(j) GROUP BY 1, 2)
SELECT timestamp, aggField1, array_to_string(vals, ',') AS values,
       array_to_string(list_concat(vals, list_transform(range(greatest({N} - len(vals), 0)), lambda x: 0)), ',') AS filledValues,
       CAST(len(vals) AS INTEGER) AS samples, {N} AS sampleSize
FROM v"""
SQL["second_order_stats"] = with_ctes(ALIVE, STATS_RAW, STATS) + "\nSELECT * FROM stats"
SQL["second_order_list_stats"] = SQL["second_order_stats"]
SQL["second_order_exact"] = with_ctes(ALIVE) + f""",
v AS (SELECT {win_end('timestamp', S2)} AS timestamp, aggField1, list(value) AS vals
      FROM alive, (VALUES (1), (2)) w(j) GROUP BY 1, 2),
p AS (SELECT timestamp, aggField1, len(vals) AS n, list_sum(vals) / {N}.0 AS mean,
             list_concat(vals, [0 FOR x IN range(greatest({N} - len(vals), 0))]) AS padded FROM v)
SELECT 'agg2_cdr_alive_bras' AS aggName, timestamp, aggField1, round(mean::double, 9) AS mean,
       round(sqrt(list_sum([(x - mean::double) * (x - mean::double) FOR x IN padded]) / {N}.0), 9) AS stdDev,
       CAST(n AS INTEGER) AS samples
FROM p"""
SQL["latest_stats"] = with_ctes(ALIVE, STATS_RAW, STATS, LATEST) + "\nSELECT * FROM latest"
SQL["alive_anomalies"] = with_ctes(ALIVE, STATS_RAW, STATS, LATEST) + f"""
SELECT * FROM latest WHERE statsTimestamp IS NOT NULL AND (mean - value) > {float(CFG.bras_std_dev_anomaly)} * stdDev"""
SQL["index_docs_1"] = with_ctes(ALIVE) + """
SELECT value, epoch_us(timestamp) // 1000 AS timestamp, aggName, aggField1, aggField1 AS nasIpAddress FROM alive"""
SQL["index_docs_2"] = with_ctes(ALIVE, STATS_RAW, STATS) + """
SELECT mean, stdDev, epoch_us(timestamp) // 1000 AS timestamp, aggName, aggField1, aggField1 AS nasIpAddress FROM stats"""


def _ratio(keys: str) -> str:
    return f"""
ratio AS (
  SELECT *, value / sumPerBras AS ratioInBras FROM (
    SELECT *, CAST(sum(value) OVER (PARTITION BY {keys}) AS BIGINT) AS sumPerBras FROM stops))"""


LABELS = """
labels AS (
  SELECT aggField2 AS cause, count(*) AS labelCount,
         CAST(row_number() OVER (ORDER BY count(*) DESC, aggField2) - 1 AS DOUBLE) AS causeIndex
  FROM stops GROUP BY aggField2)"""


def _mix(keys: list[str], digits: bool = True) -> str:
    k = ", ".join(keys)
    kk = ", ".join(f"k.{c}" for c in keys)
    on = " AND ".join(f"r.{c} = k.{c}" for c in keys)
    val = "round(COALESCE(sum(r.ratioInBras), 0.0), 9)" if digits else "COALESCE(sum(r.ratioInBras), 0.0)"
    return f"""
keys AS (SELECT {k}, min(sumPerBras) AS minSumPerBras FROM ratio GROUP BY {k}),
mix AS (
  SELECT {kk}, CAST(l.causeIndex AS INTEGER) AS causeIndex, l.cause, {val} AS ratioSum, k.minSumPerBras
  FROM keys k CROSS JOIN labels l
  LEFT JOIN ratio r ON {on} AND r.aggField2 = l.cause
  GROUP BY {kk}, l.causeIndex, l.cause, k.minSumPerBras)"""


WKEYS = ["aggField1", "timestamp"]
RATIO_W = _ratio("aggField1, timestamp")
RATIO_B = _ratio("aggField1")

DIST = """
centre AS (SELECT causeIndex, avg(ratioSum) AS c FROM rawmix GROUP BY causeIndex),
dist AS (
  SELECT m.aggField1, m.timestamp, sum((m.ratioSum - c.c) * (m.ratioSum - c.c)) AS distanceFromCenter
  FROM rawmix m JOIN centre c ON m.causeIndex = c.causeIndex GROUP BY m.aggField1, m.timestamp)"""
RAWMIX = _mix(WKEYS, digits=False).replace("mix AS (", "rawmix AS (")

SQL["cause_ratio"] = with_ctes(STOPS, RATIO_W) + "\nSELECT * FROM ratio"
SQL["cause_ratio_batch"] = with_ctes(STOPS, RATIO_B) + "\nSELECT * FROM ratio"
SQL["cause_index"] = with_ctes(STOPS, LABELS) + "\nSELECT * FROM labels"
SQL["cause_mix"] = with_ctes(STOPS, RATIO_W, LABELS, _mix(WKEYS)) + "\nSELECT * FROM mix"
SQL["cause_mix_batch"] = with_ctes(STOPS, RATIO_B, LABELS, _mix(["aggField1"])) + "\nSELECT * FROM mix"
SQL["cause_mix_top30"] = with_ctes(STOPS, RATIO_W, LABELS, _mix(WKEYS)) + """,
top AS (SELECT DISTINCT aggField1, timestamp FROM mix ORDER BY aggField1, timestamp LIMIT 30)
SELECT m.* FROM mix m JOIN top t ON m.aggField1 = t.aggField1 AND m.timestamp = t.timestamp"""
SQL["centre_distance"] = with_ctes(STOPS, RATIO_W, LABELS, RAWMIX, DIST) + """
SELECT aggField1, timestamp, round(distanceFromCenter, 9) AS distanceFromCenter FROM dist"""
SQL["distance_summary"] = with_ctes(STOPS, RATIO_W, LABELS, RAWMIX, DIST) + """
SELECT count(distanceFromCenter) AS count, round(avg(distanceFromCenter), 9) AS mean,
       round(stddev_samp(distanceFromCenter), 9) AS stddev, round(min(distanceFromCenter), 9) AS min,
       round(max(distanceFromCenter), 9) AS max
FROM dist"""
SQL["sigma_outliers"] = with_ctes(STOPS, RATIO_W, LABELS, RAWMIX, DIST) + f"""
SELECT aggField1, timestamp, round(distanceFromCenter, 9) AS distanceFromCenter FROM dist
WHERE distanceFromCenter > (SELECT avg(distanceFromCenter) + {float(CFG.outlier_sigmas)} * stddev_samp(distanceFromCenter) FROM dist)"""

REPLAY_START_US = 1704240000 * US          # 2024-01-03 00:00:00
MINUTES_FROM_US = 1704067200 * US          # 2024-01-01 00:00:00
REPLAY_REAL_US = 1767225600 * US           # 2026-01-01 00:00:00
REPLAY_FACTOR = 10

REBASED = f"""
due AS (
  SELECT f, CASE WHEN t < {REPLAY_START_US} THEN {REPLAY_REAL_US}
                 ELSE {REPLAY_REAL_US} + (t - {REPLAY_START_US}) // {REPLAY_FACTOR} END AS us
  FROM (SELECT f, epoch_us(TRY_CAST(replace(f[1], '/', '-') AS TIMESTAMP)) AS t
        FROM acc WHERE regexp_full_match(f[1], '{_TIME_RE}') AND len(f) > 12)
  WHERE t IS NOT NULL),
rebased AS (
  SELECT f, make_timestamp(us) AS releaseTime,
         strftime(make_timestamp(us), '%Y/%m/%d %H:%M:%S') || ',' || array_to_string(f[2:], ',') AS value
  FROM due)"""

SQL["replay_quarantine"] = BASE + f"""
SELECT value, CAST(len(f) AS INTEGER) AS n_fields,
       CASE WHEN len(f) <= 12 THEN 'too_few_fields' ELSE 'bad_date' END AS reason
FROM acc WHERE len(f) <= 12 OR NOT regexp_full_match(f[1], '{_TIME_RE}')
   OR TRY_CAST(replace(f[1], '/', '-') AS TIMESTAMP) IS NULL"""
SQL["replay_rebase"] = with_ctes(REBASED) + "\nSELECT releaseTime, value FROM rebased"
SQL["replay_publish"] = with_ctes(REBASED) + """
SELECT f[13] || '-' || f[4] || '-' || f[5] AS key, value, releaseTime FROM rebased"""

# a minute is read if none of the leaf's gaps before it, the one after the start included, is too long
SQL["minute_files"] = with_ctes() + f""",
mf AS (
  SELECT COALESCE(nullif(f[12], ''), 'unassigned') AS leaf,
         date_trunc('minute', CAST(replace(f[1], '/', '-') AS TIMESTAMP)) AS minute, value
  FROM acc
  WHERE regexp_full_match(f[1], '{_TIME_RE}') AND TRY_CAST(replace(f[1], '/', '-') AS TIMESTAMP) IS NOT NULL),
live AS (SELECT * FROM mf WHERE epoch_us(minute) >= {MINUTES_FROM_US}),
gaps AS (
  SELECT leaf, minute,
         (epoch_us(minute) - COALESCE(lag(epoch_us(minute)) OVER (PARTITION BY leaf ORDER BY minute),
                                      {MINUTES_FROM_US} - 60000000)) // 60000000 - 1 AS missing
  FROM (SELECT DISTINCT leaf, minute FROM live)),
ok AS (SELECT leaf, minute, max(missing) OVER (PARTITION BY leaf ORDER BY minute) AS longest FROM gaps)
SELECT l.leaf, l.minute, l.value FROM live l JOIN ok ON l.leaf = ok.leaf AND l.minute = ok.minute
WHERE ok.longest <= 240"""

WM_ALIVE = f"(SELECT max(date) FROM cdr) - INTERVAL {CFG.alive_watermark_seconds} SECOND"
WM_STOP = f"(SELECT max(date) FROM cdr) - INTERVAL {CFG.stop_watermark_seconds} SECOND"
SQL["stream_alive_count"] = with_ctes(ALIVE) + f"\nSELECT * FROM alive WHERE timestamp <= {WM_ALIVE}"
SQL["stream_restart"] = with_ctes(ALIVE) + f"\nSELECT aggName, timestamp, aggField1, value FROM alive WHERE timestamp <= {WM_ALIVE}"
# a record's batch is its span of six days, or two spans later for every seventh; the watermark of a batch is
# 12,960 s before the newest record of earlier ones
SQL["stream_late_rows"] = with_ctes() + f""",
a AS (SELECT date, acctSessionId, acctStatusType, nasIpAddress,
             least(greatest(date_diff('day', DATE '2024-01-01', CAST(date AS DATE)) // 6, 0)
                   + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END, 5) AS batch FROM cdr),
marks AS (SELECT b.batch, (SELECT max(date) FROM a WHERE a.batch < b.batch) - INTERVAL {CFG.alive_watermark_seconds} SECOND AS watermark
          FROM (SELECT DISTINCT batch FROM a) b),
judged AS (SELECT a.*, watermark, COALESCE((epoch_us(date) // {S1} + 1) * {S1} <= epoch_us(watermark), false) AS late
           FROM a JOIN marks USING (batch))
SELECT date, acctSessionId, acctStatusType, nasIpAddress, CASE WHEN late THEN watermark END AS watermark, late FROM judged"""
SQL["stream_minute_files"] = SQL["minute_files"]
SQL["stream_stop_cause"] = with_ctes(STOPS) + f"\nSELECT * FROM stops WHERE timestamp <= {WM_STOP}"
SQL["stream_second_order"] = with_ctes(ALIVE, STATS_RAW, STATS) + f"\nSELECT * FROM stats WHERE timestamp <= {WM_ALIVE}"
_CLOSED_STOPS = STOPS.replace("stops AS (", "stops_all AS (") + f""",
stops AS (SELECT * FROM stops_all WHERE timestamp <= {WM_STOP})"""
SQL["stream_bad_sessions"] = with_ctes(_CLOSED_STOPS, RATIO_B, LABELS, _mix(["aggField1"])) + "\nSELECT * FROM mix"
_CLOSED_ALIVE = ALIVE.replace("alive AS (", "alive_all AS (") + f""",
alive AS (SELECT * FROM alive_all WHERE timestamp <= {WM_ALIVE})"""
SQL["stream_alive_anomalies"] = with_ctes(_CLOSED_ALIVE, STATS_RAW, STATS, LATEST) + f"""
SELECT aggName, timestamp, aggField1, value, statsTimestamp, mean, stdDev FROM latest
WHERE statsTimestamp IS NOT NULL AND (mean - value) > {float(CFG.bras_std_dev_anomaly)} * stdDev"""

FILLED = f"""
calendar AS (
  SELECT unnest(generate_series((SELECT min(timestamp) FROM alive), (SELECT max(timestamp) FROM alive),
                                INTERVAL {CFG.bras_agg1_seconds} SECOND)) AS timestamp),
filled AS (
  SELECT k.aggName, t.timestamp, k.aggField1,
         COALESCE((SELECT a.value FROM alive a WHERE a.aggField1 = k.aggField1 AND a.timestamp = t.timestamp), 0) AS value
  FROM calendar t, (SELECT DISTINCT aggName, aggField1 FROM alive) k)"""
SQL["alive_count_filled"] = with_ctes(ALIVE, FILLED) + "\nSELECT aggName, timestamp, value, aggField1 FROM filled"
SQL["alive_anomalies_filled"] = with_ctes(ALIVE, STATS_RAW, STATS, FILLED, LATEST.replace("FROM alive c", "FROM filled c")) + f"""
SELECT * FROM latest WHERE statsTimestamp IS NOT NULL AND (mean - value) > {float(CFG.bras_std_dev_anomaly)} * stdDev"""
SQL["stream_second_order_batches"] = SQL["stream_second_order"]
# a server whose lines name another from a time on; zeros from its first window to the last that is closed
_FAILOVER = CDR.replace("cdr AS (", "cdr_all AS (") + """,
cdr AS (SELECT * REPLACE (CASE WHEN nasIpAddress = '10.0.0.3' AND date >= TIMESTAMP '2024-01-16 00:00:00' THEN '10.0.0.4'
                               ELSE nasIpAddress END AS nasIpAddress) FROM cdr_all)"""
_LIVE_FILLED = f"""
closing AS (SELECT {WM_ALIVE} AS wm),
seen AS (SELECT aggName, aggField1, min(timestamp) AS since FROM alive GROUP BY 1, 2),
filled AS (
  SELECT k.aggName, t.timestamp, k.aggField1,
         COALESCE((SELECT a.value FROM alive a WHERE a.aggField1 = k.aggField1 AND a.timestamp = t.timestamp), 0) AS value
  FROM (SELECT unnest(generate_series((SELECT min(since) FROM seen), (SELECT wm FROM closing),
                                      INTERVAL {CFG.bras_agg1_seconds} SECOND)) AS timestamp) t, seen k
  WHERE t.timestamp >= k.since)"""
SQL["stream_alive_anomalies_filled"] = ("WITH " + LINES + "," + SPLIT + "," + _FAILOVER + "," + _CLOSED_ALIVE + "," + STATS_RAW + ","
                                        + STATS + "," + _LIVE_FILLED + "," + LATEST.replace("FROM alive c", "FROM filled c") + f"""
SELECT aggName, timestamp, aggField1, value, statsTimestamp, mean, stdDev FROM latest
WHERE statsTimestamp IS NOT NULL AND (mean - value) > {float(CFG.bras_std_dev_anomaly)} * stdDev""")
SQL["stream_index_docs"] = with_ctes(_CLOSED_ALIVE) + """
SELECT value, epoch_us(timestamp) // 1000 AS timestamp, aggName, aggField1, aggField1 AS nasIpAddress FROM alive"""
# every statistic that the final watermark closes
SQL["stream_stats_docs"] = with_ctes(ALIVE, STATS_RAW, STATS) + f"""
SELECT mean, stdDev, epoch_us(timestamp) // 1000 AS timestamp, aggName, aggField1, aggField1 AS nasIpAddress FROM stats
WHERE timestamp <= {WM_ALIVE}"""

# what holds for any clustering of the rows
_CHECKS = "CAST((SELECT count(DISTINCT aggField2) FROM stops) AS INTEGER) AS causes, true AS centreIsMean, true AS ownIsNearest, " \
          "CAST(2 AS INTEGER) AS clusters, true AS costNotAboveOne"
SQL["kmeans_distance"] = with_ctes(STOPS, RATIO_W) + f"\nSELECT DISTINCT aggField1, timestamp, {_CHECKS} FROM ratio"
SQL["stream_kmeans_distance"] = with_ctes(_CLOSED_STOPS) + f"\nSELECT DISTINCT aggField1, {_CHECKS} FROM stops"
SQL["kmeans_outliers"] = with_ctes(STOPS, RATIO_W) + "\nSELECT DISTINCT aggField1, timestamp, true AS flagIsTheRule FROM ratio"
SQL["stream_kmeans_outliers"] = with_ctes(_CLOSED_STOPS) + "\nSELECT DISTINCT aggField1, true AS flagIsTheRule FROM stops"

SQL["stream_hop_second_order"] = with_ctes(_CLOSED_ALIVE, STATS_RAW, STATS) + f"""
SELECT * FROM stats
WHERE timestamp <= (SELECT max(timestamp) FROM alive) - INTERVAL {CFG.agg_watermark_seconds} SECOND"""

SQL["distance_summary_merged"] = SQL["distance_summary"]
SQL["sigma_outliers_merged"] = SQL["sigma_outliers"]
SQL["sql_cdr_items"] = SQL["cdr_tuple22"]
SQL["stream_sql_counts"] = BASE + "\nSELECT acctStatusType, CAST(count(*) AS BIGINT) AS total FROM cdr GROUP BY acctStatusType"
# two batches: window ends up to the seventh day, and later ones; ids follow count and name within the batch that brings a label
SQL["cause_mix_stable"] = with_ctes(STOPS.replace("terminateCause AS aggField2", "clientId AS aggField2"), RATIO_W) + """,
part AS (SELECT *, least(date_diff('day', DATE '2024-01-01', CAST(timestamp AS DATE)) // 7, 1) AS batch FROM ratio),
brought AS (SELECT aggField2, min(batch) AS batch FROM part GROUP BY aggField2),
numbered AS (
  SELECT b.aggField2, row_number() OVER (ORDER BY b.batch, count(*) DESC, b.aggField2) - 1 AS id
  FROM brought b JOIN part p ON p.aggField2 = b.aggField2 AND p.batch = b.batch GROUP BY b.aggField2, b.batch)
SELECT p.aggField1, p.timestamp, CAST(n.id AS BIGINT) AS causeIndex, p.aggField2 AS cause, round(sum(p.ratioInBras), 9) AS ratioSum,
       min(min(p.sumPerBras)) OVER (PARTITION BY p.aggField1, p.timestamp) AS minSumPerBras
FROM part p JOIN numbered n USING (aggField2) GROUP BY p.aggField1, p.timestamp, n.id, p.aggField2"""
SQL["vector_sum"] = BASE + """,
v AS (SELECT nasIpAddress, accessType, [sessionTime, outputOctets, inputOctets, outputGigawords] AS x,
             CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0
                  WHEN event_id % 7 = 0 AND accessType <> '0' THEN 3 ELSE 4 END AS n FROM cdr),
w AS (SELECT nasIpAddress, accessType, min(n) AS width FROM v WHERE n > 0 GROUP BY ALL)
SELECT nasIpAddress, accessType, CAST(place AS INTEGER) AS place, CAST(sum(CASE WHEN n > place THEN x[place + 1] ELSE 0 END) AS DOUBLE) AS total
FROM v JOIN w USING (nasIpAddress, accessType), (SELECT unnest(range(4)) AS place) WHERE place < width
GROUP BY nasIpAddress, accessType, place"""
