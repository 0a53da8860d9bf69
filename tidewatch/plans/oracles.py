"""The queries again as plain SQL, written for comparison and not for scale."""

from __future__ import annotations

from collections.abc import Iterable

from tidewatch.plans.queries import AS_OF_MS, CUT_MS, HIGH_LEVELS

_HOUR = 3_600_000
_DAY = 86_400_000


def _key(name: str, uuid: str, host: str) -> str:
    return f"""({name} || '|{{"UUID":"' || {uuid} || '","host":"' || {host} || '"}}')"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


_TENANT = "CASE WHEN event_type IN ('click', 'view') THEN 't0' ELSE 't1' END"

EV = f"""ev AS (
  SELECT event_id AS seq, event_type AS name, epoch_us(ts) // 1000 AS ts_ms, value, user_id,
         {_TENANT} AS uuid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

PTS = f"""pts AS (
  SELECT seq, seq AS rid, name, ts_ms, value, uuid, k, {_key("name", "uuid", "name")} AS series_key,
         CASE WHEN k % 10 <= 5 THEN 0 WHEN k % 10 = 6 THEN -1 WHEN k % 10 = 7 THEN -2
              WHEN k % 10 = 8 THEN -3 ELSE 100 END AS reaction,
         ts_ms - ts_ms % {_HOUR} AS slot_ms
  FROM ev)"""

USR = f"""usr AS (
  SELECT seq, name, ts_ms, value, uuid, {_key("name", "uuid", "('u' || user_id)")} AS series_key,
         CASE WHEN k < 50 THEN 0 ELSE 1 END AS type, name = 'error' AS is_special
  FROM ev)"""

ORD = f"""pts AS (
  SELECT o_orderkey AS seq, o_orderkey AS rid, o_orderpriority AS name, epoch_us(o_orderdate) // 1000 AS ts_ms, o_totalprice AS value,
         {_key("o_orderpriority", "'shop'", "o_orderstatus")} AS series_key, 0 AS reaction,
         epoch_us(o_orderdate) // 1000 // {_HOUR} * {_HOUR} AS slot_ms
  FROM orders)"""

LIN = f"""pts AS (
  SELECT l_orderkey * 8 + l_linenumber AS seq, row_number() OVER () AS rid, l_returnflag AS name, epoch_us(l_shipdate) // 1000 AS ts_ms,
         l_extendedprice AS value, {_key("l_returnflag", "'shop'", "l_linestatus")} AS series_key, 0 AS reaction,
         epoch_us(l_shipdate) // 1000 // {_HOUR} * {_HOUR} AS slot_ms
  FROM lineitem)"""

BASE = """base AS (
  SELECT series_key, slot_ms, count(*) AS n, avg(value) AS avg, coalesce(stddev_samp(value), 0) AS dev,
         min(value) AS min, max(value) AS max
  FROM pts GROUP BY ALL)"""

# Each point against each of the seven days before it.
_PAIRS = f"""pairs AS (
  SELECT p.rid, p.seq, p.reaction, p.value AS v, d.day, CASE WHEN d.day = 7 THEN 2 ELSE 1 END AS kf,
         b.avg, b.dev, b.min, b.max,
         CASE WHEN b.avg <> 0 AND p.value <> 0 THEN (p.value - b.avg) / b.avg * 100 ELSE 0 END AS pct
  FROM pts p CROSS JOIN (SELECT unnest(range(1, 8)) AS day) d
  LEFT JOIN base b ON b.series_key = p.series_key AND b.slot_ms = p.slot_ms - d.day * {_DAY})"""

_SUMS = """sums AS (
  SELECT rid, count(avg) AS n_refs,
         sum(CASE WHEN reaction <> -1 AND v > avg + dev THEN kf ELSE 0 END)
       + sum(CASE WHEN reaction <> -1 AND v > max THEN kf ELSE 0 END)
       - sum(CASE WHEN reaction <> -2 AND v < min THEN kf ELSE 0 END)
       - sum(CASE WHEN reaction <> -2 AND v < avg - dev THEN kf ELSE 0 END) AS w,
         sum(CASE WHEN reaction <> -1 AND v > avg + dev THEN pct ELSE 0 END)
       + sum(CASE WHEN reaction <> -2 AND v < min THEN pct ELSE 0 END) AS p
  FROM pairs GROUP BY rid)"""

_SCORED = """scored AS (
  SELECT p.*, s.n_refs,
         CASE WHEN reaction BETWEEN -2 AND 0 THEN s.w
              WHEN reaction > 0 AND value > reaction THEN 16 ELSE 0 END AS weight,
         CASE WHEN reaction BETWEEN -2 AND 0 THEN s.p / 7
              WHEN reaction > 0 AND value > reaction THEN NULL ELSE 0 END AS weight_pct
  FROM pts p JOIN sums s USING (rid))"""

SCORE = (BASE, _PAIRS, _SUMS, _SCORED)
SCORED = (EV, PTS, *SCORE)


def _fit(source: str, keys: str) -> str:
    return f"""fit AS (
  SELECT *, regr_slope(value, x) OVER w AS s, regr_intercept(value, x) OVER w AS i
  FROM (SELECT *, ts_ms // 1000 - 1704067200 AS x FROM {source})
  WINDOW w AS (PARTITION BY {keys} ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING)),
predicted AS (
  SELECT *, CASE WHEN isnan(s) THEN NULL ELSE i + s * x END AS predicted
  FROM fit),
deviating AS (
  SELECT * EXCLUDE (s, i, x), CASE WHEN predicted IS NULL OR predicted = 0 THEN 0
         ELSE (value - predicted) / predicted * 100 END AS predict_pct
  FROM predicted)"""


_DEFAULT_RULES = """rules AS (
  SELECT * FROM (VALUES (0, 2, 5, 3), (1, 4, 10, 3), (2, 8, 20, 3), (3, 12, 30, 2), (4, 14, 50, 2), (5, 16, 70, 1))
    AS t(level, min_weight, min_pct, rec))"""

_LEVELED = """leveled AS (
  SELECT d.*, CASE WHEN weight = 0 THEN -1 ELSE coalesce((
           SELECT max(r.level) FROM rules r
           WHERE abs(d.weight) >= r.min_weight AND coalesce(abs(d.weight_pct) >= r.min_pct, true)), -1) END AS level
  FROM deviating d)"""

LEVELED = (*SCORED, _fit("scored", "series_key"), _DEFAULT_RULES, _LEVELED)

def _windows(keys: str, levels: Iterable[int] = range(6)) -> str:
    counts = ", ".join(f"count(*) FILTER (level >= {j}) OVER w AS c{j}" for j in levels)
    return f"""windows AS (
  SELECT *, {counts}, max(level) OVER w AS wmax, count(*) OVER w AS n_w,
         row_number() OVER (PARTITION BY {keys} ORDER BY ts_ms, seq) AS rn
  FROM leveled WHERE reaction <> -3
  WINDOW w AS (PARTITION BY {keys} ORDER BY ts_ms, seq ROWS 14 PRECEDING))"""


def _machine(keys: list[str], recs: list[str] | dict[int, str]) -> str:
    """A recursive walk along each series, one sample per step."""
    recs = recs if isinstance(recs, dict) else dict(enumerate(recs))
    levels = sorted(recs)
    holding = "CASE t.s WHEN -1 THEN w.n_w " + " ".join(f"WHEN {j} THEN w.c{j}" for j in levels) + " END"
    rows = " ".join(
        f"WHEN w.c{j} > {recs[j]} AND (t.s < w.level OR w.c{j} - ({holding}) > {recs[j]}) THEN {j}" for j in reversed(levels)
    )
    recurs = " OR ".join(f"w.c{j} > {recs[j]}" for j in levels)
    # A series starts at level -1, which any recurring level lies above or is counted beyond.
    start = " ".join(
        f"WHEN w.c{j} > {recs[j]} AND (-1 < w.level OR w.c{j} - w.n_w > {recs[j]}) THEN {j}" for j in reversed(levels)
    )
    join = " AND ".join(f"w.{k} = t.{k}" for k in keys)
    names = ", ".join(keys)
    cols = ", ".join(f"w.{k}" for k in keys)
    return f"""walk({names}, rn, seq, s0, s) AS (
  SELECT {cols}, w.rn, w.seq, -1, CASE WHEN w.wmax = -1 THEN -1 {start} ELSE -1 END
  FROM windows w WHERE w.rn = 1
  UNION ALL
  SELECT {cols}, w.rn, w.seq, t.s,
         CASE WHEN w.wmax = -1 THEN -1 {rows} WHEN {recurs} THEN t.s ELSE -1 END
  FROM walk t JOIN windows w ON {join} AND w.rn = t.rn + 1),
states AS (
  SELECT w.*, t.s0 AS prev_level, t.s AS state_level,
         CASE WHEN t.s0 = t.s THEN 1 WHEN t.s0 = -1 THEN 0 WHEN t.s = -1 THEN 3 ELSE 2 END AS state,
         w.wmax > -1 OR t.s0 <> -1 AS emitted,
         CASE WHEN w.wmax > -1 THEN w.weight > 0 WHEN t.s0 = -1 THEN false
              ELSE coalesce(lag(w.weight > 0) OVER (PARTITION BY {cols} ORDER BY w.rn), false) END AS upstate
  FROM windows w JOIN walk t USING (seq))"""


_DEFAULT_RECS = ["3", "3", "3", "2", "2", "1"]
STATES = (*LEVELED, _windows("series_key"), _machine(["series_key"], _DEFAULT_RECS))

# The same text as the Spark side builds, parsed here by other means.
MESSAGES = f"""sent AS (
  SELECT seq // 8 AS msg_id, '[' || string_agg(CASE WHEN k = 15 THEN '7' ELSE '{{' || concat_ws(',',
      CASE WHEN k <> 10 THEN '"metric":"' || name || '"' END,
      CASE WHEN k <> 11 THEN '"timestamp":' || ts_ms END,
      CASE WHEN k = 12 THEN '"value":"abc"' WHEN k = 16 THEN '"value":"2.5"' ELSE '"value":' || value END,
      CASE WHEN k = 14 THEN '"tags":{{"host":"' || name || '"}}'
           WHEN k <> 13 THEN '"tags":{{"host":"' || name || '","UUID":"' || uuid || '"}}' END,
      CASE WHEN name = 'error' THEN '"type":"Special","status":"ERROR","message":"m"' ELSE '"type":"Regular"' END,
      CASE WHEN k % 2 = 0 THEN '"reaction":' || (k % 5 - 3) END) || '}}' END, ',' ORDER BY seq) || ']' AS value
  FROM ev GROUP BY seq // 8),
messages AS (
  SELECT * FROM sent
  UNION ALL
  SELECT msg_id + 1000000000, CASE msg_id % 25 WHEN 7 THEN '{{"metric":"a"}}' WHEN 13 THEN '[{{bad' WHEN 19 THEN '[]' END
  FROM sent WHERE msg_id % 25 IN (7, 13, 19)),
gated AS (
  SELECT *, CASE WHEN NOT json_valid(value) THEN 'bad_json' WHEN json_type(value) <> 'ARRAY' THEN 'not_array' END AS gate
  FROM messages),
elements AS (
  SELECT msg_id, CAST(pos AS INTEGER) AS pos, json_extract(value, '$[' || pos || ']') AS e
  FROM (SELECT msg_id, value, unnest(range(CAST(json_array_length(value) AS BIGINT))) AS pos FROM gated WHERE gate IS NULL)),
fields AS (
  SELECT msg_id, pos, e, json_extract_string(e, '$.metric') AS name,
         try_cast(json_extract_string(e, '$.timestamp') AS BIGINT) AS ts_ms,
         try_cast(json_extract_string(e, '$.value') AS DOUBLE) AS value,
         json_extract(e, '$.tags') AS tags, json_extract_string(e, '$.tags.UUID') AS uuid,
         json_extract_string(e, '$.tags.host') AS host,
         lower(coalesce(json_extract_string(e, '$.type'), '')) = 'special' AS is_special,
         coalesce(try_cast(json_extract_string(e, '$.reaction') AS INTEGER), 0) AS reaction,
         json_extract_string(e, '$.status') AS status
  FROM elements),
parsed AS (
  SELECT *, lpad(CAST(msg_id AS VARCHAR), 19, '0') || '-' || lpad(CAST(pos AS VARCHAR), 10, '0') AS seq, {_key("name", "uuid", "host")} AS series_key,
         CASE WHEN json_type(e) <> 'OBJECT' THEN 'bad_element' WHEN name IS NULL THEN 'missing_name'
              WHEN ts_ms IS NULL THEN 'missing_timestamp' WHEN value IS NULL THEN 'missing_value'
              WHEN tags IS NULL THEN 'missing_tags' WHEN uuid IS NULL THEN 'missing_uuid' END AS reason
  FROM fields),
rejected AS (
  SELECT msg_id, NULL::INTEGER AS pos, gate AS reason FROM gated WHERE gate IS NOT NULL
  UNION ALL SELECT msg_id, pos, reason FROM parsed WHERE reason IS NOT NULL)"""
PARSED = (EV, MESSAGES)

_CATALOG = f"""cat AS (
  SELECT series_key, any_value(uuid) AS uuid, any_value(name) AS name, min(ts_ms) AS first_ts_ms,
         arg_max(ts_ms, seq) AS last_ts_ms, arg_max(type, seq) AS type, arg_max(is_special, seq) AS is_special,
         count(*) AS n_points
  FROM usr GROUP BY series_key)"""
CATALOG = (EV, USR, _CATALOG)
_CATALOG_COLUMNS = "series_key, uuid, name, first_ts_ms, last_ts_ms, type, is_special, n_points"


def _special(by_user: bool = False, controlled: bool = False) -> tuple[str, ...]:
    host = "('u' || user_id)" if by_user else "name"
    # A delete at or before a point counts; one after it ends what its timers may do.
    epoch = "(SELECT count(*) FROM err d WHERE d.k = 99 AND d.series_key = e.series_key AND d.ts_ms <= e.ts_ms)" if controlled else "0"
    deleted = "(SELECT min(d.ts_ms) FROM err d WHERE d.k = 99 AND d.series_key = e.series_key AND d.ts_ms > e.ts_ms)" if controlled else "NULL"
    return (
        EV,
        f"""err AS (
  SELECT seq, ts_ms, k, {_key("name", "uuid", host)} AS series_key, CASE WHEN k % 2 = 0 THEN 60 ELSE -60 END AS reaction,
         CASE WHEN k = 99 THEN 'STALE' WHEN k % 4 = 1 THEN 'WARNING' WHEN k % 4 = 2 THEN 'ERROR' ELSE 'OK' END AS status
  FROM ev WHERE name = 'error'),
st AS (
  SELECT *, CASE status WHEN 'OK' THEN -1 WHEN 'WARNING' THEN 3 WHEN 'ERROR' THEN 5 END AS lv,
         ((ts_ms + 3600000) // 60000 + 1) * 60000 AS fire
, {epoch} AS epoch, {deleted} AS deleted_ms
  FROM err e WHERE status <> 'STALE'),
nb AS (
  SELECT *, coalesce(lead(ts_ms) OVER w, deleted_ms) AS next_ms, lag(fire) OVER w AS p_fire, lag(reaction) OVER w AS p_reaction, lag(lv) OVER w AS p_lv
  FROM st WINDOW w AS (PARTITION BY series_key, epoch ORDER BY ts_ms, seq)),
ev_status AS (
  SELECT 'status' AS kind, epoch, series_key, seq, ts_ms, ts_ms AS event_ms, lv AS state_level,
         CASE WHEN p_fire < ts_ms AND p_reaction < 0 THEN -1 WHEN p_fire < ts_ms AND p_reaction > 0 THEN 5
              ELSE coalesce(p_lv, -1) END AS prev_level
  FROM nb),
ev_close AS (
  SELECT 'autoclose' AS kind, epoch, series_key, seq, ts_ms, fire AS event_ms, -1 AS state_level, lv AS prev_level
  FROM nb WHERE reaction < 0 AND fire <= {AS_OF_MS} AND (next_ms IS NULL OR fire < next_ms)),
ev_dead AS (
  SELECT 'deadman' AS kind, epoch, series_key, seq, ts_ms, tick AS event_ms, 5 AS state_level,
         CASE WHEN tick = fire THEN lv ELSE 5 END AS prev_level, tick = fire AS is_first
  FROM (SELECT *, unnest(range(fire, least({AS_OF_MS}, coalesce(next_ms - 1, {AS_OF_MS})) + 1, 60000)) AS tick
        FROM nb WHERE reaction > 0))""",
    )


_STATE = "CASE WHEN prev_level = state_level THEN 1 WHEN prev_level = -1 THEN 0 WHEN state_level = -1 THEN 3 ELSE 2 END"
_SPECIAL_COLUMNS = f"series_key, seq, event_ms, prev_level, state_level, {_STATE} AS state"

_BEATS = f"""beats AS (
  SELECT *, ((ts_ms + 600000) // 60000 + 1) * 60000 AS fire,
         lead(ts_ms) OVER w AS next_ms, lag(ts_ms) OVER w AS prev_ms
  FROM pts WHERE name = 'view' WINDOW w AS (PARTITION BY series_key ORDER BY ts_ms, seq)),
silence AS (
  SELECT series_key, uuid, 'absent' AS kind, fire AS event_ms, ts_ms AS last_seen_ms, -1 AS prev_level, 5 AS state_level, 0 AS state,
         NULL::INTEGER AS reaction, NULL::DOUBLE AS value
  FROM beats WHERE fire <= {AS_OF_MS} AND (next_ms IS NULL OR fire < next_ms)
  UNION ALL
  SELECT series_key, uuid, 'back', ts_ms, prev_ms, 5, -1, 3, reaction, value
  FROM beats WHERE ((prev_ms + 600000) // 60000 + 1) * 60000 < ts_ms)"""

_EPOCHS = """epochs AS (
  SELECT p.*,
         (SELECT count(*) FROM pts c WHERE c.k = 99 AND c.series_key = p.series_key AND c.ts_ms <= p.ts_ms) AS epoch,
         (SELECT count(*) FROM pts c WHERE c.k IN (97, 99) AND c.series_key = p.series_key AND c.ts_ms <= p.ts_ms) AS fit_epoch
  FROM {source} p)"""


def _epochs(source: str = "pts") -> str:
    return _EPOCHS.replace("{source}", source)


_VERSIONS = """versions AS (
  SELECT uuid, row_number() OVER w AS version, ts_ms AS valid_from_ms, lead(ts_ms) OVER w AS valid_to_ms, 1 + seq % 3 AS scale
  FROM pts WHERE k = 95 WINDOW w AS (PARTITION BY uuid ORDER BY ts_ms, seq))"""

# Rules in force at each point: scale 0 stands for the defaults.
_CONTROLLED = """ruled AS (
  SELECT d.*, coalesce((
    SELECT arg_max(v.scale, v.version) FROM versions v WHERE v.uuid = d.uuid AND v.valid_from_ms <= d.ts_ms), 0) AS scale
  FROM deviating d),
all_rules AS (
  SELECT 0 AS scale, level, min_weight, min_pct FROM rules
  UNION ALL SELECT s, j, s * (j + 1), 5 * (j + 1) FROM (SELECT unnest(range(1, 4)) AS s), (SELECT unnest(range(6)) AS j)),
leveled AS (
  SELECT d.*, CASE WHEN weight = 0 THEN -1 ELSE coalesce((
           SELECT max(r.level) FROM all_rules r
           WHERE r.scale = d.scale AND abs(d.weight) >= r.min_weight
             AND coalesce(abs(d.weight_pct) >= r.min_pct, true)), -1) END AS level
  FROM ruled d)"""
_VERSIONED_RECS = [f"(CASE WHEN w.scale = 0 THEN {_DEFAULT_RECS[j]} ELSE {3 - j // 2} END)" for j in range(6)]

CONTROLLED = (
    *SCORED,
    _epochs("scored"),
    _fit("epochs", "series_key, fit_epoch"),
    _DEFAULT_RULES,
    _VERSIONS,
    _CONTROLLED,
    _windows("series_key, epoch"),
    _machine(["series_key", "epoch"], _VERSIONED_RECS),
)

_ALL_ALERTS = f"""found AS (
  SELECT 'level' AS source, uuid, state AS action, state_level AS level, prev_level, ts_ms AS time, true AS has_point
  FROM states WHERE emitted
  UNION ALL SELECT 'special', 't1', {_STATE}, state_level, prev_level, ts_ms, true FROM (
    SELECT prev_level, state_level, ts_ms FROM ev_status
    UNION ALL SELECT prev_level, state_level, ts_ms FROM ev_close
    UNION ALL SELECT prev_level, state_level, ts_ms FROM ev_dead)
  UNION ALL SELECT 'absence', uuid, state, state_level, prev_level, event_ms, kind = 'back' FROM silence)"""
# Regular points are those that are not errors, from the first step on.
_REGULAR = PTS.replace("FROM ev)", "FROM ev WHERE name <> 'error')").replace("pts AS (", "pts AS (", 1)
_ALERTS = (
    *_special(),
    _REGULAR,
    *SCORE,
    _fit("scored", "series_key"),
    _DEFAULT_RULES,
    _LEVELED,
    _windows("series_key"),
    _machine(["series_key"], _DEFAULT_RECS),
    _BEATS,
    _ALL_ALERTS,
)

_START_END = ", ".join(
    f"max(CASE WHEN prev_level < {j} AND state_level >= {j} THEN ts_ms END) OVER w AS start_{j}, "
    f"max(CASE WHEN state_level < {j} AND prev_level >= {j} THEN ts_ms END) OVER w AS end_{j}"
    for j in range(6)
)
_TIMED = f"""timed AS (
  SELECT *, {_START_END} FROM states
  WINDOW w AS (PARTITION BY series_key ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING))"""


# Tenants with levels of their own next to those with the default ones.
_TENANT_EV = EV.replace(f"{_TENANT} AS uuid", "'c' || (user_id % 7 + 1) AS uuid")


def _tenants(own: tuple[int, ...]) -> tuple[str, ...]:
    levels = sorted({*range(6), *own})
    default = dict(enumerate(_DEFAULT_RECS))
    recs = {
        j: f"(CASE WHEN w.own THEN {3 - own.index(j) if j in own else 99} ELSE {default.get(j, 99)} END)" for j in levels
    }
    passes = "abs(d.weight) >= r.min_weight AND coalesce(abs(d.weight_pct) >= r.min_pct, true)"
    return (
        _TENANT_EV,
        PTS,
        *SCORE,
        _fit("scored", "series_key"),
        _DEFAULT_RULES,
        f"""own_rules AS (
  SELECT 'c' || c_custkey AS uuid, ([{", ".join(map(str, own))}])[j + 1] AS level,
         (c_nationkey % 3 + 1) * (j + 1) AS min_weight, 5 * (j + 1) AS min_pct
  FROM customer, (SELECT unnest(range(3)) AS j) WHERE c_custkey % 3 = 1),
owners AS (SELECT DISTINCT uuid AS owner FROM own_rules),
leveled AS (
  SELECT d.*, owner IS NOT NULL AS own,
         CASE WHEN weight = 0 THEN -1
              WHEN owner IS NOT NULL THEN coalesce((SELECT max(r.level) FROM own_rules r WHERE r.uuid = d.uuid AND {passes}), -1)
              ELSE coalesce((SELECT max(r.level) FROM rules r WHERE {passes}), -1) END AS level
  FROM deviating d LEFT JOIN owners ON owner = uuid)""",
        _windows("series_key", levels),
        _machine(["series_key"], recs),
    )


def _entered(prefix: str, at: str, order: str, levels: Iterable[int] = range(6)) -> str:
    """When each level was last entered, or left, up to each row."""
    crossed = "prev_level < {j} AND state_level >= {j}" if prefix == "start" else "state_level < {j} AND prev_level >= {j}"
    return ", ".join(
        f"max(CASE WHEN {crossed.format(j=j)} THEN {at} END) OVER (PARTITION BY series_key ORDER BY {order} "
        f"ROWS UNBOUNDED PRECEDING) AS {prefix}_{j}"
        for j in levels
    )


_TIME_NAMES = ", ".join(f"{p}_{j}" for p in ("start", "end") for j in range(6))
_PAYLOADS = f"""payloads AS (
  SELECT series_key, uuid, state AS action, ts_ms AS time, 0 AS type, reaction, value AS startvalue, NULL::VARCHAR AS message,
         'level' AS source, state_level AS level, prev_level, upstate, n_w AS n_values, {_TIME_NAMES}
  FROM timed WHERE emitted
  UNION ALL
  SELECT series_key, 't1', {_STATE}, ts_ms, 1, reaction, value, 'error seen', 'special', state_level, prev_level, false, 0,
         {_entered("start", "event_ms", "event_ms, seq")}, {_entered("end", "event_ms", "event_ms, seq")}
  FROM (SELECT s.*, e.reaction, v.value FROM (
      SELECT series_key, seq, ts_ms, event_ms, prev_level, state_level FROM ev_status
      UNION ALL SELECT series_key, seq, ts_ms, event_ms, prev_level, state_level FROM ev_close
      UNION ALL SELECT series_key, seq, ts_ms, event_ms, prev_level, state_level FROM ev_dead) s
    JOIN err e USING (seq) JOIN ev v USING (seq))
  UNION ALL
  SELECT series_key, uuid, state, event_ms, CASE kind WHEN 'back' THEN 0 END, reaction, value, NULL, 'absence', state_level,
         prev_level, false, 0, {_entered("start", "last_seen_ms", "event_ms")}, {_entered("end", "event_ms", "event_ms")}
  FROM silence)"""


def _filled(prefix: str) -> str:
    return " + ".join(f"CAST({prefix}_{j} IS NOT NULL AS INTEGER)" for j in range(6))


def _rounded_score(source: tuple[str, ...]) -> str:
    return _with(*source) + "SELECT series_key, seq, n_refs, weight, round(weight_pct, 6) + 0.0 AS weight_pct FROM scored"


_WANTED = f"""wanted AS (
  SELECT DISTINCT series_key, (ts_ms + {_HOUR}) - (ts_ms + {_HOUR}) % {_HOUR} - d.day * {_DAY} AS slot_ms
  FROM pts CROSS JOIN (SELECT unnest(range(1, 8)) AS day) d),
stored AS (SELECT DISTINCT series_key, slot_ms FROM pts WHERE ts_ms < {CUT_MS}),
missing AS (SELECT * FROM wanted ANTI JOIN stored USING (series_key, slot_ms))"""

ORACLES: dict[str, str] = {
    "parse_points": _with(*PARSED)
    + """SELECT series_key, name, ts_ms, value, uuid, CAST(is_special AS INTEGER) AS type, reaction, is_special, status, seq
FROM parsed WHERE reason IS NULL""",
    "parse_dead_letter": _with(*PARSED) + "SELECT msg_id, pos, reason FROM rejected",
    "required_field_rejects": _with(*PARSED) + "SELECT reason, count(*) AS n FROM rejected GROUP BY reason",
    "split_special": _with(*PARSED)
    + """SELECT CASE WHEN is_special THEN 'special' ELSE 'regular' END AS kind, seq, series_key, value
FROM parsed WHERE reason IS NULL""",
    "heartbeat_filter": _with(EV, PTS) + "SELECT series_key, ts_ms, seq, value FROM pts WHERE name = 'view'",
    "host_absent_synthesis": _with(EV, PTS)
    + f"""SELECT series_key, name, ts_ms, seq, false AS is_special, NULL::VARCHAR AS status, NULL::VARCHAR AS message FROM pts
UNION ALL SELECT {_key("'host_absent'", "uuid", "name")}, 'host_absent', ts_ms, seq, true, 'ERROR', 'Host Absent'
FROM pts WHERE name = 'view'""",
    "series_identity": _with(EV, USR) + "SELECT DISTINCT series_key, name, uuid FROM usr",
    "hash_collisions": _with(EV, USR)
    + """SELECT substr(md5(series_key), 1, 2) AS short_hash, count(DISTINCT series_key) AS n_series, min(series_key) AS first_key
FROM usr GROUP BY 1 HAVING count(DISTINCT series_key) > 1""",
    "series_catalog": _with(*CATALOG) + f"SELECT {_CATALOG_COLUMNS} FROM cat",
    "catalog_special": _with(*CATALOG) + f"SELECT {_CATALOG_COLUMNS} FROM cat WHERE is_special",
    "catalog_by_name": _with(*CATALOG) + f"SELECT {_CATALOG_COLUMNS} FROM cat WHERE name = 'purchase'",
    "catalog_upsert": _with(*CATALOG) + f"SELECT {_CATALOG_COLUMNS} FROM cat",
    "catalog_enrichment": _with(
        EV,
        USR,
        f"""known AS (
  SELECT series_key, min(ts_ms) AS known_since_ms, arg_max(ts_ms, seq) AS known_last_ms, arg_max(type, seq) AS known_type
  FROM usr WHERE ts_ms < {CUT_MS} GROUP BY series_key)""",
    )
    + f"""SELECT u.series_key, u.seq, k.series_key IS NOT NULL AS is_known, known_since_ms, known_last_ms, known_type
FROM usr u LEFT JOIN known k USING (series_key) WHERE u.ts_ms >= {CUT_MS}""",
    "type_changes": _with(EV, USR)
    + """SELECT series_key, ts_ms, seq, prev_type, type FROM (
  SELECT *, lag(type) OVER (PARTITION BY series_key ORDER BY ts_ms, seq) AS prev_type FROM usr) WHERE prev_type <> type""",
    "latest_by_event_time": _with(EV, USR)
    + f"""SELECT series_key, d AS ts_ms, seq, value FROM (
  SELECT *, ts_ms - ts_ms % {_DAY} AS d FROM usr)
QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY d DESC, seq) = 1""",
    "latest_by_arrival": _with(EV, USR)
    + """SELECT series_key, ts_ms, seq, value FROM usr
QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY seq DESC) = 1""",
    "point_sink_dedup": _with(EV, PTS)
    + """SELECT series_key, slot_ms AS ts_ms, seq, value FROM pts
QUALIFY row_number() OVER (PARTITION BY series_key, slot_ms ORDER BY seq DESC) = 1""",
    "hourly_baseline": _with(EV, PTS, BASE)
    + "SELECT series_key, slot_ms, n, round(avg, 6) AS avg, round(dev, 6) AS dev, min, max FROM base",
    "hourly_baseline_lineitem": _with(LIN, BASE)
    + "SELECT series_key, slot_ms, n, round(avg, 6) AS avg, round(dev, 4) AS dev, min, max FROM base",
    "baseline_range_read": _with(EV, PTS)
    + f"SELECT series_key, ts_ms, seq, value FROM pts WHERE ts_ms BETWEEN {CUT_MS} AND {CUT_MS + _DAY - 1}",
    "missing_baselines": _with(EV, PTS, _WANTED) + "SELECT series_key, slot_ms FROM missing",
    "incremental_baseline": _with(EV, PTS, BASE, _WANTED)
    + """SELECT series_key, slot_ms, coalesce(n, 0) AS n, round(avg, 6) AS avg, round(dev, 6) AS dev, min, max
FROM missing LEFT JOIN base USING (series_key, slot_ms)""",
    "baseline_join": _with(EV, PTS, BASE, _PAIRS)
    + """SELECT p.series_key, seq, q.day, CASE WHEN q.avg IS NOT NULL THEN kf END AS vote,
  round(q.avg, 6) AS avg, round(q.dev, 6) AS dev, q.min, q.max FROM pairs q JOIN pts p USING (seq)""",
    "score_points": _with(*SCORED)
    + "SELECT series_key, seq, reaction, n_refs, weight, round(weight_pct, 6) + 0.0 AS weight_pct FROM scored",
    "score_by_reaction": _with(*SCORED)
    + """SELECT reaction, count(*) AS n, min(weight) AS min_weight, max(weight) AS max_weight,
  CAST(sum(abs(weight)) AS BIGINT) AS sum_abs_weight FROM scored GROUP BY reaction""",
    "score_orders": _rounded_score((ORD, *SCORE)),
    "score_lineitem": _rounded_score((LIN, *SCORE)),
    "reaction_gate": _with(
        EV,
        PTS.replace("pts AS (", "raw_pts AS (", 1),
        f"""pts AS (SELECT * REPLACE (CASE WHEN reaction <> -3 AND ts_ms < {CUT_MS} THEN -4 ELSE reaction END AS reaction)
  FROM raw_pts)""",
        *SCORE,
    )
    + "SELECT seq, reaction, weight FROM scored",
    "regression_predict": _with(EV, PTS, _fit("pts", "series_key"))
    + "SELECT series_key, seq, round(predicted, 4) + 0.0 AS predicted, round(predict_pct, 4) + 0.0 AS predict_pct FROM deviating",
    "regression_reset": _with(EV, PTS, _epochs(), _fit("epochs", "series_key, fit_epoch"))
    + "SELECT series_key, seq, fit_epoch, round(predict_pct, 4) + 0.0 AS predict_pct FROM deviating",
    "regression_resume": _with(EV, PTS, _fit("pts", "series_key"))
    + f"""SELECT series_key, seq, round(predicted, 4) + 0.0 AS predicted, round(predict_pct, 4) + 0.0 AS predict_pct
FROM deviating WHERE ts_ms >= {CUT_MS}""",
    "regression_totals": _with(EV, PTS)
    + """SELECT series_key, count(*) AS n, round(regr_slope(value, x), 10) + 0.0 AS slope,
  round(regr_intercept(value, x), 6) + 0.0 AS intercept
FROM (SELECT *, ts_ms // 1000 - min(ts_ms // 1000) OVER (PARTITION BY series_key) AS x FROM pts) GROUP BY series_key""",
    "tenant_levels": """
WITH own AS (
  SELECT 'c' || c_custkey AS uuid, j AS level, CAST((c_nationkey % 3 + 1) * (j + 1) AS DOUBLE) AS min_weight,
         CAST(5 * (j + 1) AS DOUBLE) AS min_pct, 3 - j AS rec_count
  FROM customer, (SELECT unnest(range(3)) AS j) WHERE c_custkey % 3 = 1),
defaults AS (
  SELECT 'c' || c_custkey, t.* FROM customer,
    (VALUES (0, 2.0, 5.0, 3), (1, 4.0, 10.0, 3), (2, 8.0, 20.0, 3), (3, 12.0, 30.0, 2), (4, 14.0, 50.0, 2), (5, 16.0, 70.0, 1)) t
  WHERE c_custkey % 3 <> 1)
SELECT uuid, CAST(level AS INTEGER) AS level, CAST(min_weight AS DOUBLE) AS min_weight, CAST(min_pct AS DOUBLE) AS min_pct,
  CAST(0 AS DOUBLE) AS min_value, CAST(0 AS DOUBLE) AS min_predict_pct, CAST(rec_count AS INTEGER) AS rec_count
FROM (SELECT * FROM own UNION ALL SELECT * FROM defaults)""",
    "status_levels": _with(*_special()) + "SELECT seq, status, lv AS status_level FROM st",
    "status_dead_letter": _with(*_special()) + "SELECT seq, status FROM err WHERE status = 'STALE'",
    "point_levels_default": _with(*LEVELED)
    + "SELECT series_key, seq, weight, round(weight_pct, 6) + 0.0 AS weight_pct, level FROM leveled",
    "error_log": _with(*LEVELED)
    + """SELECT uuid, ts_ms // 1000 AS ts_s, series_key, weight, round(weight_pct, 6) + 0.0 AS weight_pct, value,
  round(predict_pct, 4) + 0.0 AS predict_pct
FROM leveled WHERE weight <> 0 AND reaction <> -3
QUALIFY row_number() OVER (PARTITION BY uuid, ts_ms // 1000, series_key ORDER BY seq DESC) = 1""",
    "level_window_counts": _with(*LEVELED, _windows("series_key"))
    + "SELECT series_key, seq, level, n_w AS n_samples, "
    + ", ".join(f"c{j} AS cnt_{j}" for j in range(6))
    + " FROM windows",
    "window_max_level": _with(*LEVELED, _windows("series_key")) + "SELECT series_key, seq, wmax AS window_max FROM windows",
    "level_state": _with(*STATES) + "SELECT series_key, seq, prev_level, state_level, state, emitted, upstate FROM states",
    "level_times": _with(*STATES, _TIMED)
    + "SELECT series_key, seq, "
    + ", ".join(f"{p}_{j}" for p in ("start", "end") for j in range(6))
    + " FROM timed",
    "level_state_resumed": _with(*STATES, _TIMED)
    + "SELECT series_key, seq, level, prev_level, state_level, state, emitted, upstate, "
    + ", ".join(f"{p}_{j}" for p in ("start", "end") for j in range(6))
    + " FROM timed",
    "level_state_controlled": _with(*CONTROLLED)
    + "SELECT series_key, seq, epoch, fit_epoch, level, prev_level, state_level, state FROM states",
    "special_status": _with(*_special()) + f"SELECT {_SPECIAL_COLUMNS} FROM ev_status",
    "special_autoclose": _with(*_special()) + f"SELECT {_SPECIAL_COLUMNS} FROM ev_close",
    "special_deadman": _with(*_special()) + f"SELECT {_SPECIAL_COLUMNS} FROM ev_dead",
    "special_deadman_first": _with(*_special(by_user=True)) + f"SELECT {_SPECIAL_COLUMNS} FROM ev_dead WHERE is_first",
    "special_controlled": _with(*_special(controlled=True))
    + " UNION ALL ".join(f"SELECT kind, {_SPECIAL_COLUMNS}, epoch FROM ev_{t}" for t in ("status", "close", "dead")),
    "host_absence": _with(EV, PTS, _BEATS)
    + "SELECT series_key, kind, event_ms, last_seen_ms, prev_level, state_level, state FROM silence",
    "overdue_hosts": _with(EV, USR)
    + f"""SELECT series_key, ts_ms, seq, {AS_OF_MS} - ts_ms AS silent_ms FROM (
  SELECT * FROM usr QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY ts_ms DESC, seq) = 1)
WHERE {AS_OF_MS} - ts_ms > {5 * _DAY}""",
    "clock_evaluation": _with(EV, PTS, _BEATS)
    + f"""SELECT series_key, unnest(range(fire, least({AS_OF_MS}, coalesce(next_ms - 1, {AS_OF_MS})) + 1, 60000)) AS tick_ms,
  ts_ms AS last_seen_ms FROM beats""",
    "control_decode": _with(EV, PTS)
    + """SELECT ts_ms, seq, CASE k WHEN 95 THEN 'updatelevels' WHEN 97 THEN 'resetregresion' ELSE 'deletemetricbyhash' END AS action,
  CASE WHEN k <> 95 THEN series_key END AS series_key, CASE WHEN k = 95 THEN uuid END AS uuid,
  CASE WHEN k = 95 THEN 6 ELSE 0 END AS n_rules FROM pts WHERE k IN (95, 97, 99)""",
    "control_dead_letter": _with(EV, PTS)
    + """SELECT ts_ms, seq, CASE k WHEN 94 THEN 'missing_uuid' ELSE 'bad_changedata' END AS reason FROM pts WHERE k IN (94, 96)""",
    "control_asof_epochs": _with(EV, PTS, _epochs()) + "SELECT series_key, seq, epoch, fit_epoch FROM epochs",
    "levels_versioned": _with(EV, PTS, _VERSIONS)
    + """SELECT uuid, version, valid_from_ms, valid_to_ms, CAST(j AS INTEGER) AS level, CAST(scale * (j + 1) AS DOUBLE) AS min_weight,
  CAST(5 * (j + 1) AS DOUBLE) AS min_pct, CAST(3 - j // 2 AS INTEGER) AS rec_count
FROM versions, (SELECT unnest(range(6)) AS j)""",
    "levels_asof": _with(EV, PTS, _VERSIONS)
    + """SELECT p.series_key, p.seq, 6 AS n_rules, CAST(coalesce((
  SELECT arg_max(v.scale, v.version) * 6 FROM versions v
  WHERE v.uuid = p.uuid AND v.valid_from_ms <= p.ts_ms), 16) AS DOUBLE) AS top_min_weight FROM pts p""",
    "alert_events": _with(*STATES, _TIMED)
    + f"""SELECT lower(hex(series_key)) AS key, state AS action, ts_ms AS time, 0 AS type, reaction, value AS startvalue,
  'level' AS source, state_level AS level, prev_level, upstate, uuid, n_w AS n_values, level AS last_level, value AS last_value,
  {_filled("start")} AS n_starts, {_filled("end")} AS n_ends
FROM timed WHERE emitted""".replace("level AS last_level", "timed.level AS last_level"),
    "alert_union": _with(*_ALERTS)
    + """SELECT source, action, level, prev_level, count(*) AS n, count(*) FILTER (has_point) AS n_with_point,
  CAST(sum(time) AS BIGINT) AS sum_time FROM found GROUP BY ALL""",
    "alert_routing": _with(*_ALERTS)
    + """SELECT source, topic, role, count(*) AS n, count(*) FILTER (role = 'main') AS n_named FROM (
  SELECT source, uuid || level AS topic, 'level' AS role FROM found
  UNION ALL SELECT source, uuid || prev_level, 'left' FROM found WHERE level <> prev_level
  UNION ALL SELECT source, 'errors', 'main' FROM found WHERE action <> 1) GROUP BY ALL""",
    "alert_payload": _with(*_ALERTS, _TIMED, _PAYLOADS)
    + f"""SELECT topic, role, lower(hex(series_key)) AS key, action, time, type, reaction, startvalue, message, source, level,
  upstate, CASE role WHEN 'main' THEN uuid END AS uuid, {_TIME_NAMES}, true AS has_starttimes, true AS has_endtimes, n_values
FROM (
  SELECT *, uuid || level AS topic, 'level' AS role FROM payloads
  UNION ALL SELECT *, uuid || prev_level, 'left' FROM payloads WHERE level <> prev_level
  UNION ALL SELECT *, 'errors', 'main' FROM payloads WHERE action <> 1)""",
    "point_levels_tenant": _with(*_tenants((0, 1, 2))) + "SELECT series_key, seq, weight, level FROM leveled",
    "level_state_tenant": _with(*_tenants((0, 1, 2)))
    + "SELECT series_key, seq, level, prev_level, state_level, state FROM states",
    "level_state_high_levels": _with(*_tenants(HIGH_LEVELS))
    + f"""SELECT series_key, seq, level, prev_level, state_level, state,
  {_entered("start", "ts_ms", "ts_ms, seq", HIGH_LEVELS)}, {_entered("end", "ts_ms", "ts_ms, seq", HIGH_LEVELS)} FROM states""",
    "observed_points": _with(EV, USR) + "SELECT series_key, ts_ms, seq FROM usr",
    "percent_deviation": """
SELECT o_orderkey AS seq, round((o_totalprice - m) / m * 100, 4) + 0.0 AS pct
FROM (SELECT *, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS m FROM orders)""",
    "messages_to_records": _with(
        *PARSED,
        f"""pts AS (
  SELECT seq, seq AS rid, name, ts_ms, value, uuid, series_key, reaction, ts_ms - ts_ms % {_HOUR} AS slot_ms
  FROM parsed WHERE reason IS NULL AND NOT is_special)""",
        *SCORE,
        _fit("scored", "series_key"),
        _DEFAULT_RULES,
        _LEVELED,
        _windows("series_key"),
        _machine(["series_key"], _DEFAULT_RECS),
    )
    + """SELECT topic, role, action, level, prev_level, count(*) AS n, CAST(sum(ts_ms) AS BIGINT) AS sum_time FROM (
  SELECT uuid || state_level AS topic, 'level' AS role, state AS action, state_level AS level, prev_level, ts_ms FROM states WHERE emitted
  UNION ALL SELECT uuid || prev_level, 'left', state, state_level, prev_level, ts_ms FROM states WHERE emitted AND state_level <> prev_level
  UNION ALL SELECT 'errors', 'main', state, state_level, prev_level, ts_ms FROM states WHERE emitted AND state <> 1) GROUP BY ALL""",
    "latest_parsed": _with(*PARSED)
    + f"""SELECT series_key, d AS ts_ms, seq, value, last_seq, n_points FROM (
  SELECT *, ts_ms - ts_ms % {_DAY} AS d, max(seq) OVER (PARTITION BY series_key) AS last_seq,
         count(*) OVER (PARTITION BY series_key) AS n_points FROM parsed WHERE reason IS NULL)
QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY d DESC, seq) = 1""",
    "late_reactions": _with(EV, PTS)
    + f"""SELECT seq, series_key, CAST(CASE WHEN reaction <> -3 AND ts_ms < seen - {_HOUR} THEN -4 ELSE reaction END AS INTEGER) AS reaction
FROM (SELECT *, max(ts_ms) OVER (
        ORDER BY ts_ms + CASE WHEN seq % 13 = 0 THEN {2 * _HOUR} ELSE 0 END, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM pts)""",
    "merged_baseline": _with(EV, PTS, BASE)
    + "SELECT series_key, slot_ms, n, round(avg, 6) AS avg, round(dev, 6) AS dev, min, max FROM base",
}
