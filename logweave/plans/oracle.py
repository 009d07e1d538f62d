"""DuckDB SQL for every registered query, used as the correctness oracle.

The SQL re-derives the raw lines from ``events`` (same rules as
``logweave.sources.fixtures``), parses them, and computes each result with plain
SQL (windows, ``string_agg``, ``arg_min``), independently of the Spark code.
"""

from __future__ import annotations

# Fixed values that results depend on, written out here so that the code under test does not supply them.
SERVICE_CHAIN = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]
MODEL = "meta/llama3-70b-instruct"
SYSTEM_TEXT = (
    "You are an expert distributed systems engineer performing root cause analysis on microservice logs. "
    "Analyze the logs and deduce which service caused the fault. Respond ONLY with valid JSON in this format: "
    '{"root_cause": "...", "recommendation": "...", "severity": "critical|warning|info"}. '
    "Do not wrap the JSON in markdown code blocks or add introductory text."
)
NL = "chr(10)"
RFC3339 = r"\d{4}-\d\d-\d\dT\d{1,2}:\d\d:\d\d([.,]\d+)?(Z|[+-]\d\d:\d\d)"
UTC_US = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def _tw(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{85}}\x{{a0}}\p{{Z}}]+|[\s\x{{85}}\x{{a0}}\p{{Z}}]+$', '', 'g')"


def _dur(ms: str) -> str:
    a = f"abs({ms})"
    h, m, s, frac = f"({a} // 3600000)", f"(({a} // 60000) % 60)", f"(({a} // 1000) % 60)", f"({a} % 1000)"
    frac_txt = f"CASE WHEN {frac} > 0 THEN '.' || rtrim(lpad(CAST({frac} AS VARCHAR), 3, '0'), '0') ELSE '' END"
    long = (
        f"(CASE WHEN {h} > 0 THEN CAST({h} AS VARCHAR) || 'h' ELSE '' END"
        f" || CASE WHEN {a} >= 60000 THEN CAST({m} AS VARCHAR) || 'm' ELSE '' END"
        f" || CAST({s} AS VARCHAR) || {frac_txt} || 's')"
    )
    body = f"(CASE WHEN {a} < 1000 THEN CAST({a} AS VARCHAR) || 'ms' ELSE {long} END)"
    return f"(CASE WHEN {ms} = 0 THEN '0s' WHEN {ms} < 0 THEN '-' || {body} ELSE {body} END)"


def _latency(x: str) -> str:
    t = _tw(x)
    p = f"(CASE WHEN starts_with({t}, 'latency=') THEN substr({t}, 9) ELSE {t} END)"
    s = f"(CASE WHEN ends_with({p}, 'ms') THEN left({p}, length({p}) - 2) ELSE {p} END)"
    return f"(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN coalesce(TRY_CAST({s} AS BIGINT), 0) ELSE 0 END)"


def lines_sql(key: str = "bucket") -> str:
    chain = "[" + ", ".join(f"'{s}'" for s in SERVICE_CHAIN) + "]"
    rid = (
        "'req-' || CAST(user_id AS VARCHAR)"
        if key == "user"
        else "'req-' || CAST(user_id AS VARCHAR) || '-' || CAST((day(ts) - 1) // 3 AS VARCHAR)"
    )
    ts_txt = f"(CASE WHEN event_id % 109 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S') ELSE strftime(ts, {UTC_US}) END)"
    service = f"(CASE WHEN event_id % 101 = 0 THEN '   ' ELSE rpad({chain}[event_id % 5 + 1], 17, ' ') END)"
    level = (
        "(CASE WHEN event_id % 103 = 0 THEN 'NOTICE' ELSE rpad(CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'ERROR'"
        " WHEN event_type IN ('error', 'signup') THEN 'WARN' WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END, 5, ' ') END)"
    )
    rid_f = f"(CASE WHEN event_id % 113 = 0 THEN '   ' ELSE {rid} END)"
    msg = (
        "(CASE WHEN event_id % 127 = 0 THEN '   '"
        " WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'Gateway Timeout'"
        " WHEN event_type = 'error' AND event_id % 4 = 1 THEN 'context deadline exceeded'"
        " WHEN event_type = 'error' THEN 'Payment declined' ELSE 'Event ' || event_type END)"
    )
    lat = "(CASE WHEN event_id % 131 = 0 THEN 'latency=n/a' ELSE 'latency=' || CAST(CAST(floor(value * 4) AS BIGINT) AS VARCHAR) || 'ms' END)"
    raw = (
        f"CASE WHEN event_id % 107 = 0 THEN {ts_txt} || ' | cut off'"
        f" ELSE concat_ws(' | ', {ts_txt}, {service}, {level}, {rid_f}, {msg}, {lat}) END"
    )
    base = f"SELECT {raw} AS raw, event_id FROM events"
    return f"SELECT raw FROM ({base}) b UNION ALL SELECT raw FROM ({base}) b2 WHERE event_id % 10 = 0"


def rules_ctes(source: str, keys: list[str], threshold_ms: int = 500, prefix: str = "") -> str:
    """CTEs ``{prefix}ra``, ``{prefix}rr``, ``{prefix}evaluated``: rule results per ``keys`` group of ``source``."""
    chain = list(SERVICE_CHAIN)
    flags = ",\n  ".join(f"bool_or(service = '{s}') AS h{i}" for i, s in enumerate(chain))
    missing = ", ".join(f"CASE WHEN NOT h{i} THEN 'missing_hop({s})' END" for i, s in enumerate(chain))
    k = ", ".join(keys)
    return f"""{prefix}ra AS (SELECT {k}, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_lines,
  arg_min(ts_nanos, struct_pack(a := ts, b := ts_nanos, c := raw)) AS start_nanos,
  bool_or(level = 'ERROR') AS error_detected,
  arg_min(struct_pack(l := latency_ms, s := service), struct_pack(a := ts, b := ts_nanos, c := raw)) FILTER (WHERE latency_ms > {threshold_ms}) AS slow,
  bool_or(contains(lower(message), 'timeout') OR contains(lower(message), 'context deadline exceeded')) AS timeout_pattern,
  list_sort(list_distinct(list(service))) AS services,
  {flags}
  FROM {source} GROUP BY {k}),
{prefix}rr AS (SELECT *, CASE WHEN slow IS NOT NULL THEN 'high_latency(' || {_dur('slow.l')} || ' in ' || slow.s || ')' END AS high_latency,
  list_filter([{missing}], lambda x: x IS NOT NULL) AS missing_hops FROM {prefix}ra),
{prefix}evaluated AS (SELECT *, list_filter(list_concat([CASE WHEN error_detected THEN 'error_detected' END, high_latency], missing_hops,
  [CASE WHEN timeout_pattern THEN 'timeout_pattern' END]), lambda x: x IS NOT NULL) AS rules FROM {prefix}rr),"""


def base_ctes(key: str = "bucket", threshold_ms: int = 500, lines: str | None = None) -> str:
    return f"""
lines AS ({lines or lines_sql(key)}),
parts AS (SELECT raw, string_split(raw, ' | ') AS p FROM lines),
f AS (SELECT raw, len(p) AS np, {_tw('p[1]')} AS ts_text, {_tw('p[2]')} AS service, {_tw('p[3]')} AS level,
  {_tw('p[4]')} AS request_id, {_tw('p[5]')} AS message,
  CASE WHEN len(p) >= 6 THEN array_to_string(p[6:], ' | ') END AS lat_text FROM parts),
t AS (SELECT *,
  CASE WHEN regexp_full_match(ts_text, '{RFC3339}') AND NOT starts_with(ts_text, '0000')
       THEN TRY_CAST(replace(ts_text, ',', '.') AS TIMESTAMPTZ) END AS tsz,
  CAST(rpad(regexp_extract(ts_text, '[.,][0-9]{{6}}([0-9]{{1,3}})', 1), 3, '0') AS INTEGER) AS ts_nanos,
  regexp_extract(ts_text, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$', 1) AS tz_raw,
  CASE WHEN np >= 6 THEN {_latency('lat_text')} END AS latency_ms FROM f),
k AS (SELECT *, CASE WHEN np < 6 THEN 'fields' WHEN tsz IS NULL THEN 'timestamp'
  WHEN service = '' THEN 'service' WHEN level NOT IN ('INFO', 'WARN', 'ERROR', 'DEBUG') THEN 'level'
  WHEN request_id = '' THEN 'request_id' WHEN message = '' THEN 'message' END AS error_kind FROM t),
parsed AS (SELECT raw, error_kind,
  CASE error_kind
    WHEN 'fields' THEN printf('expected 6 pipe-delimited fields, got %d', np)
    WHEN 'timestamp' THEN 'parse timestamp: invalid RFC 3339 time "' || ts_text || '"'
    WHEN 'service' THEN 'missing service name' WHEN 'level' THEN 'invalid log level: ' || level
    WHEN 'request_id' THEN 'missing request ID' WHEN 'message' THEN 'missing message' END AS parse_error,
  (tsz AT TIME ZONE 'UTC') AS ts, ts_nanos,
  CASE WHEN tz_raw IN ('+00:00', '-00:00') THEN 'Z' ELSE tz_raw END AS tz_offset,
  service, level, request_id, message, latency_ms FROM k),
entries AS (SELECT * FROM parsed WHERE error_kind IS NULL),
{rules_ctes('entries', ['request_id'], threshold_ms)}
reports AS (SELECT *, array_to_string(rules, ', ') AS rules_text,
  CASE WHEN len(list_filter(rules, lambda r: contains(r, 'error') OR contains(r, 'timeout'))) > 0 THEN 'critical' ELSE 'warning' END AS fb_severity
  FROM evaluated WHERE len(rules) > 0),
fallback AS (SELECT request_id, 'Rule-based detection: ' || rules_text AS root_cause,
  'Investigate the flagged services. Consider adding circuit breakers and retries with backoff.' AS recommendation,
  fb_severity AS severity, start_ts, start_nanos FROM reports)"""


def _with(sql: str, key: str = "bucket") -> str:
    return "WITH " + base_ctes(key).strip() + "\n" + sql


def _spike_text(ts: str, threshold: int, window: str) -> str:
    return (
        f"'Catastrophic failure detected: > {threshold} errors occurred globally within {window} starting at ' || "
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') || '.'"
    )


SPIKE_REC = "'Immediate SEV-1. Check infrastructure health, recent deployments, or database connectivity immediately.'"

_ALERTS = """,
errs AS (SELECT DISTINCT request_id, raw, ts FROM entries WHERE level = 'ERROR'),
ec AS (SELECT ts, count(*) OVER (ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL '3599999999 microseconds' FOLLOWING) AS n FROM errs),
sp AS (SELECT min(ts) AS s FROM ec WHERE n > 3),
spike AS (SELECT 'GLOBAL_SYSTEM_SPIKE' AS request_id, """ + _spike_text("s", 3, "1 hour") + """ AS root_cause,
  """ + SPIKE_REC + """ AS recommendation, 'critical' AS severity, 0 AS grp, s AS start_ts, 0 AS start_nanos FROM sp WHERE s IS NOT NULL),
alerts AS (SELECT CAST(row_number() OVER (ORDER BY grp, start_ts, start_nanos, request_id) AS BIGINT) AS alert_pos,
  request_id, root_cause, recommendation, severity FROM (
    SELECT * FROM spike UNION ALL
    SELECT request_id, root_cause, recommendation, severity, 1 AS grp, start_ts, start_nanos FROM fallback))
"""

# The answers of the fixture, and a decode of their own: JSON functions and types, never the shape's number
# (json_valid lets a comma before a closing bracket pass, so that is checked apart).
_OBJ = """'{"root_cause": "Upstream fault for ' || rid || '", "recommendation": "Restart the failing pod", "severity": "' || sev || '"}'"""
_GOOD = "'{\"message\":' || to_json(struct_pack(content := obj))::VARCHAR || '}'"

_RESPONSES = f"""
keys AS (SELECT DISTINCT user_id, (day(ts) - 1) // 3 AS bucket FROM events),
k0 AS (SELECT user_id, (user_id + bucket) % 20 AS v, 'req-' || CAST(user_id AS VARCHAR) || '-' || CAST(bucket AS VARCHAR) AS rid,
  ['critical', 'warning', 'info'][user_id % 3 + 1] AS sev FROM keys),
k1 AS (SELECT *, {_OBJ} AS obj FROM k0 WHERE v <> 9),
k2 AS (SELECT *, CASE v WHEN 0 THEN obj WHEN 1 THEN '```json' || chr(10) || obj || chr(10) || '```' WHEN 2 THEN '```' || chr(10) || obj || chr(10) || '```'
  WHEN 3 THEN 'Sure! ' || obj || ' hope this helps' WHEN 4 THEN '{{"Root_Cause": "Upstream fault for ' || rid || '", "SEVERITY": "warning"}}'
  WHEN 5 THEN '{{"root_cause":null}}' WHEN 6 THEN '{{"root_cause":5}}'
  ELSE CASE WHEN user_id % 3 = 0 THEN '{{"root_cause": "x",}}' WHEN user_id % 3 = 1 THEN '{{"root_cause": "kept", "notes": {{"k": 1, "k": {{"k": 2}}}}}}' ELSE '{{"root_cause": "a"}} and {{"severity": "b"}}' END END AS content FROM k1),
answers AS (SELECT rid AS request_id, CASE WHEN v = 8 THEN 500 ELSE 200 END AS status, CASE v
  WHEN 8 THEN '{{"error": "internal server error"}}' WHEN 10 THEN '{{"choices":[{{"message":"hi"}}]}}' WHEN 11 THEN '{{"choices":[{{"message":5}}]}}'
  WHEN 12 THEN '{{"choices":[{{"message":[1]}}]}}' WHEN 13 THEN '{{"choices":[' || {_GOOD} || ',{{"message":"x"}}]}}' WHEN 14 THEN '{{"choices":"x"}}'
  WHEN 15 THEN '{{"choices":[{{"message":{{"content":{{"a":1}}}}}}]}}' WHEN 16 THEN '{{"choices":[7]}}' WHEN 17 THEN '{{"choices":{{"message":{{"content":"{{}}"}}}}}}'
  WHEN 18 THEN '{{"choices":[' || {_GOOD} || ',{{"message":{{"content":null}}}},null]}}' WHEN 19 THEN '[]'
  ELSE '{{"choices":[{{"message":' || to_json(struct_pack(content := content))::VARCHAR || '}}]}}' END AS body FROM k2),
env AS (SELECT *, CASE WHEN json_valid(body) THEN body::JSON END AS j FROM answers),
ch AS (SELECT *, coalesce(json_type(j) = 'OBJECT' AND json_type(j, '$.choices') = 'ARRAY' AND json_array_length(j, '$.choices') > 0
    AND len(list_filter(json_extract(j, '$.choices[*]'), lambda c: NOT (json_type(c) IN ('OBJECT', 'NULL')
      AND coalesce(json_type(c, '$.message'), 'NULL') IN ('OBJECT', 'NULL') AND coalesce(json_type(c, '$.message.content'), 'NULL') IN ('VARCHAR', 'NULL')))) = 0, false) AS env_ok,
  trim(coalesce(json_extract_string(j, '$.choices[0].message.content'), ''), ' ' || chr(10)) AS c0 FROM env),
cl AS (SELECT *, regexp_replace(regexp_replace(c0, '^```json|^```', ''), '```$', '') AS c1 FROM ch),
sp AS (SELECT *, CASE WHEN regexp_extract(c1, '(?s)\\{{.*\\}}') <> '' THEN regexp_extract(c1, '(?s)\\{{.*\\}}') ELSE c1 END AS c2 FROM cl),
ob AS (SELECT *, CASE WHEN json_valid(c2) AND NOT regexp_matches(c2, ',\\s*[}}\\]]') THEN c2::JSON END AS o FROM sp),
fl AS (SELECT *, list_filter(json_keys(o), lambda x: lower(x) = 'root_cause')[-1] AS k_rc, list_filter(json_keys(o), lambda x: lower(x) = 'recommendation')[-1] AS k_rec,
  list_filter(json_keys(o), lambda x: lower(x) = 'severity')[-1] AS k_sev FROM ob),
ty AS (SELECT *, status = 200 AND env_ok AND coalesce(json_type(o) = 'OBJECT', false) AND coalesce(json_type(o, '$.' || k_rc), 'NULL') IN ('VARCHAR', 'NULL')
  AND coalesce(json_type(o, '$.' || k_rec), 'NULL') IN ('VARCHAR', 'NULL') AND coalesce(json_type(o, '$.' || k_sev), 'NULL') IN ('VARCHAR', 'NULL') AS valid FROM fl),
expected AS (SELECT request_id, valid, CASE WHEN valid THEN coalesce(json_extract_string(o, '$.' || k_rc), '') END AS root_cause,
  CASE WHEN valid THEN coalesce(json_extract_string(o, '$.' || k_rec), '') END AS recommendation,
  CASE WHEN valid THEN coalesce(json_extract_string(o, '$.' || k_sev), '') END AS severity FROM ty)"""

NBSP = "chr(160)"
EDGE_LINES = f"""SELECT CASE event_id % 8
  WHEN 0 THEN s || '+05:30 | svc | INFO | ' || r || ' | offset | latency=1ms' WHEN 1 THEN s || ',25Z | svc | INFO | ' || r || ' | comma | latency=+2ms'
  WHEN 2 THEN s || '.123456789Z | svc | WARN | ' || r || ' | nine digits | latency=-3ms'
  WHEN 3 THEN {NBSP} || chr(9) || s || 'Z' || {NBSP} || ' |' || chr(9) || ' | ' || {NBSP} || 'svc' || {NBSP} || ' | DEBUG | ' || r || ' | m | 4'
  WHEN 4 THEN s || 'Z | ' || {NBSP} || 'svc' || chr(9) || ' | DEBUG' || chr(8195) || ' | ' || r || ' | padded' || {NBSP} || ' | latency=4ms'
  WHEN 5 THEN s || 'Z | svc | INFO | ' || r || ' | a | b | c | latency=5ms' WHEN 6 THEN s || ' | svc | INFO | ' || r || ' | no zone | latency=6ms'
  ELSE s || '-08:00 | svc | ERROR | ' || r || ' | minus | 7' END AS raw
  FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS s, 'edge-' || CAST(event_id AS VARCHAR) AS r FROM events)"""
LONG_LINES = """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' | order-service | INFO | long-' || CAST(event_id AS VARCHAR) || ' | long ' || repeat('x', CASE WHEN event_id % 5000 = 1 THEN 2097147 ELSE event_id % 41 END) || ' | latency=9ms' AS raw
  FROM events"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_entries"] = _with(
        f"SELECT request_id, strftime(ts, {UTC_US}) AS ts_utc, ts_nanos, tz_offset, service, level, message, latency_ms, raw FROM entries"
    )
    q["parse_rejects"] = _with("SELECT raw, error_kind, parse_error FROM parsed WHERE error_kind IS NOT NULL")
    kinds = ["line_too_long", "fields", "timestamp", "service", "level", "request_id", "message"]
    per_kind = ", ".join(f"CAST(count_if(error_kind = '{k}') AS BIGINT) AS rejected_{k}" for k in kinds)
    q["parse_stats"] = _with(
        "SELECT count(*) AS total_lines, CAST(count_if(error_kind IS NOT NULL) AS BIGINT) AS rejected_lines, "
        f"CAST(count_if(error_kind IS NULL) AS BIGINT) AS accepted_lines, {per_kind}, CAST(count_if(strlen(raw) >= 1048576) AS BIGINT) AS long_lines FROM parsed"
    )
    q["first_rejects"] = _with("SELECT raw, parse_error FROM parsed WHERE error_kind IS NOT NULL ORDER BY raw, parse_error LIMIT 5")
    q["dedup_entries"] = _with(f"SELECT DISTINCT request_id, raw, strftime(ts, {UTC_US}) AS ts_utc FROM entries")
    q["correlate_bounds"] = _with(
        f"SELECT request_id, strftime(min(ts), {UTC_US}) AS start_utc, strftime(max(ts), {UTC_US}) AS end_utc, "
        "CAST(count(DISTINCT raw) AS BIGINT) AS n_entries FROM entries GROUP BY request_id"
    )
    q["correlate_entries"] = _with(
        "SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ts, ts_nanos, raw) AS BIGINT) AS entry_pos, "
        f"strftime(ts, {UTC_US}) AS ts_utc, service, level, message, latency_ms FROM (SELECT DISTINCT * FROM entries) d"
    )
    q["group_order"] = _with(
        "SELECT request_id, CAST(row_number() OVER (ORDER BY start_ts, start_nanos, request_id) AS BIGINT) AS group_pos, "
        f"strftime(start_ts, {UTC_US}) AS start_utc FROM ra"
    )
    q["correlation_stats"] = _with("SELECT count(*) AS entries_read, count(DISTINCT request_id) AS request_groups FROM entries")
    q["rule_error"] = _with("SELECT request_id FROM evaluated WHERE error_detected")
    q["rule_high_latency"] = _with("SELECT request_id, high_latency AS rule FROM evaluated WHERE high_latency IS NOT NULL")
    q["rule_missing_hops"] = _with(
        "SELECT request_id, array_to_string(missing_hops, ', ') AS rule FROM evaluated WHERE len(missing_hops) > 0"
    )
    q["rule_timeout"] = _with("SELECT request_id FROM evaluated WHERE timeout_pattern")
    q["detect_reports"] = _with(
        "SELECT request_id, rules_text, printf('Request %s touched %d services [%s], triggered rules: %s', request_id, "
        "len(services), array_to_string(services, ', '), rules_text) AS summary, "
        f"strftime(start_ts, {UTC_US}) AS start_utc, strftime(end_ts, {UTC_US}) AS end_utc FROM reports"
    )
    q["detection_stats"] = _with(
        "SELECT count(*) AS total_groups, CAST(count_if(len(rules) > 0) AS BIGINT) AS anomalous_groups FROM evaluated"
    )
    chain_values = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SERVICE_CHAIN))
    q["service_chain_gaps"] = _with(
        f"SELECT r.request_id, c.service, c.hop FROM (SELECT DISTINCT request_id FROM entries) r "
        f"CROSS JOIN (VALUES {chain_values}) c(hop, service) "
        "WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.request_id = r.request_id AND e.service = c.service)"
    )
    spike_counts = (
        "WITH e AS (SELECT ts FROM events WHERE event_type = 'error'), "
        "c AS (SELECT ts, count(*) OVER (ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL '3599999999 microseconds' FOLLOWING) AS n FROM e) "
    )
    q["error_spikes"] = spike_counts + f"SELECT DISTINCT strftime(ts, {UTC_US}) AS start_utc, CAST(n AS BIGINT) AS errors_in_window FROM c WHERE n > 5"
    q["global_error_spike"] = spike_counts + (
        f", s AS (SELECT min(ts) AS s FROM c WHERE n > 10) SELECT 'GLOBAL_SYSTEM_SPIKE' AS request_id, {_spike_text('s', 10, '1 hour')} AS root_cause, "
        f"{SPIKE_REC} AS recommendation, 'critical' AS severity FROM s WHERE s IS NOT NULL"
    )
    q["diagnose_fallback"] = _with("SELECT request_id, root_cause, recommendation, severity FROM fallback")
    alerts_with = "WITH " + base_ctes("bucket").strip() + _ALERTS
    q["all_alerts"] = alerts_with + "SELECT * FROM alerts"
    q["alert_payload"] = alerts_with + (
        "SELECT alert_pos, CAST(to_json(struct_pack(request_id := request_id, root_cause := root_cause, "
        "recommendation := recommendation, severity := severity)) AS VARCHAR) AS payload FROM alerts"
    )
    # Arrays begin anew at every 1,499 bytes of payloads and commas, and around each alert that is longer.
    q["alert_payload_arrays"] = f"""WITH p AS ({q["alert_payload"]}),
s AS (SELECT *, strlen(payload) + 1 AS size, strlen(payload) + 1 > 1499 AS alone FROM p),
r AS (SELECT *, coalesce(sum(CASE WHEN alone THEN 0 ELSE size END) OVER (ORDER BY alert_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1499 AS cell,
  sum(alone::INT) OVER (ORDER BY alert_pos) AS lone FROM s)
SELECT min(alert_pos) AS first_pos, max(alert_pos) AS last_pos, count(*) AS n_alerts, '[' || string_agg(payload, ',' ORDER BY alert_pos) || ']' AS payload
FROM r GROUP BY lone, alone, cell"""
    q["write_alerts_document"] = q["all_alerts"]
    q["severity_summary"] = alerts_with + (
        "SELECT count(*) AS total, CAST(count_if(severity = 'critical') AS BIGINT) AS critical, CAST(count_if(severity = 'warning') AS BIGINT) AS warning, "
        "CAST(count_if(severity = 'info') AS BIGINT) AS info FROM alerts"
    )
    q["alert_view"] = alerts_with + (
        "SELECT alert_pos, request_id, request_id = 'GLOBAL_SYSTEM_SPIKE' AS is_spike, upper(severity) AS severity_label, "
        "CASE WHEN severity = 'critical' THEN 'critical' WHEN severity = 'warning' THEN 'warning' ELSE 'other' END AS severity_class FROM alerts"
    )
    q["build_prompts"] = "WITH " + base_ctes("user").strip() + f""",
d AS (SELECT DISTINCT * FROM entries),
rn AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts, ts_nanos, raw) AS rn,
  count(*) OVER (PARTITION BY request_id) AS n FROM d),
l AS (SELECT *, printf('  [%s] %s | %s | %s | latency=%dms', strftime(ts, '%Y-%m-%dT%H:%M:%S') || tz_offset, service, level, message, latency_ms) || {NL} AS line FROM rn),
g AS (SELECT request_id, any_value(n) AS n,
  coalesce(string_agg(line, '' ORDER BY rn) FILTER (WHERE n <= 50 OR rn <= 20), '') AS head,
  coalesce(string_agg(line, '' ORDER BY rn) FILTER (WHERE n > 50 AND rn > n - 30), '') AS tail
  FROM l GROUP BY request_id)
SELECT r.request_id,
  'Analyze the following anomalous request flow (request_id: ' || r.request_id || ').' || {NL} || {NL}
  || 'Triggered anomaly rules: ' || r.rules_text || {NL} || {NL}
  || 'Log entries (chronological):' || {NL} || g.head
  || CASE WHEN g.n > 50 THEN {NL} || '  ... [' || CAST(g.n - 50 AS VARCHAR) || ' logs omitted to fit token limits] ...' || {NL} || {NL} ELSE '' END
  || g.tail || {NL} || 'Provide root cause analysis, a recommended fix, and severity level.' AS prompt
FROM reports r JOIN g USING (request_id)"""
    system = SYSTEM_TEXT.replace("'", "''")
    q["stream_prompts"] = "WITH " + base_ctes("user").strip() + f""",
d AS (SELECT DISTINCT * FROM entries),
s1 AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 2 DAY, true) AS new_s FROM d WINDOW w AS (PARTITION BY request_id ORDER BY ts, ts_nanos, raw)),
s2 AS (SELECT *, sum(new_s::INT) OVER (PARTITION BY request_id ORDER BY ts, ts_nanos, raw ROWS UNBOUNDED PRECEDING) AS sid FROM s1),
{rules_ctes("s2", ["request_id", "sid"], prefix="ses_")}
rn AS (SELECT *, row_number() OVER (PARTITION BY request_id, sid ORDER BY ts, ts_nanos, raw) AS rn, count(*) OVER (PARTITION BY request_id, sid) AS n FROM s2),
l AS (SELECT *, printf('  [%s] %s | %s | %s | latency=%dms', strftime(ts, '%Y-%m-%dT%H:%M:%S') || tz_offset, service, level, message, latency_ms) || {NL} AS line FROM rn),
g AS (SELECT request_id, sid, any_value(n) AS n, coalesce(string_agg(line, '' ORDER BY rn) FILTER (WHERE n <= 12 OR rn <= 5), '') AS head,
  coalesce(string_agg(line, '' ORDER BY rn) FILTER (WHERE n > 12 AND rn > n - 4), '') AS tail FROM l GROUP BY request_id, sid)
SELECT r.request_id, strftime(r.start_ts, {UTC_US}) AS start_utc, CAST(g.n AS BIGINT) AS n_entries,
  'Analyze the following anomalous request flow (request_id: ' || r.request_id || ').' || {NL} || {NL}
  || 'Triggered anomaly rules: ' || array_to_string(r.rules, ', ') || {NL} || {NL}
  || 'Log entries (chronological):' || {NL} || g.head
  || CASE WHEN g.n > 12 THEN {NL} || '  ... [' || CAST(g.n - 12 AS VARCHAR) || ' logs omitted to fit token limits] ...' || {NL} || {NL} ELSE '' END
  || g.tail || {NL} || 'Provide root cause analysis, a recommended fix, and severity level.' AS prompt
FROM ses_evaluated r JOIN g USING (request_id, sid) WHERE len(r.rules) > 0"""
    q["build_requests"] = f"""WITH p AS ({q["build_prompts"]})
SELECT request_id, CAST(to_json(struct_pack(model := '{MODEL}',
  messages := [struct_pack(role := 'system', content := '{system}'), struct_pack(role := 'user', content := prompt)],
  temperature := 0.1)) AS VARCHAR) AS body FROM p"""
    q["parse_responses"] = "WITH " + _RESPONSES.strip() + "\nSELECT request_id, valid, root_cause, recommendation, severity FROM expected"
    q["diagnose_with_responses"] = "WITH " + base_ctes("bucket").strip() + "," + _RESPONSES + """
SELECT f.request_id,
  CASE WHEN coalesce(x.valid, false) THEN x.root_cause ELSE f.root_cause END AS root_cause,
  CASE WHEN coalesce(x.valid, false) THEN x.recommendation ELSE f.recommendation END AS recommendation,
  CASE WHEN coalesce(x.valid, false) THEN x.severity ELSE f.severity END AS severity
FROM fallback f LEFT JOIN expected x USING (request_id)"""
    q["stream_sessions"] = "WITH " + base_ctes("bucket").strip() + """,
ts_points AS (SELECT DISTINCT request_id, ts FROM entries),
s1 AS (SELECT request_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 10 SECOND THEN 1 ELSE 0 END AS new_s
  FROM ts_points WINDOW w AS (PARTITION BY request_id ORDER BY ts)),
sid AS (SELECT request_id, ts, sum(new_s) OVER (PARTITION BY request_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s1),
s2 AS (SELECT e.*, sid.sid FROM entries e JOIN sid USING (request_id, ts)),
""" + rules_ctes("s2", ["request_id", "sid"], prefix="ses_").rstrip(",") + f"""
SELECT request_id, strftime(start_ts, {UTC_US}) AS session_start,
  strftime(end_ts + INTERVAL 10 SECOND, {UTC_US}) AS session_end,
  array_to_string(rules, ', ') AS rules_text, CAST(n_lines AS BIGINT) AS n_lines FROM ses_evaluated"""
    q["stream_error_rate"] = "WITH " + base_ctes("bucket").strip() + f"""
SELECT strftime(ws, {UTC_US}) AS window_start, strftime(ws + INTERVAL 60 SECOND, {UTC_US}) AS window_end,
  count(*) AS errors, count(*) > 10 AS spike
FROM (SELECT date_trunc('second', e.ts) - to_seconds(k.k) AS ws
      FROM (SELECT DISTINCT * FROM entries) e, range(60) k(k) WHERE e.level = 'ERROR') w
GROUP BY ws"""
    q["stream_dedup"] = _with("SELECT DISTINCT request_id, raw FROM entries UNION ALL SELECT 'watermark-sentinel', strftime(max(ts) + INTERVAL 60 DAY, "
                              f"{UTC_US}) || ' | api-gateway | INFO | watermark-sentinel | end of replay | latency=0ms' FROM events")
    q["stream_rejects"] = q["parse_rejects"]
    # Batches by line length; a batch's watermark is the latest earlier event time less 20 days.
    late = "WITH " + base_ctes("bucket").strip() + """,
dealt AS (SELECT *, length(raw) % 3 AS batch_id FROM parsed),
tops AS (SELECT batch_id, max(ts) FILTER (WHERE error_kind IS NULL) AS t FROM dealt GROUP BY batch_id),
marks AS (SELECT b.k AS batch_id, max(t) - INTERVAL 20 DAY AS wm FROM range(3) b(k) LEFT JOIN tops ON tops.batch_id < b.k GROUP BY b.k),
judged AS (SELECT d.*, wm, error_kind IS NULL AND ts <= wm AS l0, error_kind IS NULL AND ts + INTERVAL 10 SECOND <= wm AS l1 FROM dealt d JOIN marks USING (batch_id))
"""
    q["stream_late_rows"] = late + f"""SELECT CAST(batch_id AS BIGINT) AS batch_id, operator, strftime(wm, {UTC_US}) AS watermark, request_id, raw
FROM (SELECT *, 'dedup' AS operator FROM judged WHERE l0 UNION ALL SELECT *, 'sessions' FROM judged WHERE l1)"""
    q["stream_landing_counters"] = late + """SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS total_lines, CAST(count_if(error_kind IS NULL) AS BIGINT) AS accepted_lines,
  CAST(count_if(error_kind IS NOT NULL) AS BIGINT) AS rejected_lines, CAST(count_if(l0) AS BIGINT) AS late_for_dedup, CAST(count_if(l1) AS BIGINT) AS late_for_sessions
FROM judged GROUP BY batch_id"""
    q["parse_edge_lines"] = "WITH " + base_ctes(lines=EDGE_LINES).strip() + (
        f" SELECT raw, error_kind, strftime(ts, {UTC_US}) AS ts_utc, CASE WHEN ts IS NOT NULL THEN ts_nanos END AS ts_nanos, "
        "CASE WHEN ts IS NOT NULL THEN tz_offset END AS tz_offset, service, level, request_id, message, latency_ms FROM parsed"
    )
    q["parse_long_lines"] = "WITH " + base_ctes(lines=LONG_LINES).strip() + " SELECT request_id, error_kind, CAST(length(message) AS BIGINT) AS message_chars, latency_ms FROM parsed"
    q["read_logs_lines"] = _with("SELECT raw FROM lines")
    q["read_logs_outcomes"] = _with(
        "SELECT kind, CAST(CASE WHEN kind = 'damaged' THEN 0 ELSE count(*) END AS BIGINT) AS n_lines, kind = 'damaged' AS failed "
        "FROM (SELECT ['plain', 'packed', 'damaged'][length(raw) % 3 + 1] AS kind FROM lines) GROUP BY kind"
    )
    q["stream_error_spikes"] = _with(
        f"SELECT DISTINCT strftime(ts, {UTC_US}) AS start_utc, n AS errors_in_window FROM (SELECT ts, count(*) OVER "
        "(ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL '3599999999 microseconds' FOLLOWING) AS n "
        "FROM (SELECT DISTINCT * FROM entries) WHERE level = 'ERROR') WHERE n > 3"
    )
    q["write_alerts_roundtrip"] = alerts_with + "SELECT request_id, root_cause, recommendation, severity, 'broken' AS failed_sinks FROM alerts"
    q["run_no_anomaly"] = (
        "SELECT 'no anomalies' AS status, CAST(5 * count(*) AS BIGINT) AS total_lines, count(DISTINCT event_id) AS total_groups, "
        "CAST(0 AS BIGINT) AS anomalous_groups, CAST(0 AS BIGINT) AS sinks_called FROM events"
    )
    q["error_spikes_default"] = (
        "WITH e AS (SELECT ts + to_seconds(5 * k) AS ts FROM events, range(12) r(k) WHERE event_type = 'error'), "
        "c AS (SELECT ts, count(*) OVER (ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL '59999999 microseconds' FOLLOWING) AS n FROM e) "
        f"SELECT DISTINCT strftime(ts, {UTC_US}) AS start_utc, CAST(n AS BIGINT) AS errors_in_window FROM c WHERE n > 10"
    )
    return q
