"""Registered queries: one per operator of the log-analysis pipeline.

Each query takes ``(spark, sf_dir)``, reads the driver's parquet tables, derives
the raw log lines / model responses from ``events`` with Spark (so the work
grows with the table) and returns flat columns (no arrays or structs), named as
in the DuckDB oracle SQL of :mod:`logweave.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.text import format_utc_micros
from logweave.operators.alerts import ALERT_COLUMNS, alert_payload, alert_payload_arrays, alert_rows, alert_view, assemble_alerts, severity_summary
from logweave.operators.correlate import (
    correlate,
    correlation_stats,
    dedup_entries,
    group_bounds,
    group_order,
)
from logweave.operators.diagnose import build_prompts, build_requests, diagnose, fallback_diagnose, parse_responses
from logweave.operators.parse import accepted, first_rejects, parse_lines, parse_stats, rejected
from logweave.operators.rules import detect, detection_stats, evaluate_rules, service_chain_gaps
from logweave.operators.spike import error_entries, error_spikes, global_error_spike
from logweave.params import Params
from logweave.plans.analysis import run
from logweave.plans.materialize import file_system, new_folder, write_table
from logweave.sources.fixtures import edge_lines, event_log_lines, long_lines, model_responses
from logweave.sources.logfiles import read_logs
from logweave.sources.sinks import write_alerts, write_alerts_document, write_alerts_json
from logweave.sources.tolerant import read_logs_tolerant
from logweave.streaming.landing import (
    default_reach,
    land_batch,
    land_logs,
    landed,
    landed_entries,
    landed_rejects,
    landing_counters,
    late_rows_table,
    on_time_entries,
    repaired_entries,
    repaired_error_rate,
    repaired_reports,
)
from logweave.streaming.live import stream_dedup, stream_entries, stream_error_rate, stream_reports
from logweave.streaming.prompts import stream_prompts
from logweave.streaming.spikes import rocksdb_state, stream_spikes

# Parameters of the registered queries (the oracle SQL uses the same values).
SPIKE_EVENTS_PARAMS = Params(spike_window=timedelta(hours=1), spike_threshold=5)
GLOBAL_SPIKE_PARAMS = Params(spike_window=timedelta(hours=1), spike_threshold=10)
SESSION_PARAMS = Params(correlation_window=timedelta(days=2), prompt_max_entries=12, prompt_head=5, prompt_tail=4)
ALERTS_PARAMS = Params(spike_window=timedelta(hours=1), spike_threshold=3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Derived log-line tables already written: (app id, folder, key) -> (version of events, path, schema).
_STAGED: dict[tuple[str, str, str], tuple[object, str, object]] = {}


def _version(spark: SparkSession, path: str) -> object:
    """Names, lengths and times of the files of a table."""
    fs, p = file_system(spark, path)
    found = fs.listStatus(p)
    return sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found)


def log_lines(spark: SparkSession, sf_dir: str, key: str = "bucket") -> DataFrame:
    """Raw log lines derived from ``events``, staged as a parquet table.

    The derivation runs once per application and version of the source files (a staging
    table in the checkpoint folder, like landed log files); every query reads the table
    and does its own work on it. Materializing also keeps the generator expression out
    of the parse plan. Production input comes from ``read_logs``.
    """
    cache_key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), key)
    version = _version(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    staged = _STAGED.get(cache_key)
    if staged:
        fs, p = file_system(spark, f"{staged[1]}/_SUCCESS")
        staged = staged if staged[0] == version and fs.exists(p) else None
    if not staged:
        lines = event_log_lines(table(spark, sf_dir, "events"), key=key).repartition("raw")
        staged = _STAGED[cache_key] = (version, write_table(lines, f"log-lines-{key}"), lines.schema)
    return spark.read.schema(staged[2]).parquet(staged[1])


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_responses(table(spark, sf_dir, "events"))


def _entries(spark, sf_dir, key="bucket") -> DataFrame:
    return accepted(parse_lines(log_lines(spark, sf_dir, key)))


# --------------------------------------------------------------------- parse

def q_parse_entries(spark, sf_dir):
    e = _entries(spark, sf_dir)
    return e.select(
        "request_id", format_utc_micros("ts").alias("ts_utc"), "ts_nanos", "tz_offset",
        "service", "level", "message", "latency_ms", "raw",
    )


def q_parse_rejects(spark, sf_dir):
    return rejected(parse_lines(log_lines(spark, sf_dir))).select("raw", "error_kind", "parse_error")


def q_parse_stats(spark, sf_dir):
    return parse_stats(parse_lines(log_lines(spark, sf_dir)))


def q_first_rejects(spark, sf_dir):
    return first_rejects(rejected(parse_lines(log_lines(spark, sf_dir)))).select("raw", "parse_error")


# --------------------------------------------------------------- correlation

def q_dedup_entries(spark, sf_dir):
    return dedup_entries(_entries(spark, sf_dir)).select("request_id", "raw", format_utc_micros("ts").alias("ts_utc"))


def q_correlate_bounds(spark, sf_dir):
    b = group_bounds(dedup_entries(_entries(spark, sf_dir)))
    return b.select(
        "request_id", format_utc_micros("start_ts").alias("start_utc"), format_utc_micros("end_ts").alias("end_utc"), "n_entries"
    )


def q_correlate_entries(spark, sf_dir):
    c = correlate(_entries(spark, sf_dir))
    return c.select(
        "request_id", "entry_pos", format_utc_micros("ts").alias("ts_utc"), "service", "level", "message", "latency_ms"
    )


def q_group_order(spark, sf_dir):
    g = group_order(group_bounds(_entries(spark, sf_dir)))
    return g.select("request_id", "group_pos", format_utc_micros("start_ts").alias("start_utc"))


def q_correlation_stats(spark, sf_dir):
    return correlation_stats(_entries(spark, sf_dir))


def q_parse_edge_lines(spark, sf_dir):
    """Rarer line shapes, one per event: accepted ones with their fields, rejects with their kind."""
    p = parse_lines(edge_lines(table(spark, sf_dir, "events")))
    return p.select("raw", "error_kind", format_utc_micros("ts").alias("ts_utc"), F.when(F.col("ts").isNotNull(), F.col("ts_nanos")).alias("ts_nanos"), "tz_offset", "service", "level", "request_id", "message", "latency_ms")


def q_parse_long_lines(spark, sf_dir):
    """Lines of more than 2 MiB, among short ones, are entries like all others."""
    p = parse_lines(long_lines(table(spark, sf_dir, "events")))
    return p.select("request_id", "error_kind", F.length("message").cast("bigint").alias("message_chars"), "latency_ms")


def q_read_logs_lines(spark, sf_dir):
    """Land lines as text files (some ended by CRLF, some blank, and a nested folder that is not read) and read them back."""
    base = new_folder(spark, "landed-logs")
    lines = log_lines(spark, sf_dir).select("raw", F.pmod(F.xxhash64("raw"), F.lit(3)).alias("k"))
    text = F.when(F.col("k") == 0, F.concat("raw", F.lit("\r"))).when(F.col("k") == 1, F.concat("raw", F.lit("\n\n\r"))).otherwise(F.col("raw"))
    lines.select(text.alias("value")).write.text(f"{base}/logs")
    lines.limit(1).select("raw").write.text(f"{base}/logs/nested")
    return read_logs(spark, f"{base}/logs", pattern="*.txt").select("raw")


def q_read_logs_outcomes(spark, sf_dir):
    """A folder of plain, packed and damaged files: lines and failures by kind of file."""
    base = new_folder(spark, "damaged-logs")
    fs, target = file_system(spark, f"{base}/logs")
    fs.mkdirs(target)
    for k, (kind, codec, suffix) in enumerate([("plain", "none", ".log"), ("packed", "gzip", ".log.gz"), ("damaged", "none", ".log.gz")]):
        part = log_lines(spark, sf_dir).where(F.length("raw") % 3 == k).select("raw")
        part.write.option("compression", codec).text(f"{base}/{kind}")
        files = [f.getPath() for f in fs.listStatus(file_system(spark, f"{base}/{kind}")[1]) if f.getPath().getName().startswith("part-")]
        for i, file in enumerate(files):  # the damaged ones are no gzip files, whatever their names say
            fs.rename(file, file_system(spark, f"{base}/logs/{kind}-{i}{suffix}")[1])
    _, outcomes = read_logs_tolerant(spark, f"{base}/logs", "*.log*")
    kind = F.regexp_extract("file", r"/([a-z]+)-\d+\.log[^/]*$", 1)
    return outcomes.groupBy(kind.alias("kind")).agg(F.sum("n_lines").alias("n_lines"), F.bool_and(F.col("error").isNotNull()).alias("failed"))


def q_run_no_anomaly(spark, sf_dir):
    """A whole run over requests that pass every hop quickly: counted, and nothing is written."""
    base = new_folder(spark, "quiet-run")
    chain = F.explode(F.array(*[F.lit(s) for s in Params().service_chain]))
    events = table(spark, sf_dir, "events").select("event_id", "ts", chain.alias("service"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.concat_ws(" | ", stamp, "service", F.lit("INFO"), F.concat(F.lit("calm-"), F.col("event_id").cast("string")), F.lit("fine"), F.lit("latency=3ms"))
    events.select(line.alias("value")).write.text(f"{base}/logs")
    done: list[str] = []
    out = run(spark, f"{base}/logs", {"any": lambda df: done.append("written")}, pattern="*.txt")
    stats = out["stats"]
    row = (out["status"], stats["parse"]["total_lines"], stats["detection"]["total_groups"], stats["detection"]["anomalous_groups"], len(done))
    return spark.createDataFrame([row], "status string, total_lines bigint, total_groups bigint, anomalous_groups bigint, sinks_called bigint")


# --------------------------------------------------------------------- rules

def _evaluated(spark, sf_dir, params=Params()):
    return evaluate_rules(_entries(spark, sf_dir), params)


def q_rule_error(spark, sf_dir):
    return _evaluated(spark, sf_dir).where("error_detected").select("request_id")


def q_rule_high_latency(spark, sf_dir):
    return _evaluated(spark, sf_dir).where(F.col("high_latency").isNotNull()).select("request_id", F.col("high_latency").alias("rule"))


def q_rule_missing_hops(spark, sf_dir):
    return (
        _evaluated(spark, sf_dir)
        .where(F.size("missing_hops") > 0)
        .select("request_id", F.array_join("missing_hops", ", ").alias("rule"))
    )


def q_rule_timeout(spark, sf_dir):
    return _evaluated(spark, sf_dir).where("timeout_pattern").select("request_id")


def q_detect_reports(spark, sf_dir):
    r = detect(_entries(spark, sf_dir))
    return r.select(
        "request_id",
        F.array_join("rules", ", ").alias("rules_text"),
        "summary",
        format_utc_micros("start_ts").alias("start_utc"),
        format_utc_micros("end_ts").alias("end_utc"),
    )


def q_detection_stats(spark, sf_dir):
    return detection_stats(_evaluated(spark, sf_dir))


def q_service_chain_gaps(spark, sf_dir):
    return service_chain_gaps(_entries(spark, sf_dir))


# --------------------------------------------------------------------- spike

def _event_errors(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("ts")


def q_error_spikes(spark, sf_dir):
    s = error_spikes(_event_errors(spark, sf_dir), SPIKE_EVENTS_PARAMS, tz_col=None)
    return s.select(format_utc_micros("start_ts").alias("start_utc"), "errors_in_window")


def q_error_spikes_default(spark, sf_dir):
    """Default window and threshold (60 s, more than 10): each event counts 12 times, 0 to 55 s late."""
    late = F.explode(F.sequence(F.lit(0), F.lit(55), F.lit(5)))
    errors = _event_errors(spark, sf_dir).select(F.col("ts").alias("t0"), late.alias("s"))
    errors = errors.select((F.col("t0") + F.make_dt_interval(secs=F.col("s").cast("decimal(18,6)"))).alias("ts"))
    s = error_spikes(errors, Params(), tz_col=None)
    return s.select(format_utc_micros("start_ts").alias("start_utc"), "errors_in_window")


def q_global_error_spike(spark, sf_dir):
    g = global_error_spike(_event_errors(spark, sf_dir), GLOBAL_SPIKE_PARAMS, tz_col=None)
    return g.select("request_id", "root_cause", "recommendation", "severity")


# ----------------------------------------------------------------- diagnosis

def q_diagnose_fallback(spark, sf_dir):
    return fallback_diagnose(detect(_entries(spark, sf_dir))).select("request_id", "root_cause", "recommendation", "severity")


def _alerts(spark, sf_dir):
    entries = _entries(spark, sf_dir)
    spike = global_error_spike(error_entries(entries), ALERTS_PARAMS)
    return assemble_alerts(spike, diagnose(detect(entries)))


def q_all_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


def q_alert_payload(spark, sf_dir):
    return alert_payload(_alerts(spark, sf_dir))


def q_alert_payload_arrays(spark, sf_dir):
    """Webhook bodies of at most 3,000 bytes."""
    return alert_payload_arrays(_alerts(spark, sf_dir), 3000)


def q_write_alerts_document(spark, sf_dir):
    """One JSON array of all alerts, written over an older file, and decoded again in its order."""
    path = f"{new_folder(spark, 'alerts-document')}/alerts.json"
    alerts = _alerts(spark, sf_dir)
    write_alerts_document(alerts.limit(0), path)
    write_alerts_document(alerts, path)
    text = spark.read.text(path, wholetext=True)
    fields = ", ".join(f"{c} string" for c in ALERT_COLUMNS)
    rows = text.select(F.posexplode(F.from_json("value", f"array<struct<{fields.replace(' string', ': string')}>>")).alias("i", "a"))
    return rows.select((F.col("i") + 1).cast("bigint").alias("alert_pos"), "a.*")


def q_severity_summary(spark, sf_dir):
    """Counts need no positions: the alerts are not ranked."""
    entries = _entries(spark, sf_dir)
    return severity_summary(alert_rows(global_error_spike(error_entries(entries), ALERTS_PARAMS), diagnose(detect(entries))))


def q_write_alerts_roundtrip(spark, sf_dir):
    """All alerts through the sink fan-out (one sink fails) into JSON files, twice (overwrite), and read back."""
    base = new_folder(spark, "alerts")
    rows = _alerts(spark, sf_dir)

    def broken(df):
        raise RuntimeError("sink down")

    for _ in range(2):
        results = write_alerts(rows, {"broken": broken, "file": lambda df: write_alerts_json(df, f"{base}/json")})
    back = spark.read.schema(rows.select(*ALERT_COLUMNS).schema).json(f"{base}/json")
    return back.withColumn("failed_sinks", F.lit(",".join(sorted(n for n, e in results.items() if e))))


def q_alert_view(spark, sf_dir):
    return alert_view(_alerts(spark, sf_dir)).select("alert_pos", "request_id", "is_spike", "severity_label", "severity_class")


def _prompts(spark, sf_dir):
    entries = _entries(spark, sf_dir, key="user")
    return build_prompts(entries, detect(entries))


def q_build_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir)


def q_build_requests(spark, sf_dir):
    return build_requests(_prompts(spark, sf_dir))


def q_parse_responses(spark, sf_dir):
    return parse_responses(responses(spark, sf_dir))


def q_diagnose_with_responses(spark, sf_dir):
    d = diagnose(detect(_entries(spark, sf_dir)), responses(spark, sf_dir))
    return d.select("request_id", "root_cause", "recommendation", "severity")


# ----------------------------------------------------------------- streaming

#: Micro-batches that the lines are dealt to, by their length, and the delay of the landed streams.
STREAM_BATCHES, STREAM_DELAY = 3, timedelta(days=20)


def _sentinel(spark, sf_dir):
    """A line sixty days after the last event (own request id, INFO), which moves the watermark past every window."""
    last = table(spark, sf_dir, "events").agg(F.max("ts").alias("t"))
    stamp = F.date_format(F.col("t") + F.expr("INTERVAL 60 DAYS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return last.select(F.concat(stamp, F.lit(" | api-gateway | INFO | watermark-sentinel | end of replay | latency=0ms")).alias("raw"))


def _landed(spark, sf_dir, name, delay, close=True):
    """All lines landed in micro-batches that arrive out of order (each spans the whole table), then the sentinel."""
    base = new_folder(spark, name)
    lines = log_lines(spark, sf_dir)
    batches = [lines.where(F.length("raw") % STREAM_BATCHES == k) for k in range(STREAM_BATCHES)]
    for k, batch in enumerate([*batches, _sentinel(spark, sf_dir)] if close else batches):
        land_batch(batch, k, base, Params(), delay, default_reach(Params()))
    return base


def _run_to_parquet(df, base, name="out"):
    q = (
        df.writeStream.format("parquet")
        .option("path", f"{base}/{name}")
        .option("checkpointLocation", f"{base}/{name}-state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")


def q_stream_late_rows(spark, sf_dir):
    """The side table: entries that come too late for an operator, by their batch's watermark."""
    late = late_rows_table(spark, _landed(spark, sf_dir, "late-rows", STREAM_DELAY, close=False))
    return late.select("batch_id", "operator", format_utc_micros("watermark").alias("watermark"), "request_id", "raw")


def q_stream_landing_counters(spark, sf_dir):
    """Counters of each landed batch, observed while it was written."""
    counters = landing_counters(spark, _landed(spark, sf_dir, "landing-counters", STREAM_DELAY, close=False))
    return counters.select("batch_id", "total_lines", "accepted_lines", "rejected_lines", "late_for_dedup", "late_for_sessions")


def q_stream_sessions(spark, sf_dir):
    """Landed lines -> session windows of what is on time (10 s gap) -> sessions of late requests repaired.

    The sentinel line closes every session; its own stays open.
    """
    base = _landed(spark, sf_dir, "stream-sessions", STREAM_DELAY)
    reports = stream_reports(on_time_entries(spark, base, "sessions"), delay=STREAM_DELAY, anomalous_only=False)
    closed = _run_to_parquet(reports.select("request_id", "session", "rules", "n_lines"), base)
    whole = repaired_reports(closed, landed_entries(spark, base), late_rows_table(spark, base), anomalous_only=False)
    return whole.select(
        "request_id",
        format_utc_micros("session.start").alias("session_start"),
        format_utc_micros("session.end").alias("session_end"),
        F.array_join("rules", ", ").alias("rules_text"),
        "n_lines",
    )


def q_stream_error_rate(spark, sf_dir):
    """Landed lines -> sliding error counts (1 minute windows, 1 second slide, spike when above 10), late
    errors added from the side table; a repeated line counts once."""
    base = _landed(spark, sf_dir, "stream-error-rate", STREAM_DELAY)
    on_time = on_time_entries(spark, base, "dedup")
    rates = _run_to_parquet(stream_error_rate(on_time, delay=STREAM_DELAY), base)
    counted = landed(spark, base).where("kind = 'entry' and level = 'ERROR' and not array_contains(late_for, 'dedup')")
    whole = repaired_error_rate(rates, counted, late_rows_table(spark, base))
    return whole.select(format_utc_micros("window_start").alias("window_start"), format_utc_micros("window_end").alias("window_end"), "errors", "spike")


def q_stream_dedup(spark, sf_dir):
    """Landed lines -> each line once among those on time -> late lines added from the side table."""
    base = _landed(spark, sf_dir, "stream-dedup", STREAM_DELAY)
    once = _run_to_parquet(stream_dedup(on_time_entries(spark, base, "dedup"), STREAM_DELAY), base)
    return repaired_entries(once, late_rows_table(spark, base)).select("request_id", "raw")


def _stream_text(spark, sf_dir, base, key):
    """All lines as text files for a file stream, three a core, and last a line 800 days ahead; returns how many make
    a micro-batch: two a core, so that two micro-batches read all."""
    cores = spark.sparkContext.defaultParallelism
    log_lines(spark, sf_dir, key).repartition(3 * cores).write.text(f"{base}/in")
    last = table(spark, sf_dir, "events").agg(F.date_format(F.max("ts") + F.expr("INTERVAL 800 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"))
    last.select(F.concat("t", F.lit(" | api-gateway | INFO | watermark-sentinel | end of replay | latency=0ms"))).write.mode("append").text(f"{base}/in")
    return 2 * cores


def q_stream_error_spikes(spark, sf_dir):
    """Exact spikes (1 hour, more than 3) of a stream over several micro-batches, each of which spans the table.

    The delay covers the table, so no line is late; a line that far ahead closes all windows.
    """
    base = new_folder(spark, "stream-spikes")
    files = _stream_text(spark, sf_dir, base, "bucket")
    entries, _ = stream_entries(spark, f"{base}/in", pattern="*.txt", max_files_per_trigger=files)
    with rocksdb_state(spark):
        spikes = _run_to_parquet(stream_spikes(entries, ALERTS_PARAMS, timedelta(days=400)), base)
    return spikes.select(format_utc_micros("start_ts").alias("start_utc"), "errors_in_window")


def q_stream_prompts(spark, sf_dir):
    """Prompts of the anomalous sessions (idle gap of two days) of a stream over several micro-batches, as they close."""
    base = new_folder(spark, "stream-prompts")
    files = _stream_text(spark, sf_dir, base, "user")
    entries, _ = stream_entries(spark, f"{base}/in", pattern="*.txt", max_files_per_trigger=files)
    with rocksdb_state(spark):
        prompts = _run_to_parquet(stream_prompts(entries, SESSION_PARAMS, timedelta(days=400)), base)
    return prompts.select("request_id", format_utc_micros("start_ts").alias("start_utc"), "n_entries", "prompt")


def q_stream_rejects(spark, sf_dir):
    """Text files read as a stream, two per micro-batch, landed with one parse; its rejects."""
    base = new_folder(spark, "stream-rejects")
    log_lines(spark, sf_dir).write.text(f"{base}/in")
    query = land_logs(spark, f"{base}/in", f"{base}/landed", pattern="*.txt", max_files_per_trigger=2)
    query.awaitTermination()
    return landed_rejects(spark, f"{base}/landed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_entries": q_parse_entries,
    "parse_rejects": q_parse_rejects,
    "parse_stats": q_parse_stats,
    "first_rejects": q_first_rejects,
    "dedup_entries": q_dedup_entries,
    "correlate_bounds": q_correlate_bounds,
    "correlate_entries": q_correlate_entries,
    "group_order": q_group_order,
    "correlation_stats": q_correlation_stats,
    "rule_error": q_rule_error,
    "rule_high_latency": q_rule_high_latency,
    "rule_missing_hops": q_rule_missing_hops,
    "rule_timeout": q_rule_timeout,
    "detect_reports": q_detect_reports,
    "detection_stats": q_detection_stats,
    "service_chain_gaps": q_service_chain_gaps,
    "error_spikes": q_error_spikes,
    "global_error_spike": q_global_error_spike,
    "diagnose_fallback": q_diagnose_fallback,
    "all_alerts": q_all_alerts,
    "alert_payload": q_alert_payload,
    "alert_payload_arrays": q_alert_payload_arrays,
    "write_alerts_document": q_write_alerts_document,
    "severity_summary": q_severity_summary,
    "alert_view": q_alert_view,
    "build_prompts": q_build_prompts,
    "build_requests": q_build_requests,
    "parse_responses": q_parse_responses,
    "diagnose_with_responses": q_diagnose_with_responses,
    "stream_sessions": q_stream_sessions,
    "stream_error_rate": q_stream_error_rate,
    "stream_dedup": q_stream_dedup,
    "stream_rejects": q_stream_rejects,
    "stream_late_rows": q_stream_late_rows,
    "stream_error_spikes": q_stream_error_spikes,
    "stream_prompts": q_stream_prompts,
    "stream_landing_counters": q_stream_landing_counters,
    "parse_edge_lines": q_parse_edge_lines,
    "parse_long_lines": q_parse_long_lines,
    "read_logs_lines": q_read_logs_lines,
    "read_logs_outcomes": q_read_logs_outcomes,
    "write_alerts_roundtrip": q_write_alerts_roundtrip,
    "run_no_anomaly": q_run_no_anomaly,
    "error_spikes_default": q_error_spikes_default,
}
