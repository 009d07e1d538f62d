"""Structured Streaming forms of the pipeline.

* ``stream_entries`` - a log directory as a stream of parsed entries (stateless;
  the same ``parse_lines`` as in batch) plus the reject stream.
* ``stream_dedup`` - repeated lines dropped within the watermark.
* ``stream_reports`` - request flows closed after an idle gap (session windows),
  evaluated with the same rule aggregates as the batch ``detect``.
* ``stream_alerts`` - rule-based diagnoses of closed anomalous flows, ready for
  any streaming sink (the batch ``diagnose`` applied to each closed session).
* ``stream_error_rate`` - per-window error counts and a spike flag (sliding
  windows).

Late data: rows older than the watermark are dropped by the stateful operators;
``late_rows`` says how many a query dropped over its kept progress reports. To keep late
rows, land the stream first (:mod:`logweave.streaming.landing`) and run these operators on
what is on time; the side table and the ``repaired_*`` functions give the exact result. On a cluster set
``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition=true``: sessions
of a hot request id then merge before the shuffle. Sliding windows are clock-aligned, so ``stream_error_rate``
approximates the exact batch spike (a window starting between slide steps is not
evaluated); run ``logweave.operators.spike`` on landed entries for the exact answer.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.diagnose import fallback_columns
from logweave.operators.parse import accepted, parse_lines, rejected
from logweave.operators.rules import rule_columns, with_rules
from logweave.params import Params
from logweave.sources.logfiles import stream_logs


def _interval(d: timedelta) -> str:
    us = int(d / timedelta(microseconds=1))
    return f"{us} microseconds"


def stream_entries(
    spark: SparkSession, path: str, params: Params = Params(), max_files_per_trigger: int | None = None, pattern: str = "*.log"
) -> tuple[DataFrame, DataFrame]:
    """``(entries, rejects)`` streams from a directory that receives ``pattern`` files."""
    parsed = parse_lines(stream_logs(spark, path, pattern=pattern, max_files_per_trigger=max_files_per_trigger), params)
    return accepted(parsed), rejected(parsed)


def stream_dedup(entries: DataFrame, delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Drop a line already seen for the same request within the watermark delay."""
    return entries.withWatermark("ts", _interval(delay)).dropDuplicatesWithinWatermark(["request_id", "raw"])


def stream_reports(entries: DataFrame, params: Params = Params(), delay: timedelta = timedelta(seconds=10), anomalous_only: bool = True) -> DataFrame:
    """Request flows closed after ``params.correlation_window`` without a new entry.

    Emitted (append mode) once the watermark passes the session end. The rule
    aggregates ignore repeated lines, so no dedup state is needed here.
    """
    agg = (
        entries.withWatermark("ts", _interval(delay))
        .groupBy(F.session_window("ts", _interval(params.correlation_window)).alias("session"), "request_id")
        .agg(*rule_columns(params), F.count(F.lit(1)).alias("n_lines"))
    )
    reports = with_rules(agg, params, keep=("session", "n_lines"))
    return reports.where(F.size("rules") > 0) if anomalous_only else reports


def stream_alerts(entries: DataFrame, params: Params = Params(), delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Rule-based alerts for anomalous flows as their sessions close (append mode).

    Columns ``request_id, root_cause, recommendation, severity, session_start,
    session_end``; a request id that becomes active again after an idle gap gets
    one alert per flow.
    """
    reports = stream_reports(entries, params, delay, anomalous_only=True)
    return reports.select(
        "request_id",
        *fallback_columns(F.col("rules")),
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
    )


def stream_error_rate(entries: DataFrame, params: Params = Params(), slide: timedelta = timedelta(seconds=1), delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """ERROR counts per sliding window ``[start, start + spike_window)``; ``spike`` when above the threshold.

    A repeated line counts once, as in batch.
    """
    # Every line (not only errors) must advance event time, so that windows close
    # after a stretch without errors. Catalyst pushes filters that do not reference
    # the event-time column below the watermark operator; a single predicate over
    # ``ts`` stays above it.
    is_error = F.when(F.col("ts").isNotNull(), F.col("level") == "ERROR")
    # Errors only are remembered for dedup: the filter stands between watermark and state.
    errors = entries.withWatermark("ts", _interval(delay)).where(is_error).dropDuplicatesWithinWatermark(["request_id", "raw"])
    counts = errors.groupBy(F.window("ts", _interval(params.spike_window), _interval(slide)).alias("w")).agg(
        F.count(F.lit(1)).alias("errors")
    )
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "errors",
        (F.col("errors") > F.lit(params.spike_threshold)).alias("spike"),
    )


def late_rows(query) -> int:
    """Rows that the stateful operators of a streaming query dropped as too late, over its kept progress reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
