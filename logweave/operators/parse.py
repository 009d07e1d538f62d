"""Parse raw log lines into entries, with a quarantine for rejects.

Line format: ``ts | service | level | request_id | message | latency=NNms``.
Parsing is a pure projection (no shuffle): one ``CASE`` chain decides the first
failing check, in the order line length (only when a limit is set), field count, timestamp, service, level,
request id, message. Latency never rejects a line (bad values become 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import parse_latency_ms, parse_rfc3339, trim_space
from logweave.params import VALID_LEVELS, Params

SEPARATOR_RE = r" \| "

ENTRY_COLUMNS = ["ts", "ts_nanos", "tz_offset", "service", "level", "request_id", "message", "latency_ms", "raw"]
REJECT_COLUMNS = ["raw", "error_kind", "parse_error"]


def parse_lines(df: DataFrame, params: Params = Params(), raw_col: str = "raw") -> DataFrame:
    """Add parsed columns plus ``error_kind`` / ``parse_error`` (NULL when accepted).

    Extra input columns (for example ``source_file``) are kept. The projection is
    staged so that every field is split, trimmed and parsed exactly once.
    """
    extra = [c for c in df.columns if c not in (raw_col, "line_bytes")]
    line_bytes = F.col("line_bytes") if "line_bytes" in df.columns else F.octet_length(raw_col)
    split = df.select(
        *extra,
        F.col(raw_col).alias("raw"),
        line_bytes.alias("_bytes"),
        F.split(F.col(raw_col), SEPARATOR_RE, 6).alias("_parts"),
    )
    part = lambda i: F.get(F.col("_parts"), i)  # noqa: E731  (NULL when absent, ANSI-safe)
    fields = split.select(
        *extra, "raw", "_bytes",
        F.size("_parts").alias("_n"),
        trim_space(part(0)).alias("_ts_text"),
        trim_space(part(1)).alias("service"),
        trim_space(part(2)).alias("level"),
        trim_space(part(3)).alias("request_id"),
        trim_space(part(4)).alias("message"),
        part(5).alias("_latency_text"),
    )
    typed = fields.select(
        *extra, "raw", "_bytes", "_n", "_ts_text", "service", "level", "request_id", "message",
        parse_rfc3339("_ts_text").alias("_t"),
        F.when(F.col("_n") >= 6, parse_latency_ms("_latency_text")).alias("latency_ms"),
    )
    too_long = F.lit(False) if params.max_line_bytes is None else F.col("_bytes") >= params.max_line_bytes
    kind = (
        F.when(too_long, F.lit("line_too_long"))
        .when(F.col("_n") < 6, F.lit("fields"))
        .when(F.col("_t.ts").isNull(), F.lit("timestamp"))
        .when(F.col("service") == "", F.lit("service"))
        .when(~F.col("level").isin(*VALID_LEVELS), F.lit("level"))
        .when(F.col("request_id") == "", F.lit("request_id"))
        .when(F.col("message") == "", F.lit("message"))
    )
    checked = typed.select("*", kind.alias("error_kind"))
    k = F.col("error_kind")
    error = (
        F.when(k == "line_too_long", F.lit(f"line exceeds {(params.max_line_bytes or 0) - 1} bytes"))
        .when(k == "fields", F.format_string("expected 6 pipe-delimited fields, got %d", F.col("_n")))
        .when(k == "timestamp", F.concat(F.lit('parse timestamp: invalid RFC 3339 time "'), F.col("_ts_text"), F.lit('"')))
        .when(k == "service", F.lit("missing service name"))
        .when(k == "level", F.concat(F.lit("invalid log level: "), F.col("level")))
        .when(k == "request_id", F.lit("missing request ID"))
        .when(k == "message", F.lit("missing message"))
    )
    out = checked.select(
        *extra,
        "raw",
        F.col("_t.ts").alias("ts"),
        F.col("_t.ts_nanos").alias("ts_nanos"),
        F.col("_t.tz_offset").alias("tz_offset"),
        "service", "level", "request_id", "message", "latency_ms",
        "error_kind",
        error.alias("parse_error"),
    )
    # Optimizer barrier: Catalyst would push a later filter (accepted / rejected)
    # below these projections and inline the parse into it, running it twice.
    # A filter on generated columns stays above a Generate; inline() of a
    # one-element array emits each row once, inside the same codegen stage.
    return out.select(F.inline(F.array(F.struct(*out.columns))))


def accepted(parsed: DataFrame) -> DataFrame:
    extra = [c for c in parsed.columns if c not in ENTRY_COLUMNS + REJECT_COLUMNS[1:]]
    # Filter on the kind, not the message: Catalyst pushes the predicate below the
    # staged projections and inlines it; the kind references every field once.
    return parsed.where(F.col("error_kind").isNull()).select(*ENTRY_COLUMNS, *extra)


def rejected(parsed: DataFrame) -> DataFrame:
    extra = [c for c in parsed.columns if c not in ENTRY_COLUMNS + REJECT_COLUMNS[1:]]
    return parsed.where(F.col("error_kind").isNotNull()).select(*REJECT_COLUMNS, *extra)


def parse_logs(df: DataFrame, params: Params = Params(), raw_col: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Return ``(entries, rejects)``; both read the same lazy projection."""
    parsed = parse_lines(df, params, raw_col)
    return accepted(parsed), rejected(parsed)


#: Lines of this length are counted (not refused) by :func:`parse_stats`.
LONG_LINE_BYTES = 1 << 20
REJECT_KINDS = ["line_too_long", "fields", "timestamp", "service", "level", "request_id", "message"]


def parse_stat_columns() -> list[Column]:
    """Counters of :func:`parse_stats`, usable in ``agg`` or ``DataFrame.observe``."""
    bad = F.col("error_kind").isNotNull()
    return [
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(bad).alias("rejected_lines"),
        F.count_if(~bad).alias("accepted_lines"),
        *[F.count_if(F.col("error_kind") == k).alias(f"rejected_{k}") for k in REJECT_KINDS],
        F.count_if(F.octet_length("raw") >= LONG_LINE_BYTES).alias("long_lines"),
    ]


def parse_stats(parsed: DataFrame) -> DataFrame:
    """One row: lines read, lines rejected, lines accepted, and rejects per kind."""
    return parsed.agg(*parse_stat_columns())


def first_rejects(rejects: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` reject messages (the console shows five); ordered by line text.

    A top-n: Spark plans it as ``TakeOrderedAndProject`` (per-partition top-n, then merge).
    """
    return rejects.orderBy("raw", "parse_error").limit(n)

