"""Global error spike: does any window ``[t, t + W)`` that starts at an error hold
more than ``threshold`` errors?

Exact, lazy and in one pass over the errors. Errors are first counted per microsecond
(map-side combine). The time line is cut into slices whose width divides ``W`` and is at
most ``SLICE``; a slice meets, in one task, its own instants and those of the slice that
lies ``W`` later, where its windows end. With running sums inside these two slices,

    count of [t, t + W) = own errors from t on + errors of the whole slices between
                          + errors of the later slice before t + W.

The middle term is a sum over slice totals (one small row a slice). So two exchanges carry
instants: one to count them, one to their slices (three narrow rows per instant); no range
sort, no window over the whole time line, and a hot minute is spread over its slices, whose
size is bounded by their width in microseconds. Slices around which fewer errors lie than a
spike needs are dropped before the sort. Sub-microsecond digits are ignored (timestamps are
microsecond values in Spark); repeated lines count once (dedup upstream).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.functions.text import format_rfc3339_seconds
from logweave.operators.correlate import dedup_entries
from logweave.params import SPIKE_REQUEST_ID, Params

#: Widest slice of the time line, in microseconds.
SLICE = 10_000_000

# Fixed texts of the spike alert.
SPIKE_RECOMMENDATION = (
    "Immediate SEV-1. Check infrastructure health, recent deployments, or database connectivity immediately."
)


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone.

    ``TIMESTAMP`` values are instants; ``TIMESTAMP_NTZ`` values are read as UTC wall time.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        day_us = F.unix_date(F.to_date(c)).cast("bigint") * 86_400_000_000
        tod_us = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000
        sec_us = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        return day_us + tod_us + sec_us
    return F.unix_micros(c)


def error_entries(entries: DataFrame) -> DataFrame:
    """ERROR entries, each distinct line once (filter first: the dedup shuffle only sees errors)."""
    return dedup_entries(entries.where(F.col("level") == "ERROR"))


def _window_text(window: timedelta) -> str:
    secs = int(window.total_seconds())
    if secs % 3600 == 0:
        n, unit = secs // 3600, "hour"
    elif secs % 60 == 0:
        n, unit = secs // 60, "minute"
    else:
        n, unit = secs, "second"
    return f"{n} {unit}" + ("" if n == 1 else "s")


def slices_per_window(w_us: int) -> int:
    """How many equal slices a window is cut into: the fewest of at most ``SLICE`` that divide it."""
    least = -(-w_us // SLICE)
    return next((n for n in range(least, 4 * least) if w_us % n == 0), 1)


def _floor_div(name: str, k: int) -> Column:
    """Whole division that rounds down, in integers."""
    return F.expr(f"({name} - pmod({name}, {k}L)) div {k}L")


def _per_microsecond(errors: DataFrame, width: int, ts_col: str, tz_col: str | None) -> DataFrame:
    tz = F.col(tz_col) if tz_col else F.lit("Z")
    points = errors.select(epoch_micros(errors, ts_col).alias("t"), tz.alias("_tz")).where("t is not null")
    per_us = points.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("_tz").alias("_tz"))
    return per_us.withColumn("s", _floor_div("t", width))


def _slice_totals(per_us: DataFrame, n_slices: int) -> DataFrame:
    """(s, total, any_tz, between, most): a slice's errors, those of the slices between it and the one a window later, and all three together.

    A block of ``n_slices`` slices meets the next block; its group has two rows per slice at most.
    """
    # The offset is read here too, so that both branches have the same microsecond counts and Spark makes them once.
    totals = per_us.groupBy("s").agg(F.sum("n").alias("total"), F.min("_tz").alias("any_tz"))
    block = _floor_div("s", n_slices)
    halo = totals.select("s", "total", "any_tz", F.explode(F.array(block, block - 1)).alias("block"))
    own = F.col("block") == block
    frame = Window.partitionBy("block").orderBy("s")
    if n_slices > 1:
        between = F.coalesce(F.sum("total").over(frame.rangeBetween(1, n_slices - 1)), F.lit(0))
    else:
        between = F.lit(0).cast("bigint")
    later = F.coalesce(F.sum("total").over(frame.rangeBetween(n_slices, n_slices)), F.lit(0))
    known = halo.select("s", "total", "any_tz", own.alias("own"), between.alias("between"), later.alias("later")).where("own")
    return known.select("s", "total", "any_tz", "between", (F.col("total") + F.col("between") + F.col("later")).alias("most"))


def window_counts(errors: DataFrame, window: timedelta, ts_col: str = "ts", tz_col: str | None = "tz_offset", above: int = 0) -> DataFrame:
    """For every distinct error instant ``t``: ``errors_in_window`` = errors in ``[t, t + window)``.

    Returns ``start_us, start_ts, start_tz, errors_in_window``; only counts above ``above``.
    """
    w_us = int(window / timedelta(microseconds=1))
    n_slices = slices_per_window(w_us)
    per_us = _per_microsecond(errors, w_us // n_slices, ts_col, tz_col)
    totals = _slice_totals(per_us, n_slices).where(F.col("most") > above)

    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    row = lambda s, later, at, kind, n, start: F.struct(
        s.alias("s"), F.lit(later).alias("later"), at.alias("at"), F.lit(kind).alias("kind"), n.alias("n"), start.alias("start_us"), F.col("_tz").alias("start_tz")
    )
    t, n, s = F.col("t"), F.col("n"), F.col("s")
    rows = per_us.select(F.inline(F.array(
        row(s, False, t, 1, n, t),  # an instant, in its own slice
        row(s, True, t + w_us, 0, zero, t),  # where its window ends, before the errors of that instant
        row(s - n_slices, True, t, 1, n, none),  # the instant again, for the windows that begin a window earlier
    )))
    # Placed by slice once: the join, the running sums and the sums by start all use this exchange.
    rows = rows.repartition("s").join(totals, "s")
    running = Window.partitionBy("s", "later").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("cum", F.sum("n").over(running)).where("start_us is not null")
    before = F.max(F.when(~F.col("later"), F.col("cum") - F.col("n")))
    ahead = F.max(F.when(F.col("later"), F.col("cum")))
    counted = summed.groupBy("s", "start_us").agg(
        F.coalesce(F.max("start_tz"), F.max("any_tz")).alias("start_tz"), (F.max("total") - before + F.max("between") + ahead).alias("errors_in_window")
    )
    return counted.where(F.col("errors_in_window") > above).select("start_us", F.timestamp_micros("start_us").alias("start_ts"), "start_tz", "errors_in_window")


def error_spikes(errors: DataFrame, params: Params = Params(), ts_col: str = "ts", tz_col: str | None = "tz_offset") -> DataFrame:
    """All window starts with more than ``spike_threshold`` errors."""
    return window_counts(errors, params.spike_window, ts_col, tz_col, above=params.spike_threshold)


def global_error_spike(errors: DataFrame, params: Params = Params(), ts_col: str = "ts", tz_col: str | None = "tz_offset") -> DataFrame:
    """The earliest qualifying window as one alert row (no row when there is none).

    Columns ``request_id, root_cause, recommendation, severity, start_ts``.
    """
    first = error_spikes(errors, params, ts_col, tz_col).agg(
        F.min(F.struct("start_us", "start_ts", "start_tz")).alias("s")
    ).where(F.col("s").isNotNull())
    started = format_rfc3339_seconds(F.col("s.start_ts"), F.col("s.start_tz"))
    root = F.format_string(
        f"Catastrophic failure detected: > %d errors occurred globally within {_window_text(params.spike_window)} starting at %s.",
        F.lit(params.spike_threshold), started,
    )
    return first.select(
        F.lit(SPIKE_REQUEST_ID).alias("request_id"),
        root.alias("root_cause"),
        F.lit(SPIKE_RECOMMENDATION).alias("recommendation"),
        F.lit("critical").alias("severity"),
        F.col("s.start_ts").alias("start_ts"),
    )
