"""Landing: one parse of a log stream into a table that keeps every line, late ones too.

``land_logs`` runs a stream with ``foreachBatch``. Each micro-batch is parsed once and
written in one job: entries, rejects and late entries side by side, its counters observed
on the way. Every row says for which stateful operators it comes too late (``late_for``),
by the batch's own watermark: the latest event time of the *earlier* batches less the
delay, the same rule Spark's operators use. A row is late for an operator once the last
moment at which the operator could still use it (event time + that operator's ``reach``)
is not after the watermark.

The stateful operators then read the landed rows that are on time for them
(``on_time_entries``). Whole batches appear at once, and no later watermark of theirs can
pass the one the rows were split by, so they drop nothing in silence: result + side table
(``late_rows_table``) hold everything, and the ``repaired_*`` functions make the batch
result of both.

Replays: a batch folder appears by one rename, with its counters inside. A batch that is
run again after a failure finds its folder and changes nothing.

Rejects are never late and do not move the watermark. A batch without accepted lines leaves
the watermark where it was; before the first accepted line there is none.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logweave.operators.correlate import dedup_entries
from logweave.operators.parse import ENTRY_COLUMNS, REJECT_COLUMNS, parse_lines, parse_stat_columns
from logweave.operators.rules import rule_columns, with_rules
from logweave.params import Params
from logweave.plans.materialize import file_system
from logweave.sources.logfiles import stream_logs

COUNTERS = "_counters.json"
LANDED = (
    "raw string, ts timestamp, ts_nanos int, tz_offset string, service string, level string, request_id string, message string, "
    "latency_ms bigint, error_kind string, parse_error string, late_for array<string>, watermark timestamp, batch_id bigint"
)


def micros(d: timedelta) -> int:
    return d // timedelta(microseconds=1)


def default_reach(params: Params) -> dict[str, timedelta]:
    """How long after its event time a row can still count: for dedup not at all, in a session up to the idle gap."""
    return {"dedup": timedelta(0), "sessions": params.correlation_window}


def late_for(watermark_us: int | None, reach: Mapping[str, timedelta]) -> Column:
    """Names of the operators for which a row comes too late."""
    none = F.array().cast("array<string>")
    if watermark_us is None:
        return none
    names = [F.when(F.unix_micros("ts") + micros(r) <= watermark_us, F.lit(name)) for name, r in reach.items()]
    return F.when(F.col("error_kind").isNotNull() | F.col("ts").isNull(), none).otherwise(F.filter(F.array(*names), lambda x: x.isNotNull()))


def _read_json(spark: SparkSession, path: str) -> dict:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    fs, p = file_system(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the landed batches."""
    fs, p = file_system(spark, f"{folder}/batches")
    if not fs.exists(p):
        return []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(p) if f.getPath().getName().startswith("batch_id="))


def land_batch(lines: DataFrame, batch_id: int, folder: str, params: Params, delay: timedelta, reach: Mapping[str, timedelta]) -> dict:
    """Parse and land one micro-batch of raw lines; returns its counters. Landing it again changes nothing."""
    spark = lines.sparkSession
    target = f"{folder}/batches/batch_id={batch_id}"
    fs, there = file_system(spark, target)
    if fs.exists(there):
        return _read_json(spark, f"{target}/{COUNTERS}")
    earlier = [b for b in _batches(spark, folder) if b < batch_id]
    before = _read_json(spark, f"{folder}/batches/batch_id={earlier[-1]}/{COUNTERS}") if earlier else {}
    seen = before.get("max_ts_us")
    watermark = None if seen is None else seen - micros(delay)

    parsed = parse_lines(lines.select("raw"), params)
    stamp = F.lit(None).cast("timestamp") if watermark is None else F.timestamp_micros(F.lit(watermark))
    rows = parsed.select("*", late_for(watermark, reach).alias("late_for"), stamp.alias("watermark"))
    obs = Observation()
    late = [F.count_if(F.array_contains("late_for", name)).alias(f"late_for_{name}") for name in reach]
    rows = rows.observe(obs, *parse_stat_columns(), *late, F.max(F.when(F.col("error_kind").isNull(), F.unix_micros("ts"))).alias("max_ts_us"))
    draft = f"{folder}/drafts/{batch_id}"
    rows.withColumn("kind", F.when(F.col("error_kind").isNull(), "entry").otherwise("reject")).write.mode("overwrite").partitionBy("kind").parquet(draft)
    counters = {"batch_id": batch_id, "watermark_us": watermark, **obs.get}
    known = [t for t in (seen, counters["max_ts_us"]) if t is not None]
    counters["max_ts_us"] = max(known, default=None)
    _write_json(spark, f"{draft}/{COUNTERS}", counters)
    fs.mkdirs(there.getParent())
    if not fs.rename(file_system(spark, draft)[1], there):
        raise OSError(f"batch {batch_id} could not be moved to {target}")
    return counters


def land_logs(
    spark: SparkSession, path: str, folder: str, params: Params = Params(), delay: timedelta = timedelta(seconds=10),
    reach: Mapping[str, timedelta] | None = None, pattern: str = "*.log", max_files_per_trigger: int | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Start landing the files that appear in ``path`` under ``folder`` (on shared storage)."""
    lines = stream_logs(spark, path, pattern=pattern, max_files_per_trigger=max_files_per_trigger)
    reach = default_reach(params) if reach is None else reach
    writer = lines.writeStream.foreachBatch(lambda batch, n: land_batch(batch, n, folder, params, delay, reach) and None)
    return writer.option("checkpointLocation", f"{folder}/state").trigger(**(trigger or {"availableNow": True})).start()


# ------------------------------------------------------------------- readers

def landed(spark: SparkSession, folder: str) -> DataFrame:
    """Every landed line, with ``kind`` (entry, reject), ``late_for``, ``watermark`` and ``batch_id``."""
    return spark.read.schema(LANDED + ", kind string").option("basePath", f"{folder}/batches").parquet(f"{folder}/batches/batch_id=*")


def landed_entries(spark: SparkSession, folder: str) -> DataFrame:
    return landed(spark, folder).where("kind = 'entry'").select(*ENTRY_COLUMNS)


def landed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return landed(spark, folder).where("kind = 'reject'").select(*REJECT_COLUMNS)


def late_rows_table(spark: SparkSession, folder: str) -> DataFrame:
    """The side table: one row per late entry and operator it is too late for."""
    late = landed(spark, folder).where("kind = 'entry' and size(late_for) > 0")
    return late.select("batch_id", "watermark", F.explode("late_for").alias("operator"), *ENTRY_COLUMNS)


def landing_counters(spark: SparkSession, folder: str) -> DataFrame:
    """One row of counters per landed batch (a driver-side list: one short record a batch)."""
    rows = [_read_json(spark, f"{folder}/batches/batch_id={b}/{COUNTERS}") for b in _batches(spark, folder)]
    names = list(rows[0]) if rows else ["batch_id"]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} bigint" for n in names))


def on_time_entries(spark: SparkSession, folder: str, operator: str) -> DataFrame:
    """Stream of the landed entries that are on time for ``operator``, which must have at least the landing's delay.

    No limit of files per trigger: a batch must not be split, or its own later half could
    fall behind the watermark of its first.
    """
    rows = spark.readStream.schema(LANDED + ", kind string").option("basePath", f"{folder}/batches").parquet(f"{folder}/batches/batch_id=*")
    return rows.where((F.col("kind") == "entry") & ~F.array_contains("late_for", operator)).select(*ENTRY_COLUMNS)


# -------------------------------------------------------------------- repair

def repaired_entries(result: DataFrame, late: DataFrame) -> DataFrame:
    """Stream-deduplicated entries and the late ones: the batch ``dedup_entries``."""
    own = late.where("operator = 'dedup'").select(*ENTRY_COLUMNS)
    return dedup_entries(result.select(*ENTRY_COLUMNS).unionByName(own))


def batch_sessions(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """Every session of ``entries`` with its rules: the batch form of ``stream_reports``."""
    gap = f"{micros(params.correlation_window)} microseconds"
    agg = entries.groupBy(F.session_window("ts", gap).alias("session"), "request_id").agg(*rule_columns(params), F.count(F.lit(1)).alias("n_lines"))
    return with_rules(agg, params, keep=("session", "n_lines"))


def repaired_reports(reports: DataFrame, entries: DataFrame, late: DataFrame, params: Params = Params(), anomalous_only: bool = True) -> DataFrame:
    """Sessions of a stream with those of late requests made anew from the landed ``entries``.

    Only requests with a late row are read again; all other rows of ``reports`` stay.
    """
    ids = late.where("operator = 'sessions'").select("request_id").distinct()
    again = batch_sessions(entries.join(ids, "request_id", "left_semi"), params)
    again = again.where(F.size("rules") > 0) if anomalous_only else again
    return reports.join(ids, "request_id", "left_anti").unionByName(again.select(*reports.columns))


def repaired_error_rate(rates: DataFrame, result: DataFrame, late: DataFrame, params: Params = Params(), slide: timedelta = timedelta(seconds=1)) -> DataFrame:
    """Sliding error counts with the late errors that ``result`` (the stream's deduplicated entries) does not hold."""
    own = late.where("operator = 'dedup' and level = 'ERROR'").select("request_id", "raw", "ts").distinct()
    new = own.join(result.select("request_id", "raw"), ["request_id", "raw"], "left_anti")
    window = F.window("ts", f"{micros(params.spike_window)} microseconds", f"{micros(slide)} microseconds")
    more = new.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("errors")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "errors")
    both = rates.select("window_start", "window_end", "errors").unionByName(more).groupBy("window_start", "window_end").agg(F.sum("errors").alias("errors"))
    return both.withColumn("spike", F.col("errors") > params.spike_threshold)


# ------------------------------------------------------------------ counters

class DroppedRows(StreamingQueryListener):
    """Adds up, per query, the rows that stateful operators dropped as too late, over all its batches.

    ``query.recentProgress`` keeps the last batches only; a listener sees them all.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
