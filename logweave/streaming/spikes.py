"""Exact error spikes on a stream: every window ``[t, t + W)`` that starts at an error.

Sliding windows of Spark are clock-aligned and miss a spike between two slide steps. Here a
``transformWithState`` operator keeps the errors themselves, counted per microsecond. The
time line is cut into buckets of one window length; an error goes to its own bucket and to
the one before, whose windows may reach it. A bucket's timer is set for the moment after
which no window that starts in it can grow; when the watermark passes it, all its windows
are counted in one sorted pass, those above the threshold are emitted, and the bucket's
state is removed. So state is at most two window lengths plus the watermark's delay, as
counts per microsecond in blocks of a second; a repeated line counts once (dedup before,
errors only).

The operator needs ``spark.sql.streaming.stateStore.providerClass`` to be Spark's RocksDB
provider; :func:`rocksdb_state` sets it around the start of a query where the session does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logweave.params import Params
from logweave.session import ship_package

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SECOND = 1_000_000
FOUND = "start_us bigint, start_tz string, errors_in_window bigint"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside the block keep their state in RocksDB; the setting is put back after it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def merged(t: np.ndarray, n: np.ndarray, tz: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal instants as one: their counts added, the smallest offset text."""
    order = np.lexsort((tz, t))
    t, n, tz = t[order], n[order], tz[order]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    return t[first], np.add.reduceat(n, first), tz[first]


def qualifying(t: np.ndarray, n: np.ndarray, tz: np.ndarray, start: int, w_us: int, threshold: int) -> pd.DataFrame:
    """Windows that start in ``[start, start + w_us)`` with more than ``threshold`` errors; instants are sorted and distinct."""
    before = np.concatenate([[0], np.cumsum(n)])
    count = before[np.searchsorted(t, t + w_us)] - before[:-1]
    own = (t < start + w_us) & (count > threshold)
    return pd.DataFrame({"start_us": t[own], "start_tz": [x.decode() for x in tz[own]], "errors_in_window": count[own]})


class SpikeWindows(StatefulProcessor):
    """State of a bucket: second -> its instants, counts and offsets, packed."""

    def __init__(self, w_us: int, threshold: int):
        self.w_us, self.threshold = w_us, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getMapState("seconds", "second bigint", "t binary, n binary, tz binary")

    def _held(self, row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.int64), np.frombuffer(row[2], "S6")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            t = batch["t"].to_numpy(np.int64)
            tz = np.array(batch["tz"].tolist(), "S6")
            t, n, tz = merged(t, np.ones(len(t), np.int64), tz)
            second = t // SECOND
            edges = np.flatnonzero(np.concatenate([[True], second[1:] != second[:-1], [True]]))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                name, own = (int(second[lo]),), (t[lo:hi], n[lo:hi], tz[lo:hi])
                if self.seconds.containsKey(name):
                    own = merged(*(np.concatenate(x) for x in zip(self._held(self.seconds.getValue(name)), own)))
                self.seconds.updateValue(name, tuple(x.tobytes() for x in own))
        # The last microsecond that counts for this bucket lies before the end of the next one.
        self.handle.registerTimer(-(-(int(key[0]) + 2) * self.w_us // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [self._held(row) for row in self.seconds.values()]
        self.seconds.clear()
        if held:
            t, n, tz = merged(*(np.concatenate(x) for x in zip(*held)))
            found = qualifying(t, n, tz, int(key[0]) * self.w_us, self.w_us, self.threshold)
            if len(found):
                yield found


def stream_spikes(entries: DataFrame, params: Params = Params(), delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """All window starts with more than ``spike_threshold`` errors: the rows of the batch ``error_spikes``, once the
    watermark has passed them (append mode). Late lines are dropped; land the stream first to keep them."""
    ship_package(entries.sparkSession)
    w_us = int(params.spike_window / timedelta(microseconds=1))
    is_error = F.when(F.col("ts").isNotNull(), F.col("level") == "ERROR")  # stays above the watermark, which sees all lines
    watched = entries.withWatermark("ts", f"{int(delay / timedelta(microseconds=1))} microseconds")
    errors = watched.where(is_error).dropDuplicatesWithinWatermark(["request_id", "raw"])
    rows = errors.select("ts", F.unix_micros("ts").alias("t"), F.col("tz_offset").alias("tz"))
    bucket = F.expr(f"(t - pmod(t, {w_us}L)) div {w_us}L")
    dealt = rows.select("ts", "t", "tz", F.explode(F.array(bucket, bucket - 1)).alias("bucket"))
    found = dealt.groupBy("bucket").transformWithStateInPandas(SpikeWindows(w_us, params.spike_threshold), FOUND, "append", "EventTime")
    return found.select("start_us", F.timestamp_micros("start_us").alias("start_ts"), "start_tz", "errors_in_window")
