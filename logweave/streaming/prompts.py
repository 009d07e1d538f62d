"""Prompts of request flows as their sessions close.

A session of a request ends after the idle gap. While it is open its state is bounded,
whatever the number of its entries: the first ``prompt_max_entries`` and the last
``prompt_tail`` entry lines, the number of distinct lines (repeats are dropped before, within
the watermark), the entry that decides the latency rule, flags, and the names of its
services. Entries may come in any order within the watermark's delay; a late-arriving entry
can join two sessions, whose states merge like their entries would. When the watermark
passes a session's end its rules and prompt are made by the batch operators' expressions,
so they are those of :func:`logweave.operators.diagnose.build_prompts` over its entries.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logweave.operators.diagnose import entry_line, prompt_text
from logweave.operators.rules import with_rules
from logweave.params import Params
from logweave.session import ship_package

CLOSED = (
    "request_id string, start_us bigint, start_nanos int, start_raw string, start_tz string, end_us bigint, end_nanos int, end_raw string, end_tz string, "
    "n_entries bigint, head array<string>, tail array<string>, error_detected boolean, timeout_pattern boolean, slow_ms bigint, slow_service string, services array<string>"
)


class OpenSessions:
    """The open sessions of a request, by time; an entry is ``[us, nanos, raw, tz, line]``."""

    def __init__(self, gap_us: int, head: int, tail: int, sessions: list[dict] | None = None):
        self.gap_us, self.head, self.tail, self.sessions = gap_us, head, tail, sessions or []

    def _merged(self, a: dict, b: dict) -> dict:
        slow = [x for x in (a["slow"], b["slow"]) if x]
        return {
            "n": a["n"] + b["n"], "head": sorted(a["head"] + b["head"])[: self.head], "tail": sorted(a["tail"] + b["tail"])[-self.tail :],
            "error": a["error"] or b["error"], "timeout": a["timeout"] or b["timeout"], "slow": min(slow) if slow else None,
            "services": sorted({*a["services"], *b["services"]}),
        }

    def add(self, entry: list, is_error: bool, is_timeout: bool, slow: list | None, service: str) -> None:
        self.add_all([(entry, is_error, is_timeout, slow, service)])

    def add_all(self, rows: list[tuple]) -> None:
        """Entries in any order, each ``(entry, is_error, is_timeout, slow, service)``: sorted once, what lies together is added at once."""
        rows.sort(key=lambda r: r[0])
        first = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][0][0] - rows[i - 1][0][0] >= self.gap_us:
                self._add_together(rows[first:i])
                first = i

    def _add_together(self, rows: list[tuple]) -> None:
        entries, errors, timeouts, slows, services = zip(*rows)
        slow = [x for x in slows if x]
        new = {
            "n": len(rows), "head": list(entries[: self.head]), "tail": list(entries[-self.tail :]),
            "error": any(errors), "timeout": any(timeouts), "slow": min(slow) if slow else None, "services": sorted(set(services)),
        }
        apart = []
        start, end = entries[0][0], entries[-1][0]
        for s in self.sessions:
            if s["head"][0][0] - end >= self.gap_us or start - s["tail"][-1][0] >= self.gap_us:
                apart.append(s)
            else:
                new = self._merged(new, s)
        self.sessions = sorted([*apart, new], key=lambda s: s["head"][0])

    def close(self, watermark_us: int) -> list[dict]:
        """The sessions that no entry after the watermark can join."""
        done = [s for s in self.sessions if s["tail"][-1][0] + self.gap_us <= watermark_us]
        self.sessions = [s for s in self.sessions if s["tail"][-1][0] + self.gap_us > watermark_us]
        return done


class SessionPrompts(StatefulProcessor):
    def __init__(self, gap_us: int, head: int, tail: int):
        self.gap_us, self.head, self.tail = gap_us, head, tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "sessions string")

    def _held(self) -> OpenSessions:
        held = self.state.get() if self.state.exists() else None
        return OpenSessions(self.gap_us, self.head, self.tail, json.loads(held[0]) if held else None)

    def _keep(self, held: OpenSessions) -> None:
        if not held.sessions:
            self.state.clear()
            return
        self.state.update((json.dumps(held.sessions),))
        self.handle.registerTimer(-(-min(s["tail"][-1][0] + self.gap_us for s in held.sessions) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        for batch in rows:
            columns = [batch[c].tolist() for c in ("us", "ts_nanos", "raw", "tz_offset", "line", "is_error", "is_timeout", "is_slow", "latency_ms", "service")]
            held.add_all([
                ([int(us), int(nanos), raw, tz, line], bool(error), bool(timeout), [int(us), int(nanos), raw, int(ms), service] if slow else None, service)
                for us, nanos, raw, tz, line, error, timeout, slow, ms, service in zip(*columns)
            ])
        self._keep(held)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        done = held.close(timerValues.getCurrentWatermarkInMs() * 1000)
        self._keep(held)
        if done:
            rows = []
            for s in done:
                (us, nanos, raw, tz, _), (us2, nanos2, raw2, tz2, _) = s["head"][0], s["tail"][-1]
                slow = s["slow"] or [None] * 5
                rows.append((key[0], us, nanos, raw, tz, us2, nanos2, raw2, tz2, s["n"], [e[4] for e in s["head"]], [e[4] for e in s["tail"]], s["error"], s["timeout"], slow[3], slow[4], s["services"]))
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in CLOSED.split(", ")])
            yield out.astype({"slow_ms": "Int64"})


def closed_sessions(entries: DataFrame, params: Params = Params(), delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Closed sessions with their bounded entry lines and rules (append mode): the columns of ``with_rules`` plus
    ``n_entries, head, tail``. Needs the RocksDB state store (see :func:`logweave.streaming.spikes.rocksdb_state`)."""
    ship_package(entries.sparkSession)
    us = timedelta(microseconds=1)
    message = F.lower("message")
    rows = entries.withWatermark("ts", f"{delay // us} microseconds").dropDuplicatesWithinWatermark(["request_id", "raw"]).select(
        "ts", "request_id", F.unix_micros("ts").alias("us"), "ts_nanos", "raw", "tz_offset", "service", "latency_ms", entry_line().alias("line"),
        (F.col("level") == "ERROR").alias("is_error"), (message.contains("timeout") | message.contains("context deadline exceeded")).alias("is_timeout"),
        (F.col("latency_ms") > params.latency_threshold_ms).alias("is_slow"),
    )
    operator = SessionPrompts(params.correlation_window // us, params.prompt_max_entries, params.prompt_tail)
    closed = rows.groupBy("request_id").transformWithStateInPandas(operator, CLOSED, "append", "EventTime")

    def end(side: str):
        return F.struct(F.timestamp_micros(f"{side}_us").alias("ts"), F.col(f"{side}_nanos").alias("ts_nanos"), F.col(f"{side}_raw").alias("raw"), F.col(f"{side}_tz").alias("tz_offset"))

    slow = F.when(F.col("slow_ms").isNotNull(), F.struct(F.col("slow_ms").alias("latency_ms"), F.col("slow_service").alias("service")))
    flags = [F.array_contains("services", s).alias(f"_has_{i}") for i, s in enumerate(params.service_chain)]
    agg = closed.select("*", end("start").alias("_first"), end("end").alias("_last"), slow.alias("_slow"), *flags)
    return with_rules(agg, params, keep=("n_entries", "head", "tail"))


def stream_prompts(entries: DataFrame, params: Params = Params(), delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """``request_id, start_ts, end_ts, rules, n_entries, prompt`` of every anomalous session as it closes."""
    reports = closed_sessions(entries, params, delay).where(F.size("rules") > 0)
    few = F.col("n_entries") <= params.prompt_max_entries
    head = F.array_join(F.when(few, F.col("head")).otherwise(F.slice("head", 1, params.prompt_head)), "")
    tail = F.when(~few, F.array_join("tail", ""))
    return reports.select("request_id", "start_ts", "end_ts", "rules", "n_entries", prompt_text(head, tail, params).alias("prompt"))
