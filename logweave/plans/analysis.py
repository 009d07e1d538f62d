"""The whole run: ``read_logs -> parse -> rules -> diagnose -> spike -> alerts -> sinks``.

``analyze`` composes the stages lazily. The ordered alert list needs one ranking
pass (a job), so it is built on first use. ``run`` adds the console tool's
control flow: stats, the "no anomalies, write nothing" stop, and the sinks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logweave.operators.alerts import alert_rows, assemble_alerts, severity_summary
from logweave.operators.correlate import correlation_stats
from logweave.operators.diagnose import diagnose
from logweave.operators.parse import accepted, first_rejects, parse_lines, parse_stat_columns, parse_stats, rejected
from logweave.operators.rules import detection_stats, evaluate_rules
from logweave.operators.spike import error_entries, global_error_spike
from logweave.params import Params
from logweave.plans.materialize import materialize
from logweave.sources.logfiles import read_logs
from logweave.sources.tolerant import READ_ERRORS, readable_lines, unreadable_files


@dataclass
class Analysis:
    raw: DataFrame
    params: Params = field(default_factory=Params)
    responses: DataFrame | None = None
    stage_parsed: bool = False

    @cached_property
    def parsed(self) -> DataFrame:
        """Parsed lines; with ``stage_parsed`` written once to the checkpoint folder,
        so every consumer reads the columns it needs (with filter pushdown on
        ``error_kind``) instead of re-parsing the text. The parser counters are then
        observed while writing (``DataFrame.observe``): no extra job."""
        parsed = parse_lines(self.raw, self.params)
        if not self.stage_parsed:
            return parsed
        self._parse_observation = Observation("parse")
        return materialize(parsed.observe(self._parse_observation, *parse_stat_columns()), "parsed-lines")

    @cached_property
    def entries(self) -> DataFrame:
        return accepted(self.parsed)

    @cached_property
    def rejects(self) -> DataFrame:
        return rejected(self.parsed)

    @cached_property
    def evaluated(self) -> DataFrame:
        """Every request group with its rules (no dedup shuffle: the rules ignore repeats).

        With ``stage_parsed`` written once too: counters, reports and alerts read it."""
        evaluated = evaluate_rules(self.entries, self.params)
        return materialize(evaluated, "evaluated") if self.stage_parsed else evaluated

    @cached_property
    def reports(self) -> DataFrame:
        return self.evaluated.where(F.size("rules") > 0)

    @cached_property
    def diagnoses(self) -> DataFrame:
        return diagnose(self.reports, self.responses)

    @cached_property
    def spike(self) -> DataFrame:
        """0 or 1 spike alert; only the ERROR lines are deduplicated for it."""
        return global_error_spike(error_entries(self.entries), self.params)

    @cached_property
    def alerts(self) -> DataFrame:
        """Spike first, then diagnoses by request start; with ``alert_pos`` (runs the ranking job)."""
        return assemble_alerts(self.spike, self.diagnoses)

    @cached_property
    def summary(self) -> DataFrame:
        """Dashboard counts; needs no positions, so no ranking runs for it."""
        return severity_summary(alert_rows(self.spike, self.diagnoses))

    def stats(self) -> dict:
        """Single-row counters of every stage (small, bounded results)."""
        parsed = self.parsed
        obs = getattr(self, "_parse_observation", None)
        p = dict(obs.get) if obs is not None else parse_stats(parsed).collect()[0].asDict()
        c = correlation_stats(self.entries).collect()[0].asDict()
        d = detection_stats(self.evaluated).collect()[0].asDict()
        return {"parse": p, "correlation": c, "detection": d}


def analyze(raw: DataFrame, params: Params = Params(), responses: DataFrame | None = None, stage_parsed: bool = False) -> Analysis:
    """All stages over raw lines (column ``raw``); ``responses`` is an optional
    ``(request_id, status, body)`` table of model answers. ``stage_parsed`` writes
    the parsed lines once (worth it when several outputs are used)."""
    return Analysis(raw, params, responses, stage_parsed)


def run(
    spark: SparkSession,
    log_dir: str,
    sinks: dict[str, Callable[[DataFrame], None]],
    params: Params = Params(),
    responses: DataFrame | None = None,
    pattern: str = "*.log",
) -> dict:
    """Read ``log_dir``, analyze, and write the alerts to every sink.

    When no request group is anomalous nothing is written (an older alert file
    stays as it is), like the original tool. A file that cannot be read to its end is
    reported with its error and does not stop the others. Returns stats, the first
    reject messages, the unreadable files and the per-sink outcome.
    """
    from logweave.sources.sinks import write_alerts

    bad: dict[str, str] = {}
    a = analyze(read_logs(spark, log_dir, pattern), params, responses, stage_parsed=True)
    try:
        a.parsed  # reads and writes the lines
    except READ_ERRORS:
        bad = unreadable_files(spark, log_dir, pattern)
        if not bad:
            raise
        a = analyze(readable_lines(spark, log_dir, bad, pattern).drop("source_file"), params, responses, stage_parsed=True)
    out: dict = {"unreadable_files": bad, "stats": a.stats(), "first_rejects": [r.parse_error for r in first_rejects(a.rejects).collect()]}
    if not out["stats"]["detection"]["anomalous_groups"]:
        out["status"] = "no anomalies"
        return out
    out["summary"] = a.summary.collect()[0].asDict()
    out["sinks"] = write_alerts(a.alerts, sinks)
    out["status"] = "alerted"
    return out
