"""Alert assembly, dashboard counts and presentation fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.operators.ranking import rank_within, running_sum_within
from logweave.params import SPIKE_REQUEST_ID

#: Spike first, then by request start, ties by request id.
ALERT_ORDER = ["_grp", "start_ts", "start_nanos", "request_id"]
ALERT_COLUMNS = ["request_id", "root_cause", "recommendation", "severity"]


def alert_rows(spike: DataFrame | None, diagnoses: DataFrame) -> DataFrame:
    """All alerts without positions, with the columns of their order (``ALERT_ORDER``)."""
    d = diagnoses.select(*ALERT_COLUMNS, F.lit(1).alias("_grp"), "start_ts", "start_nanos")
    if spike is not None:
        s = spike.select(*ALERT_COLUMNS, F.lit(0).alias("_grp"), "start_ts", F.lit(0).alias("start_nanos"))
        d = s.unionByName(d)
    return d


def assemble_alerts(spike: DataFrame | None, diagnoses: DataFrame) -> DataFrame:
    """Spike alert (if any) first, then request diagnoses by start time and request id.

    Returns the alert columns plus ``alert_pos`` (1-based), computed with the
    range-partitioned ranking, so no single task orders all alerts.
    """
    ranked = rank_within(alert_rows(spike, diagnoses), [], ALERT_ORDER, name="alert_pos")
    return ranked.select("alert_pos", *ALERT_COLUMNS)


def severity_summary(alerts: DataFrame) -> DataFrame:
    """Dashboard counts: one row; an unknown severity counts in the total only."""
    sev = F.col("severity")
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(sev == "critical").alias("critical"),
        F.count_if(sev == "warning").alias("warning"),
        F.count_if(sev == "info").alias("info"),
    )


def alert_view(alerts: DataFrame) -> DataFrame:
    """Presentation fields per alert: spike flag, upper-case severity, severity class."""
    sev = F.col("severity")
    return alerts.select(
        "*",
        (F.col("request_id") == SPIKE_REQUEST_ID).alias("is_spike"),
        F.upper(sev).alias("severity_label"),
        F.when(sev == "critical", F.lit("critical")).when(sev == "warning", F.lit("warning")).otherwise(F.lit("other")).alias("severity_class"),
    )


def alert_payload(alerts: DataFrame) -> DataFrame:
    """One compact JSON object per alert (``payload``), keyed by ``alert_pos``.

    :func:`alert_payload_arrays` makes the webhook's JSON arrays of them.
    """
    return alerts.select("alert_pos", F.to_json(F.struct(*ALERT_COLUMNS)).alias("payload"))


def alert_payload_arrays(alerts: DataFrame, max_bytes: int = 1 << 20) -> DataFrame:
    """JSON arrays of consecutive alerts for a webhook, each of at most ``max_bytes`` bytes.

    ``first_pos, last_pos, n_alerts, payload``: taken in order of ``first_pos`` the arrays hold every
    alert once, in ``alert_pos`` order. An array's alerts begin within one half of ``max_bytes`` of the
    running byte count, so they fit whatever their lengths; an alert of more than half of it is an
    array by itself (and the only kind that can be longer than ``max_bytes``). Both running
    sums are range-partitioned, and no task holds more than one array of text at a time.
    """
    half = max(max_bytes // 2 - 1, 1)
    sized = alert_payload(alerts).withColumn("size", F.octet_length("payload").cast("bigint") + 1)
    sized = sized.withColumn("alone", (F.col("size") > half).cast("bigint"))
    sized = sized.withColumn("small", F.when(F.col("alone") == 0, F.col("size")).otherwise(0))
    placed = running_sum_within(running_sum_within(sized, [], ["alert_pos"], "small", name="upto"), [], ["alert_pos"], "alone", name="lone")
    placed = placed.withColumn("cell", F.floor((F.col("upto") - F.col("small")) / half))
    arrays = placed.groupBy("lone", "alone", "cell").agg(
        F.min("alert_pos").alias("first_pos"), F.max("alert_pos").alias("last_pos"), F.count(F.lit(1)).alias("n_alerts"),
        F.array_sort(F.collect_list(F.struct("alert_pos", "payload"))).alias("rows"),
    )
    body = F.array_join(F.transform("rows", lambda r: r["payload"]), ",")
    return arrays.select("first_pos", "last_pos", "n_alerts", F.concat(F.lit("["), body, F.lit("]")).alias("payload"))
