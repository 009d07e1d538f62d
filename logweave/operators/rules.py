"""Per-request anomaly rules.

All rules are aggregates that do not change when a line is repeated (``bool_or``,
``min_by``, presence flags), so ``detect`` gives the same result on raw or
deduplicated entries and needs no dedup shuffle. Spark combines the aggregates
map-side, so a hot request id is never collected in one task. Buffers are booleans,
one struct and one flag per chain service, plus the set of a request's service
names, which is bounded by the number of distinct services, not by the lines.

Rules, in output order:

1. ``error_detected`` - some entry has level ERROR.
2. ``high_latency(<duration> in <service>)`` - the chronologically first entry with
   latency strictly above the threshold.
3. ``missing_hop(<service>)`` - each chain service without an entry, in chain order.
4. ``timeout_pattern`` - a message contains ``timeout`` or
   ``context deadline exceeded`` (case-insensitive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import duration_text_ms
from logweave.params import Params


def _chain_flag(i: int) -> str:
    return f"_has_{i}"


def rule_columns(params: Params = Params()) -> list[Column]:
    """The aggregates behind the rules and the group bounds, for batch groups and streaming sessions."""
    slow = F.col("latency_ms") > F.lit(params.latency_threshold_ms)
    msg = F.lower("message")
    return [
        F.min(F.struct("ts", "ts_nanos", "raw", "tz_offset")).alias("_first"),
        F.max(F.struct("ts", "ts_nanos", "raw", "tz_offset")).alias("_last"),
        F.bool_or(F.col("level") == "ERROR").alias("error_detected"),
        F.min_by(
            F.when(slow, F.struct("latency_ms", "service")),
            F.when(slow, F.struct("ts", "ts_nanos", "raw")),
        ).alias("_slow"),
        F.bool_or(msg.contains("timeout") | msg.contains("context deadline exceeded")).alias("timeout_pattern"),
        F.array_sort(F.collect_set("service")).alias("services"),
        *[F.bool_or(F.col("service") == s).alias(_chain_flag(i)) for i, s in enumerate(params.service_chain)],
    ]


def rule_aggregates(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per request id with the raw rule inputs and the group bounds."""
    return entries.groupBy("request_id").agg(*rule_columns(params))


def with_rules(agg: DataFrame, params: Params = Params(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn rule aggregates into the ordered ``rules`` array and the summary text.

    ``keep``: extra columns of ``agg`` to carry through (e.g. a session window).
    """
    high = F.when(
        F.col("_slow").isNotNull(),
        F.format_string("high_latency(%s in %s)", duration_text_ms(F.col("_slow.latency_ms")), F.col("_slow.service")),
    )
    missing = F.filter(
        F.array(*[F.when(~F.col(_chain_flag(i)), F.lit(f"missing_hop({s})")) for i, s in enumerate(params.service_chain)]),
        lambda x: x.isNotNull(),
    ) if params.service_chain else F.array().cast("array<string>")
    rules = F.filter(
        F.concat(
            F.array(F.when(F.col("error_detected"), F.lit("error_detected")), high),
            missing,
            F.array(F.when(F.col("timeout_pattern"), F.lit("timeout_pattern"))),
        ),
        lambda x: x.isNotNull(),
    )
    staged = agg.select(
        "request_id",
        *keep,
        F.col("_first.ts").alias("start_ts"),
        F.col("_first.ts_nanos").alias("start_nanos"),
        F.col("_first.tz_offset").alias("start_tz"),
        F.col("_last.ts").alias("end_ts"),
        F.col("_last.ts_nanos").alias("end_nanos"),
        F.col("_last.tz_offset").alias("end_tz"),
        "error_detected",
        high.alias("high_latency"),
        missing.alias("missing_hops"),
        "timeout_pattern",
        "services",
        rules.alias("rules"),
    )
    summary = F.format_string(
        "Request %s touched %d services [%s], triggered rules: %s",
        F.col("request_id"), F.size("services"), F.array_join("services", ", "), F.array_join("rules", ", "),
    )
    return staged.withColumn("summary", summary)


def evaluate_rules(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """Every request group with its rule results (anomalous or not)."""
    return with_rules(rule_aggregates(entries, params), params)


def detect(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """Anomaly reports: request groups that triggered at least one rule."""
    return evaluate_rules(entries, params).where(F.size("rules") > 0)


def detection_stats(evaluated: DataFrame) -> DataFrame:
    """Total request groups and anomalous ones: one row."""
    return evaluated.agg(
        F.count(F.lit(1)).alias("total_groups"),
        F.count_if(F.size("rules") > 0).alias("anomalous_groups"),
    )


def severity_of(rules: Column) -> Column:
    """``critical`` if any rule text contains ``error`` or ``timeout`` (case-sensitive), else ``warning``."""
    return F.when(
        F.exists(rules, lambda r: r.contains("error") | r.contains("timeout")), F.lit("critical")
    ).otherwise(F.lit("warning"))


def service_chain_gaps(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """Relational form of the missing-hop rule: ``(request_id, service, hop)`` per absent chain service.

    Each request id expands to its expected hops (``posexplode`` of the chain
    parameter, no join), then an anti-join removes the ``(request_id, service)``
    pairs that occur. Both join sides have at most one row per pair, so a hot
    request id is not a hot join key.
    """
    chain = F.array(*[F.lit(s) for s in params.service_chain])
    expected = entries.select("request_id").distinct().select("request_id", F.posexplode(chain).alias("hop", "service"))
    present = entries.select("request_id", "service").distinct()
    return expected.join(present, ["request_id", "service"], "left_anti").select("request_id", "service", "hop")
