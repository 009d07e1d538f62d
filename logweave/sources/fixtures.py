"""Derived inputs built from the ``events`` table with Spark expressions.

* :func:`event_log_lines` turns each event into one raw log line (with rule-based
  defects so that every reject branch is exercised) -- fixture "L".
* :func:`model_responses` builds a table of chat-completion responses keyed by
  request id -- fixture "R" -- covering every decoding branch.

Both scale with ``events``; both are deterministic functions of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.params import DEFAULT_SERVICE_CHAIN


def _mod(c: str, k: int) -> Column:
    return F.pmod(F.col(c), F.lit(k))


def request_key(key: str = "bucket") -> Column:
    """``req-<user_id>-<3-day bucket>`` (default) or ``req-<user_id>``."""
    if key == "user":
        return F.concat(F.lit("req-"), F.col("user_id").cast("string"))
    bucket = F.floor((F.dayofmonth("ts") - 1) / 3)
    return F.concat(F.lit("req-"), F.col("user_id").cast("string"), F.lit("-"), bucket.cast("string"))


def event_log_lines(events: DataFrame, key: str = "bucket", repeats: bool = True) -> DataFrame:
    """One raw line per event (``raw`` column); lines of every 10th event twice."""
    chain = F.array(*[F.lit(s) for s in DEFAULT_SERVICE_CHAIN])
    eid = "event_id"
    etype = F.col("event_type")
    ts_txt = F.when(_mod(eid, 109) == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    service = F.when(_mod(eid, 101) == 0, F.lit("   ")).otherwise(F.rpad(F.get(chain, _mod(eid, 5).cast("int")), 17, " "))
    level = (
        F.when(_mod(eid, 103) == 0, F.lit("NOTICE"))
        .otherwise(F.rpad(
            F.when((etype == "error") & (_mod(eid, 3) == 0), F.lit("ERROR"))
            .when(etype.isin("error", "signup"), F.lit("WARN"))
            .when(etype == "view", F.lit("DEBUG"))
            .otherwise(F.lit("INFO")), 5, " "))
    )
    rid = F.when(_mod(eid, 113) == 0, F.lit("   ")).otherwise(request_key(key))
    message = (
        F.when(_mod(eid, 127) == 0, F.lit("   "))
        .when((etype == "error") & (_mod(eid, 4) == 0), F.lit("Gateway Timeout"))
        .when((etype == "error") & (_mod(eid, 4) == 1), F.lit("context deadline exceeded"))
        .when(etype == "error", F.lit("Payment declined"))
        .otherwise(F.concat(F.lit("Event "), etype))
    )
    latency = F.when(_mod(eid, 131) == 0, F.lit("latency=n/a")).otherwise(
        F.concat(F.lit("latency="), F.floor(F.col("value") * 4).cast("string"), F.lit("ms"))
    )
    raw = F.when(_mod(eid, 107) == 0, F.concat(ts_txt, F.lit(" | cut off"))).otherwise(
        F.concat_ws(" | ", ts_txt, service, level, rid, message, latency)
    )
    lines = events.select(raw.alias("raw"), F.col(eid).alias("event_id"))
    if repeats:
        lines = lines.unionByName(lines.where(_mod(eid, 10) == 0))
    return lines.select("raw")


def _content(v: Column, rid: Column, sev: Column) -> Column:
    obj = F.concat(
        F.lit('{"root_cause": "Upstream fault for '), rid,
        F.lit('", "recommendation": "Restart the failing pod", "severity": "'), sev, F.lit('"}'),
    )
    return (
        F.when(v == 0, obj)
        .when(v == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
        .when(v == 2, F.concat(F.lit("```\n"), obj, F.lit("\n```")))
        .when(v == 3, F.concat(F.lit("Sure! "), obj, F.lit(" hope this helps")))
        .when(v == 4, F.concat(F.lit('{"Root_Cause": "Upstream fault for '), rid, F.lit('", "SEVERITY": "warning"}')))
        .when(v == 5, F.lit('{"root_cause":null}'))
        .when(v == 6, F.lit('{"root_cause":5}'))
        .when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit('{"root_cause": "x",}'))
        .when(F.pmod(F.col("user_id"), F.lit(3)) == 1, F.lit('{"root_cause": "kept", "notes": {"k": 1, "k": {"k": 2}}}'))
        .otherwise(F.lit('{"root_cause": "a"} and {"severity": "b"}'))
    )


def _choice(content: Column) -> Column:
    return F.to_json(F.struct(F.struct(content.alias("content")).alias("message")))


def model_responses(events: DataFrame) -> DataFrame:
    """``(request_id, status, body)``: one response per distinct request key of the lines.

    Variant ``v = (user_id + bucket) % 20`` selects the shape: 0-7 content shapes, 8 an
    HTTP 500, 9 no row, 10-19 wrong types at every level of the envelope (and two
    envelopes with a second choice).
    """
    bucket = F.floor((F.dayofmonth("ts") - 1) / 3)
    keys = events.select("user_id", bucket.alias("bucket")).distinct()
    v = F.pmod(F.col("user_id") + F.col("bucket"), F.lit(20))
    rid = F.concat(F.lit("req-"), F.col("user_id").cast("string"), F.lit("-"), F.col("bucket").cast("string"))
    sev = F.element_at(F.array(F.lit("critical"), F.lit("warning"), F.lit("info")), (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
    good = _choice(_content(F.lit(0), rid, sev))
    body = (
        F.when(v == 8, F.lit('{"error": "internal server error"}'))
        .when(v == 10, F.lit('{"choices":[{"message":"hi"}]}'))
        .when(v == 11, F.lit('{"choices":[{"message":5}]}'))
        .when(v == 12, F.lit('{"choices":[{"message":[1]}]}'))
        .when(v == 13, F.concat(F.lit('{"choices":['), good, F.lit(',{"message":"x"}]}')))
        .when(v == 14, F.lit('{"choices":"x"}'))
        .when(v == 15, F.lit('{"choices":[{"message":{"content":{"a":1}}}]}'))
        .when(v == 16, F.lit('{"choices":[7]}'))
        .when(v == 17, F.lit('{"choices":{"message":{"content":"{}"}}}'))
        .when(v == 18, F.concat(F.lit('{"choices":['), good, F.lit(',{"message":{"content":null}},null]}')))
        .when(v == 19, F.lit('[]'))
        .otherwise(F.concat(F.lit('{"choices":['), _choice(_content(v, rid, sev)), F.lit("]}")))
    )
    return keys.where(v != 9).select(rid.alias("request_id"), F.when(v == 8, F.lit(500)).otherwise(F.lit(200)).alias("status"), body.alias("body"))


def edge_lines(events: DataFrame) -> DataFrame:
    """Valid and invalid lines of rarer shapes, one per event: offsets, comma and 9-digit
    fractions, no-break spaces and tabs around fields, ``" | "`` in the last field, signs."""
    k = _mod("event_id", 8)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    rid = F.concat(F.lit("edge-"), F.col("event_id").cast("string"))
    raw = (
        F.when(k == 0, F.concat(stamp, F.lit("+05:30 | svc | INFO | "), rid, F.lit(" | offset | latency=1ms")))
        .when(k == 1, F.concat(stamp, F.lit(",25Z | svc | INFO | "), rid, F.lit(" | comma | latency=+2ms")))
        .when(k == 2, F.concat(stamp, F.lit(".123456789Z | svc | WARN | "), rid, F.lit(" | nine digits | latency=-3ms")))
        .when(k == 3, F.concat(F.lit("\u00a0\t"), stamp, F.lit("Z\u00a0 |\t | \u00a0svc\u00a0 | DEBUG | "), rid, F.lit(" | m | 4")))
        .when(k == 4, F.concat(stamp, F.lit("Z | \u00a0svc\t | DEBUG\u2003 | "), rid, F.lit(" | padded\u00a0 | latency=4ms")))
        .when(k == 5, F.concat(stamp, F.lit("Z | svc | INFO | "), rid, F.lit(" | a | b | c | latency=5ms")))
        .when(k == 6, F.concat(stamp, F.lit(" | svc | INFO | "), rid, F.lit(" | no zone | latency=6ms")))
        .otherwise(F.concat(stamp, F.lit("-08:00 | svc | ERROR | "), rid, F.lit(" | minus | 7")))
    )
    return events.select(raw.alias("raw"))


def long_lines(events: DataFrame, size: int = 2 << 20) -> DataFrame:
    """One valid line per event; every 5000th has a message of ``size`` characters, the others one of up to 45."""
    x = F.when(_mod("event_id", 5000) == 1, F.lit(size - 5)).otherwise(_mod("event_id", 41).cast("int"))
    message = F.concat(F.lit("long "), F.repeat(F.lit("x"), x))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return events.select(F.concat(stamp, F.lit(" | order-service | INFO | long-"), F.col("event_id").cast("string"), F.lit(" | "), message, F.lit(" | latency=9ms")).alias("raw"))
