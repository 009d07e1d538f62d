"""Sinks for alerts. Every sink gets the same DataFrame; a failing sink does not
stop the others (the error is returned, not raised)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.alerts import ALERT_COLUMNS, alert_payload
from logweave.plans.materialize import file_system


def write_alerts_json(alerts: DataFrame, path: str) -> None:
    """Overwrite ``path`` with the alerts as JSON lines, ordered by ``alert_pos``.

    The sort is a range-partitioned global sort; each output file holds one range.
    """
    alerts.orderBy("alert_pos").select(*ALERT_COLUMNS).write.mode("overwrite").json(path)


def _joined(spark: SparkSession, parts: list, target) -> None:
    """Make one file of ``parts`` in their order: by moving blocks where the store can (HDFS), else by copying a buffer at a time."""
    jvm = spark.sparkContext._jvm
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() == "hdfs" and len(parts) > 1:
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            array[i] = part
        fs.concat(parts[0], array)
        fs.rename(parts[0], target)
        return
    out = fs.create(target, True)
    try:
        for part in parts:
            source = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()


def write_alerts_document(alerts: DataFrame, path: str) -> None:
    """Replace the file ``path`` with one JSON array of all alerts, in ``alert_pos`` order.

    Spark's tasks write the sorted ranges as fragments of the array; only when all of them
    are committed are they joined, in range order, between its brackets, and the document
    takes the place of the old file in one rename. Until then the old file stays as it is,
    whatever fails. No alerts: an empty array.
    """
    spark = alerts.sparkSession
    fs, target = file_system(spark, path)
    draft = f"{str(target.getParent())}/.draft-{uuid.uuid4().hex}"
    payload = alert_payload(alerts)
    fragment = F.when(F.col("alert_pos") == 1, F.col("payload")).otherwise(F.concat(F.lit(","), F.col("payload")))
    try:
        payload.orderBy("alert_pos").select(fragment.alias("value")).write.text(f"{draft}/parts")
        parts = sorted((f.getPath() for f in fs.listStatus(file_system(spark, f"{draft}/parts")[1]) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        ends = []
        for name, text in (("head", b"[\n"), ("tail", b"]\n")):
            end = file_system(spark, f"{draft}/{name}")[1]
            stream = fs.create(end, True)
            stream.write(bytearray(text))
            stream.close()
            ends.append(end)
        whole = file_system(spark, f"{draft}/document")[1]
        _joined(spark, [ends[0], *parts, ends[1]], whole)
        jvm = spark.sparkContext._jvm
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(whole), fs.makeQualified(target), options)
    finally:
        fs.delete(file_system(spark, draft)[1], True)


def write_alerts(alerts: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> dict[str, str | None]:
    """Run every sink on ``alerts``; return ``{name: None | error text}``."""
    results: dict[str, str | None] = {}
    for name, sink in sinks.items():
        try:
            sink(alerts)
            results[name] = None
        except Exception as exc:  # noqa: BLE001 - one failing sink must not stop the others
            results[name] = f"{type(exc).__name__}: {exc}"
    return results
