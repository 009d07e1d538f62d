"""Command line: analyze a log directory and write the alerts.

    python -m logweave.cli /data/logs --alerts-out /data/alerts [--latency-threshold 500ms]
        [--spike-window 1m] [--responses /data/responses.parquet] [--master local[*]]

Prints one JSON object with the stage counters, the first reject messages and
the severity counts. Alerts are written as JSON lines ordered by ``alert_pos``;
nothing is written when no request is anomalous. On a cluster, submit with
``spark-submit`` and pass ``--master`` only for local runs.
"""

from __future__ import annotations

import argparse
import json
from pyspark.sql import SparkSession

from logweave.params import Params, setting_duration
from logweave.plans.analysis import run
from logweave.session import ensure_checkpoint_dir
from logweave.sources.sinks import write_alerts_json


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="logweave", description=__doc__.split("\n")[0])
    ap.add_argument("log_dir")
    ap.add_argument("--alerts-out", help="folder for the alert JSON lines")
    ap.add_argument("--latency-threshold", default="500ms", help="duration text; zero or unparsable -> 500ms")
    ap.add_argument("--spike-threshold", type=int, default=10)
    ap.add_argument("--spike-window", default="1m", help="duration text; zero or unparsable -> 1m")
    ap.add_argument("--responses", help="parquet table (request_id, status, body) of model responses")
    ap.add_argument("--master", help="Spark master for local runs, e.g. local[*]")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("logweave")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    base = Params()
    params = Params(
        latency_threshold=setting_duration(args.latency_threshold, base.latency_threshold),
        spike_threshold=args.spike_threshold,
        spike_window=setting_duration(args.spike_window, base.spike_window),
    )
    responses = spark.read.parquet(args.responses) if args.responses else None
    sinks = {"file": lambda df: write_alerts_json(df, args.alerts_out)} if args.alerts_out else {}
    result = run(spark, args.log_dir, sinks, params, responses)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
