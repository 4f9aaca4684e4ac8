"""Command-line entry: ``python -m strata --input-path ... --base-path ...``.

Submit it with ``spark-submit`` (or run it with a local PySpark): the session
comes from ``SparkSession.builder``, so master, memory and shared folders are
whatever the cluster configuration says.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

DEFAULT_BASE_PATH = "datalake"
DEFAULT_APP_NAME = "strata_orders"


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata", description="Run the Bronze -> Silver -> Gold order pipeline.")
    parser.add_argument("--input-path", required=True, help="Source CSV file or folder (any Hadoop URI).")
    parser.add_argument("--base-path", default=DEFAULT_BASE_PATH, help="Root of the layered lake.")
    parser.add_argument("--log-dir", default=None, help="Folder for pipeline.log (console only when omitted).")
    parser.add_argument("--app-name", default=DEFAULT_APP_NAME, help="Spark application name.")
    parser.add_argument("--spark-ui", action="store_true", help="Start Spark's web UI (off by default).")
    return parser.parse_args(argv)


def configure_logging(log_dir: str | None) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if log_dir:
        os.makedirs(log_dir, exist_ok=True)
        handlers.append(logging.FileHandler(os.path.join(log_dir, "pipeline.log")))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s",
                        handlers=handlers, force=True)
    for noisy in ("py4j", "pyspark"):
        logging.getLogger(noisy).setLevel(logging.WARNING)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    """Run once; prints and returns the layer row counts. Stops a session it created."""
    from strata.plans import run_pipeline

    args = parse_args(argv)
    configure_logging(args.log_dir)
    own = spark is None
    session = spark or (
        SparkSession.builder.appName(args.app_name)
        .config("spark.ui.enabled", "true" if args.spark_ui else "false")
        .getOrCreate()
    )
    try:
        result = run_pipeline(session, args.input_path, args.base_path)
        print(json.dumps({"run_ts": result.run_ts, **result.counts}))
        return result.counts
    finally:
        if own:
            session.stop()
