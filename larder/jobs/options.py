"""Command line options that several jobs share."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from larder.plans.train import CLUSTERS, MAX_ITERATIONS, SEED


def positive_int(text: str) -> int:
    value = int(text)
    if value <= 0:
        raise argparse.ArgumentTypeError(f"must be positive, got {value}")
    return value


def add_model_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--clusters", type=positive_int, default=CLUSTERS)
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--max-iterations", type=positive_int, default=MAX_ITERATIONS)
    parser.add_argument("--output", help="folder for model, predictions and metrics")


def session(name: str) -> SparkSession:
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
