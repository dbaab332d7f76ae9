"""Build an election's station table from files.

    spark-submit ... -m isoloir 2017 --export E --official O --geo G --out T
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from isoloir.plans.build import read_election
from isoloir.schema import CODE, COMMUNE, ELECTIONS
from isoloir.session import session_builder
from isoloir.sinks.tables import replace_stations


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="isoloir", description="Build a station table.")
    parser.add_argument("year", type=int, choices=sorted(ELECTIONS))
    parser.add_argument("--export", required=True, help="results export, ';' separated")
    parser.add_argument("--official", required=True, help="official results, ';' separated")
    parser.add_argument("--geo", required=True, help="geo table, CSV, plain or gzipped")
    parser.add_argument("--out", required=True, help="station table, one folder per election")
    parser.add_argument("--cluster", action="store_true", help="cluster files by commune")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    stations = read_election(spark, ELECTIONS[args.year], args.export, args.official, args.geo)
    replace_stations(stations, args.out, cluster_by=(CODE, COMMUNE) if args.cluster else ())


if __name__ == "__main__":
    run(session_builder("stations").getOrCreate(), arguments())
