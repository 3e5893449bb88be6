"""Command-line entry for the extraction job (``python -m vialflow.job``, or
``spark-submit --py-files vialflow.zip extract_job.py``).

The user-level options of the original command-line tool map one to one;
database connection options are replaced by a table source: a folder with
one Parquet dataset per LIMS table (``--tables``), a JDBC URL (``--jdbc-url``
plus ``--jdbc-property key=value``), or the derived test fixtures
(``--fixture-dir``). Several ``--trial-code`` values run as one
multi-trial job partitioned by trial.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from .functions.predicates import DEFAULT_EXCLUDE_CONDITIONS, DEFAULT_EXCLUDE_MATCODES
from .session import apply_cluster_conf, ensure_checkpoint_dir
from .sinks.parquet import DEFAULT_COMPRESSION, extract_trial, extract_trials
from .sources.tables import LIVE, SNAPSHOT_STATEMENT, LimsTables, ReadPoint, read_jdbc_tables, read_parquet_tables

NONE_TOKEN = "None"


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="vialflow.job", description="Extract trial inventory (and history) to Parquet.")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with one Parquet dataset per LIMS table")
    src.add_argument("--jdbc-url", help="JDBC URL of the LIMS database")
    src.add_argument("--fixture-dir", help="driver test data folder; LIMS tables are derived from it")
    p.add_argument("--jdbc-property", action="append", default=[], help="key=value passed to the JDBC reader")
    p.add_argument("--trial-code", action="append", required=True, help="trial code; repeat for several")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--add-trial-to-path", action="store_true")
    p.add_argument("--include-dsn-in-filename", action="store_true")
    p.add_argument("--no-viable", action="store_true")
    p.add_argument("--exclude-conditions", nargs="+", default=list(DEFAULT_EXCLUDE_CONDITIONS))
    p.add_argument("--exclude-matcodes", nargs="+", default=[m if m is not None else NONE_TOKEN
                                                              for m in DEFAULT_EXCLUDE_MATCODES],
                   help=f"'{NONE_TOKEN}' stands for a missing material code")
    p.add_argument("--parquet-compression", default=DEFAULT_COMPRESSION)
    p.add_argument("--download-history", action="store_true")
    p.add_argument("--collation", default=None, help='e.g. "UTF8_LCASE_RTRIM"')
    p.add_argument("--seq-empty-as-zero", action="store_true", help="an empty sequence is number 0, not missing")
    p.add_argument("--jdbc-partitions", type=int, default=64, help="parallel reads of each large table")
    point = p.add_mutually_exclusive_group()
    point.add_argument("--jdbc-as-of", help="read system-versioned tables as of this UTC time")
    point.add_argument("--jdbc-database-snapshot", help="read the tables of this database snapshot")
    point.add_argument("--jdbc-change-column", help="column=value: read only rows up to this value (append-only tables)")
    return p.parse_args(argv)


def read_point(args: argparse.Namespace) -> ReadPoint:
    if args.jdbc_as_of:
        return ReadPoint.system_time(args.jdbc_as_of)
    if args.jdbc_database_snapshot:
        return ReadPoint.database_snapshot(args.jdbc_database_snapshot)
    if args.jdbc_change_column:
        return ReadPoint.change_column(*args.jdbc_change_column.split("=", 1))
    return LIVE


def load_tables(spark: SparkSession, args: argparse.Namespace) -> LimsTables:
    if args.tables:
        return read_parquet_tables(spark, args.tables)
    if args.jdbc_url:
        props = dict(kv.split("=", 1) for kv in args.jdbc_property)
        props.setdefault("sessionInitStatement", SNAPSHOT_STATEMENT)
        return read_jdbc_tables(spark, args.jdbc_url, props, num_partitions=args.jdbc_partitions, read_point=read_point(args))
    from .sources.fixtures import derive_lims_tables

    return derive_lims_tables(spark, args.fixture_dir)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parse_args(argv)
    codes = [c for c in args.trial_code]
    if any(not c or not c.strip() for c in codes):
        raise SystemExit("trial code must be a non-blank string")
    if len(set(codes)) > 1 and (args.add_trial_to_path or args.include_dsn_in_filename):
        raise SystemExit("--add-trial-to-path and --include-dsn-in-filename name single-trial files; several trials share one dataset")
    codes = list(dict.fromkeys(codes))
    spark = spark or SparkSession.builder.appName("vialflow-extract").getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        apply_cluster_conf(spark)  # cluster defaults, never overriding what the submit set
    ensure_checkpoint_dir(spark)
    t = load_tables(spark, args)
    mats = [None if m == NONE_TOKEN else m for m in args.exclude_matcodes]
    common = dict(no_viable=args.no_viable, exclude_conditions=args.exclude_conditions, exclude_matcodes=mats,
                  parquet_compression=args.parquet_compression, download_history=args.download_history,
                  seq_empty_as_zero=args.seq_empty_as_zero)
    if len(codes) == 1:
        res = extract_trial(t, codes[0], args.output_dir, add_trial_to_path=args.add_trial_to_path,
                            include_dsn_in_filename=args.include_dsn_in_filename, collation=args.collation, **common)
        summary = {k: v for k, v in vars(res).items() if k != "extra"}
    else:
        summary = extract_trials(t, codes, args.output_dir, collation=args.collation, **common)
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main(sys.argv[1:])
