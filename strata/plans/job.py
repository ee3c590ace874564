"""The schedulable job (PIPE-4): ``spark-submit --py-files strata.zip strata/plans/job.py ...`` or
``python -m strata.plans.job ...``.

Reads the five OLTP tables over JDBC (incremental, by watermark), drains the clickstream from a
Kafka-protocol broker or from a folder of message files, then rebuilds Silver and Gold and runs
the data tests.  Credentials come from environment variables named on the command line, never
from the command line itself.  Exit code 1 when a data test fails.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace

from strata.plans.pipeline import LAYERS, RETAIN, STEPS, Layout, run, setup
from strata.session import build_session, scale_conf
from strata.sinks.tables import bucket_count
from strata.sources.incremental import TABLES_CONFIG, TableConfig, get_last_watermark, jdbc_source
from strata.streaming.ingest import file_stream
from strata.streaming.kafka import kafka_options, kafka_stream


def parse_args(argv: list[str]) -> argparse.Namespace:
    """Command-line options of the job."""
    ap = argparse.ArgumentParser(prog="strata.plans.job", description=__doc__)
    ap.add_argument("--root", required=True, help="storage root of the lake (landing/bronze/silver/gold)")
    ap.add_argument("--prefix", default="", help="database name prefix (one lake per prefix)")
    ap.add_argument("--jdbc-url", required=True)
    ap.add_argument("--jdbc-schema", default="", help="source schema, e.g. 'retail.'")
    ap.add_argument("--jdbc-driver", default=None)
    ap.add_argument("--jdbc-user-env", default=None, help="name of the env var holding the user")
    ap.add_argument("--jdbc-password-env", default=None, help="name of the env var holding the password")
    ap.add_argument("--jdbc-partitions", type=int, default=8, help="parallel reads per table, split on its key")
    ap.add_argument("--files-per-trigger", type=int, default=None, help="message files of one micro-batch")
    ap.add_argument("--offsets-per-trigger", type=int, default=None, help="broker messages of one micro-batch")
    ap.add_argument("--input-bytes", type=int, default=None, help="size of the input, to size shuffles and scans")
    ap.add_argument("--total-cores", type=int, default=None, help="cores of the cluster, likewise")
    ap.add_argument("--kafka-connection-env", default=None, help="env var with the broker connection string")
    ap.add_argument("--topic", default=None)
    ap.add_argument("--events-dir", default=None, help="folder of message files instead of a broker")
    ap.add_argument("--run-date", default=None)
    ap.add_argument("--as-of", default=None, help="snapshot instant (default: now)")
    ap.add_argument("--retain", type=int, default=RETAIN, help="versions of rebuilt tables to keep")
    ap.add_argument("--schema-names", default="", help="custom names of layers, e.g. 'gold=marts,silver=core' (used as they are)")
    ap.add_argument("--incremental", action="store_true", help="update the large models by changed keys instead of rebuilding them")
    ap.add_argument("--event-sink", choices=("append", "batches"), default="append", help="batches: registered micro-batches and dead letters")
    ap.add_argument("--bronze-buckets", type=int, default=None, help="buckets of new Bronze tables (default: sized from --input-bytes)")
    ap.add_argument("--steps", default=",".join(STEPS), help=f"comma-separated subset of {','.join(STEPS)}")
    return ap.parse_args(argv)


def schema_names(text: str) -> dict[str, str] | None:
    """SNK-8: custom layer names from ``layer=name,...``; an unknown layer is an error."""
    names = dict(item.split("=", 1) for item in text.split(",") if item.strip())
    names = {k.strip(): v for k, v in names.items()}
    if unknown := set(names) - set(LAYERS):
        raise ValueError(f"unknown layers {sorted(unknown)}")
    return names or None


def sized_configs(buckets: int | None, input_bytes: int | None) -> tuple[TableConfig, ...]:
    """The ingest config with the number of buckets given, or sized for the input over about a hundred months."""
    if buckets is None and input_bytes:
        buckets = bucket_count(input_bytes, partitions=100)
    return TABLES_CONFIG if buckets is None else tuple(replace(cfg, buckets=buckets) for cfg in TABLES_CONFIG)


def main(argv: list[str] | None = None) -> int:
    """Run the selected steps; exit code 1 when a data test fails."""
    args = parse_args(sys.argv[1:] if argv is None else argv)
    sized = scale_conf(args.input_bytes, args.total_cores) if args.input_bytes and args.total_cores else None
    spark = build_session(extra_conf=sized)
    layout = Layout(args.root, args.prefix, schema_names(args.schema_names))
    configs = sized_configs(args.bronze_buckets, args.input_bytes)
    setup(spark, layout)  # the control table has the watermarks
    props = {}
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    if args.jdbc_user_env:
        props["user"] = os.environ[args.jdbc_user_env]
    if args.jdbc_password_env:
        props["password"] = os.environ[args.jdbc_password_env]
    sources = {
        cfg.source_table: jdbc_source(
            spark,
            args.jdbc_url,
            f"{args.jdbc_schema}{cfg.source_table}",
            props,
            partition_column=cfg.primary_key,
            num_partitions=args.jdbc_partitions,
            newer_than=(cfg.watermark_col, get_last_watermark(spark, layout.control_table, cfg.source_table)),
        )
        for cfg in configs
    }
    stream = None
    if args.kafka_connection_env and args.topic:
        stream = kafka_stream(spark, kafka_options(os.environ[args.kafka_connection_env], args.topic, max_offsets_per_trigger=args.offsets_per_trigger))
    elif args.events_dir:
        stream = file_stream(spark, args.events_dir, max_files_per_trigger=args.files_per_trigger)
    steps = tuple(x.strip() for x in args.steps.split(",") if x.strip())
    report = run(
        spark, layout, sources, stream=stream, run_date=args.run_date, as_of=args.as_of, steps=steps,
        retain=args.retain, event_sink=args.event_sink, incremental=args.incremental, configs=configs,
    )
    failed = report.filter("status = 'fail'")
    n_failed = failed.count()  # one row per declared test at most
    failed.show(max(n_failed, 1), truncate=False)
    return 1 if n_failed else 0


if __name__ == "__main__":
    sys.exit(main())
