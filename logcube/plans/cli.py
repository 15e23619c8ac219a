"""Command line for the nightly job and backfills (for ``spark-submit``).

    spark-submit -m logcube daily --run-day 2019-04-18 --log-root hdfs:///data \
        --fact-root hdfs:///warehouse/facts --tz Asia/Shanghai \
        --catalog-url jdbc:mysql://host/db --catalog-query "select ... union all select ..." \
        --catalog-props /secure/catalog.properties --report-url jdbc:mysql://host/bi \
        --report-props /secure/report.properties

``stream`` ingests log files as they arrive (``--checkpoint``; ``--every`` keeps it
running, else it stops when everything new is read).

``backfill`` takes ``--first-run-day`` / ``--last-run-day`` (run days; the
report day is the day before) and does the whole range in one pass.
Connection properties (``user=``, ``password=``, ``driver=`` ...) are read
from the given file, never from the command line.  Reports go to
``--report-path`` (files, replaced by day) or ``--report-url`` (JDBC, replaced
by day through a staging table).
"""

from __future__ import annotations

import argparse
import datetime as dt

from logcube.operators.enrich import DEFAULT_SALT_BUCKETS
from logcube.plans import daily
from logcube.plans.specs import SPECS
from logcube.sources.raw_logs import NoInputError


# SQL settings for a large cluster, applied only where spark-submit left them unset.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
}


def apply_defaults(spark) -> dict[str, str]:
    """Set ``CLUSTER_DEFAULTS`` that the submitted configuration does not set."""
    submitted = spark.sparkContext.getConf()
    applied = {}
    for key, value in CLUSTER_DEFAULTS.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def read_properties(path: str | None) -> dict[str, str]:
    if not path:
        return {}
    props = {}
    with open(path) as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                k, v = line.split("=", 1)
                props[k.strip()] = v.strip()
    return props


def make_sink(args):
    from logcube.sources.sinks import write_report_files, write_report_jdbc

    if args.report_path:
        return lambda name, df, days: write_report_files(df, f"{args.report_path.rstrip('/')}/{name}", days=days)
    if args.report_url:
        props = read_properties(args.report_props)
        return lambda name, df, days: write_report_jdbc(df, args.report_url, name, props, mode=args.report_mode, days=days)
    raise SystemExit("give --report-path or --report-url")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="logcube")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("daily", "backfill"):
        s = sub.add_parser(name)
        if name == "daily":
            s.add_argument("--run-day", default=dt.date.today().isoformat(), help="reports the day before")
        else:
            s.add_argument("--first-run-day", required=True)
            s.add_argument("--last-run-day", required=True)
        s.add_argument("--log-root", required=True)
        s.add_argument("--log-layout", default="{day}/*/*.gz", help="files of a day below the root")
        s.add_argument("--fact-root", required=True)
        s.add_argument("--tz", required=True, help="zone whose calendar day is the event day")
        s.add_argument("--catalog-url", required=True)
        s.add_argument("--catalog-query", required=True)
        s.add_argument("--catalog-props")
        s.add_argument("--report-url")
        s.add_argument("--report-props")
        s.add_argument("--report-path")
        s.add_argument("--report-mode", default="replace", choices=["replace", "append"])
        s.add_argument("--specs", default="download_v2,install_v2,open_v2", help=f"any of {sorted(SPECS)}")
        s.add_argument("--skip-ingest", action="store_true", help="reports only (facts already parsed)")
        s.add_argument("--fact-format", default="orc")
        s.add_argument("--dedupe-catalog", action="store_true", help="one catalog row per package")
        s.add_argument("--trial", action="store_true", help="write growth to the reports' twins (name_)")
        s.add_argument("--pre-aggregate", action="store_true", help="sum events per day, app and user before the catalog join")
        s.add_argument("--salt-buckets", type=int, default=DEFAULT_SALT_BUCKETS, help="ways to spread a join with a large catalog")
    s = sub.add_parser("stream")
    s.add_argument("--log-root", required=True)
    s.add_argument("--fact-root", required=True)
    s.add_argument("--tz", required=True, help="zone whose calendar day is the event day")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--every", help='e.g. "10 minutes"; default: read what is new and stop')
    s.add_argument("--max-files", type=int, help="log files of a micro-batch at most")
    s.add_argument("--fact-format", default="orc")
    return p


def main(argv=None) -> None:
    from pyspark.sql import SparkSession

    from logcube.sources.catalog import read_catalog_jdbc

    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"logcube-{args.command}").getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        apply_defaults(spark)
    if args.command == "stream":
        _stream(args, spark)
        return
    catalog = read_catalog_jdbc(spark, args.catalog_url, args.catalog_query, read_properties(args.catalog_props))
    specs = [SPECS[s] for s in args.specs.split(",") if s]
    first, last = (args.run_day, args.run_day) if args.command == "daily" else (args.first_run_day, args.last_run_day)
    try:
        _run(args, spark, catalog, specs, first, last)
    except NoInputError as e:  # same exit status as the reference's guard
        print(f"logcube: {e}")
        raise SystemExit(e.exit_code) from e


def _stream(args, spark) -> None:
    from logcube.streaming.ingest import start_ingest

    start_ingest(
        spark,
        args.log_root,
        args.fact_root,
        args.checkpoint,
        args.tz,
        available_now=args.every is None,
        processing_time=args.every,
        fmt=args.fact_format,
        max_files_per_trigger=args.max_files,
    ).awaitTermination()


def _run(args, spark, catalog, specs, first, last) -> None:
    daily.run_range(
        spark,
        args.log_root,
        args.fact_root,
        catalog,
        first,
        last,
        args.tz,
        make_sink(args),
        ingest=not args.skip_ingest,
        layout=args.log_layout,
        specs=specs,
        fmt=args.fact_format,
        dedupe=args.dedupe_catalog,
        trial=args.trial,
        pre_aggregate=args.pre_aggregate,
        salt_buckets=args.salt_buckets,
    )


if __name__ == "__main__":
    main()
