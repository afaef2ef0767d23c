"""Jobs from the command line: python -m faultline <job> --help"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException

from .functions import motion as m
from .operators import audit
from .operators.distance_join import STRATEGIES
from .plans import jobs
from .session import session
from .sources.export import preview
from .sources.tables import read_table, table_history
from .streaming.ledger import Accounts


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def _timing(p: argparse.ArgumentParser) -> None:
    p.add_argument("--once", action="store_true", help="stop when all input is read")
    p.add_argument("--trigger", help="time between micro-batches, e.g. '10 seconds'")


def _joining(p: argparse.ArgumentParser) -> None:
    p.add_argument("--strategy", default="auto", choices=STRATEGIES)
    p.add_argument("--method", default="haversine", choices=["haversine", "slc"])


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="faultline")
    parser.add_argument("--format", default="parquet", help="table format")
    sub = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for a in arguments:
            p.add_argument(f"--{a}", required=True)
        return p

    for name in ("quakes", "stations"):
        p = job(name, "table", "checkpoint")
        p.add_argument("--source", default="kafka", help="kafka, text or a file format")
        p.add_argument("--path", help="folder of messages, for file sources")
        p.add_argument("--option", action="append", default=[], help="source option, key=value")
        p.add_argument("--watermark", help="forget keys this far behind; drops late rows. Default: neither")
        p.add_argument("--partition-by", action="append", help="table column")
        _timing(p)
        if name == "quakes":
            p.add_argument("--rejects", help="table of messages left out, with the reason")
    p = job("account", "feed", "root", "checkpoint")
    p.add_argument("--source", default="kafka", help="kafka, text or a file format")
    p.add_argument("--path", help="folder of messages, for file sources")
    p.add_argument("--option", action="append", default=[], help="source option, key=value")
    p.add_argument("--late-after", help="rows this far behind the newest are late, e.g. '15 minutes'")
    _timing(p)
    p = job("sites", "csv", "table")
    p.add_argument("--mode", default="append", choices=["append", "overwrite"])
    p = job("proximity", "quakes", "sites", "km", "table", "checkpoint")
    p.add_argument("--site-key", default="coalesce", choices=["coalesce", "icao"])
    p.add_argument("--far", action="store_true", help="allow distances of more than half the globe")
    _joining(p)
    _timing(p)
    p = job("intensity", "quakes", "sites", "table")
    for name, value in (("pgv", m.PGV), ("pgd", m.PGD)):
        p.add_argument(
            f"--{name}", nargs=4, type=float, default=list(vars(value).values()), metavar=tuple(vars(value))
        )
    p.add_argument("--low", type=float, default=m.LOW)
    p.add_argument("--moderate", type=float, default=m.MODERATE)
    p.add_argument("--null-policy", default="null", choices=["null", "reference"])
    _joining(p)
    p = job("audit")
    p.add_argument("tables", nargs="+", help="name=path")
    p = job("view", "table")
    p.add_argument("--rows", type=int, default=20)
    p = job("schema", "table")
    p.add_argument("--rows", type=int, default=audit.SAMPLE_ROWS, help="rows of the sample shown with it")
    job("summary", "base")
    p = job("history", "table")
    p.add_argument("--log", help="log of writes, for tables without one of their own")
    return parser


def _there(spark, path: str, fmt: str) -> bool:
    try:
        read_table(spark, path, fmt)
    except AnalysisException:
        return False
    return True


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = session(f"faultline-{args.job}")
    fmt = args.format
    now = {"availableNow": True} if getattr(args, "once", False) else None
    if not now and getattr(args, "trigger", None):
        now = {"processingTime": args.trigger}
    how = {"strategy": args.strategy, "method": args.method} if hasattr(args, "strategy") else {}
    if args.job in ("quakes", "stations"):
        source = {"fmt": args.source, "path": args.path, **_pairs(args.option)}
        run = jobs.ingest_quakes if args.job == "quakes" else jobs.ingest_stations
        started = [run(spark, source, args.table, args.checkpoint, args.watermark, now, fmt, args.partition_by)]
        if getattr(args, "rejects", None):
            started.append(jobs.reject_quakes(spark, source, args.rejects, f"{args.checkpoint}-rejects", now, fmt))
        if not getattr(args, "once", False):
            spark.streams.awaitAnyTermination()  # whichever fails ends the job
        for query in started:
            query.awaitTermination()
    elif args.job == "account":
        source = {"fmt": args.source, "path": args.path, **_pairs(args.option)}
        jobs.account_feed(spark, args.feed, source, args.root, args.checkpoint, args.late_after, now, fmt).awaitTermination()
        preview(Accounts(args.root).totals(spark, fmt), 100)
    elif args.job == "sites":
        jobs.ingest_sites(spark, args.csv, args.table, args.mode, fmt)
    elif args.job == "proximity":
        jobs.find_proximity(
            spark, args.quakes, args.sites, float(args.km), args.table, args.checkpoint, now, fmt,
            args.site_key, far=args.far, **how,
        ).awaitTermination()
    elif args.job == "intensity":
        how |= {"pgv": m.Attenuation(*args.pgv), "pgd": m.Attenuation(*args.pgd)}
        how |= {"low": args.low, "moderate": args.moderate, "null_policy": args.null_policy}
        preview(jobs.analyse_intensity(spark, args.quakes, args.sites, args.table, fmt, **how))
    elif args.job == "audit":
        rows, ok = jobs.check_tables(spark, _pairs(args.tables), fmt=fmt)
        preview(rows, len(args.tables))
        return 0 if ok else 1
    elif args.job in ("view", "schema") and not _there(spark, args.table, fmt):
        print(f"no table at {args.table}")
        return 1
    elif args.job == "schema":
        table = read_table(spark, args.table, fmt)
        preview(audit.table_schema(table, args.table), len(table.columns))
        preview(audit.sample_rows(table, args.rows), args.rows)
    elif args.job == "view":
        preview(audit.latest_rows(read_table(spark, args.table, fmt), args.rows), args.rows)
    elif args.job == "summary":
        preview(audit.table_summary(spark, args.base), 1000)
    elif args.job == "history":
        preview(table_history(spark, args.table, log=args.log, fmt=fmt), 3)
    return 0


if __name__ == "__main__":
    sys.exit(main())
