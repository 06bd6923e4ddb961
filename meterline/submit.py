"""Run one streaming job: ``spark-submit meterline/submit.py minute_revenue --servers ...``."""

from __future__ import annotations

import argparse

from meterline.plans.shared import shared_dir
from meterline.session import get_session
from meterline.streaming import jobs
from meterline.streaming.catalog import JOBS, Places


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker to read from, and to write topics to")
    source.add_argument("--folder", help="folder with a sub-folder of files per table")
    parser.add_argument("--format", default="json", choices=["json", "parquet"])
    parser.add_argument("--out", required=True, help="folder for changelogs")
    parser.add_argument("--checkpoints", help="folder for checkpoints (default: the shared one)")
    parser.add_argument("--database", help="JDBC URL for keyed results and dimensions")
    parser.add_argument("--database-option", action="append", default=[], metavar="NAME=VALUE",
                        help="a JDBC property such as user, password or driver; repeatable")
    parser.add_argument("--no-rejected", action="store_true",
                        help="do not keep malformed records in <out>/<table>_rejected")
    parser.add_argument("--zones", help="parquet folder to take the zone dimension from")
    parser.add_argument("--max-per-trigger", type=int, help="records (topics) or files per batch")
    parser.add_argument("--files-per-batch", type=int, help="files per batch of a keyed result")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = get_session(f"meterline-{args.job}")
    checkpoints = args.checkpoints or f"{shared_dir(spark)}/meterline-jobs/{args.job}"
    places = Places(
        spark,
        out=args.out,
        state=f"{checkpoints}/carried",
        servers=args.servers,
        folder=args.folder,
        fmt=args.format,
        database=args.database,
        zones=spark.read.parquet(args.zones) if args.zones else None,
        max_per_trigger=args.max_per_trigger,
        files_per_batch=args.files_per_batch,
        database_options=dict(x.split("=", 1) for x in args.database_option),
    )
    outputs = JOBS[args.job](places)
    if not args.no_rejected:
        outputs += places.rejected()
    queries = jobs.start_all(outputs, checkpoints, args.once)
    if args.once:
        jobs.await_all(queries)
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
