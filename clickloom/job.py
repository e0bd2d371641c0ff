"""Batch job for spark-submit.

    spark-submit job.py --input IN --store STORE --output OUT --pepper-file KEY [--hr HR]
                        [--full-refresh | --file FILE] [--verify-all] [--date-column NAME ...]
                        [--blank-gpn-is-null] [--pad-hr-gpn] [--merge-mode lag|running_max]
                        [--count-first-event] [--valid-is-no-skip]
"""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from clickloom.plans.pipeline import Options, run
from clickloom.session import build_session

log = logging.getLogger("clickloom")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Ingest click exports and publish tables.")
    parser.add_argument("--input", required=True, help="folder of dated CSV exports")
    parser.add_argument("--store", required=True, help="folder of the accumulated events")
    parser.add_argument("--output", required=True, help="folder for published tables")
    parser.add_argument("--pepper-file", required=True, help="file with the hash key, kept elsewhere")
    parser.add_argument("--hr", help="Parquet table of monthly organisation snapshots")
    how = parser.add_mutually_exclusive_group()
    how.add_argument("--full-refresh", action="store_true", help="reload all files into a new store")
    how.add_argument("--file", help="load this one file whatever the manifest says")
    parser.add_argument("--verify-all", action="store_true", help="hash all files, whatever their length and time")
    parser.add_argument("--date-column", action="append", help="a column of times besides the event time")
    parser.add_argument("--merge-mode", choices=("lag", "running_max"), default="lag", help="how watched stretches merge")
    for flag in ("blank-gpn-is-null", "pad-hr-gpn", "count-first-event", "valid-is-no-skip"):
        parser.add_argument(f"--{flag}", action="store_true")
    return parser.parse_args(argv)


def options(args: argparse.Namespace) -> Options:
    return Options(
        date_columns=tuple(args.date_column) if args.date_column else None,
        verify_all=args.verify_all,
        blank_gpn_is_null=args.blank_gpn_is_null,
        pad_hr_gpn=args.pad_hr_gpn,
        merge_mode=args.merge_mode,
        count_first_event=args.count_first_event,
        valid_is_no_skip=args.valid_is_no_skip,
    )


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    args = arguments(argv)
    pepper = Path(args.pepper_file).read_text().strip()
    if not pepper:
        raise ValueError("the hash key is empty")
    mode = "full_refresh" if args.full_refresh else "file" if args.file else "delta"
    published = run(
        build_session(), args.file or args.input, args.store, args.output, pepper, args.hr, mode, options(args)
    )
    if published is None:
        log.info("all files already processed")
        return 0
    if published.ingested is not None:
        for name, reason in published.ingested.files.items():
            log.info("%s (%s): %d rows", name, reason, published.ingested.row_counts[name])
    for name, path in published.tables.items():
        log.info("%s -> %s", name, path)
    for name in published.reports:
        log.info("%s -> %s/reports/%s", name, args.output, name)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
