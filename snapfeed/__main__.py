"""Command-line entry points (run with ``spark-submit -m``-style launchers or
``python -m snapfeed``):

* ``ingest``: process every file landed so far (availableNow) for one feed;
* ``sql``: run a SQL script file (statements in order) and show the last result.
"""

from __future__ import annotations

import argparse
import sys

from snapfeed.session import get_session


def _ingest(args) -> None:
    from snapfeed.plans.feeds import RX_FEED_COLUMNS
    from snapfeed.streaming.ingest import RxFeedIngest, SummaryIngest, cell_columns, csv_file_stream, run_available

    spark = get_session(args.master)
    if args.feed == "rx":
        handler = RxFeedIngest(spark, args.history, args.staging_table, args.staging_root, args.prefix,
                               ndc_value=args.ndc, placeholder=args.placeholder, base_amount=args.base_amount,
                               statuses=args.statuses.split(","), row_level_table=args.row_level_table,
                               excluded_keys=[tuple(k.split("|")) for k in args.exclude_key],
                               partition_by_month=not args.whole_table, partitions=args.partitions,
                               **({"date_formats": tuple(args.date_format)} if args.date_format else {}))
        columns, header, glob = RX_FEED_COLUMNS, True, f"*{args.prefix}*"
    else:
        handler = SummaryIngest(spark, args.history, args.label, rx_prefix=args.prefix, partitions=args.partitions,
                                **({"timestamp_formats": tuple(args.date_format)} if args.date_format else {}))
        columns, header, glob = cell_columns(args.max_columns), False, None
    stream = csv_file_stream(spark, args.landing, columns, glob=glob, max_files_per_trigger=args.max_files,
                             quoted_newlines=not args.no_quoted_newlines, header=header)
    run_available(stream, args.checkpoint, handler)


def _sql(args) -> None:
    from snapfeed.sources.tables import run_script

    spark = get_session(args.master)
    with open(args.script, encoding="utf-8") as f:
        result = run_script(spark, f.read())
    if result is not None and args.show:
        result.show(args.show, truncate=False)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="snapfeed")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="clean and load newly landed feed files")
    ing.add_argument("feed", choices=["rx", "summary"])
    ing.add_argument("--landing", required=True)
    ing.add_argument("--checkpoint", required=True, help="stream checkpoint folder (the ledger of seen files)")
    ing.add_argument("--history", required=True, help="snapshot history path (partitioned by _snapshot_date)")
    ing.add_argument("--prefix", required=True, help="prescription feed name prefix")
    ing.add_argument("--label", default=None, help="benefit-summary label (summary feed)")
    ing.add_argument("--max-columns", type=int, default=128, help="cells read per summary row; its header names them")
    ing.add_argument("--date-format", action="append", default=[], help="accepted date pattern, may be repeated")
    ing.add_argument("--exclude-key", action="append", default=[],
                     help="patient|rx|serial|dispense date to leave out, may be repeated")
    ing.add_argument("--no-quoted-newlines", action="store_true",
                     help="cells have no line ends, so a large file can be read by several tasks")
    ing.add_argument("--partitions", type=int, default=None, help="spread the cleaning over this many tasks")
    ing.add_argument("--staging-table", default=None)
    ing.add_argument("--staging-root", default=None)
    ing.add_argument("--ndc", type=int, default=None)
    ing.add_argument("--placeholder", default=None)
    ing.add_argument("--base-amount", type=float, default=0.0)
    ing.add_argument("--statuses", default="")
    ing.add_argument("--row-level-table", action="store_true")
    ing.add_argument("--whole-table", action="store_true",
                     help="rewrite the whole staging table each time, not only the dispense months touched")
    ing.add_argument("--max-files", type=int, default=1000)
    ing.set_defaults(run=_ingest)

    sq = sub.add_parser("sql", help="run a SQL script file")
    sq.add_argument("script")
    sq.add_argument("--show", type=int, default=20)
    sq.set_defaults(run=_sql)

    args = p.parse_args(argv)
    if args.cmd == "ingest" and args.feed == "rx" and not (args.staging_table and args.staging_root):
        p.error("rx ingest needs --staging-table and --staging-root")
    if args.cmd == "ingest" and args.feed == "summary" and not args.label:
        p.error("summary ingest needs --label")
    args.run(args)


if __name__ == "__main__":
    main(sys.argv[1:])
