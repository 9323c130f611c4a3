"""Command-line entry: ``python -m daybook <command> ...`` (or the same file under spark-submit).

``agg``       prices + transactions → daily aggregates + dead letters (batch, or
              micro-batch with ``--stream``).
``snapshot``  landed price pages (JSON) → price CSV.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from daybook.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="daybook")
    sub = p.add_subparsers(dest="command", required=True)

    agg = sub.add_parser("agg", help="aggregate transactions into daily USD volume per project")
    agg.add_argument("-c", "--prices", "--input-currencies", dest="prices", required=True,
                     help="price CSV (ID,Symbol,Name,Price (USD)); any Hadoop URI")
    agg.add_argument("-t", "--transactions", "--input-transactions", dest="transactions", required=True,
                     help="transaction CSV file or folder with a header")
    agg.add_argument("-o", "--output", required=True,
                     help="aggregate CSV location, or table://catalog/database/table")
    agg.add_argument("-e", "--errors", "--output-error", dest="errors", required=True,
                     help="dead-letter CSV location")
    agg.add_argument("-p", "--parallelism", type=int, default=None,
                     help="shuffle partitions (default: the session's setting)")
    agg.add_argument("--files-per-batch", type=int, default=None, help="with --stream: files per micro-batch")
    agg.add_argument("--bytes-per-batch", type=int, default=None,
                     help="with --stream: bytes of files per micro-batch (default 1 GiB)")
    agg.add_argument("--work-dir", default=None,
                     help="with --stream: folder with the stream's state; a later run with it goes on from there")
    agg.add_argument("--compact", action="store_true", help="with --stream: fold the batches' partials at the end")
    agg.add_argument("--stream", action="store_true", help="run as a micro-batch stream over the folder")
    agg.add_argument("--on-unknown", choices=("fail", "dead_letter"), default="fail")
    agg.add_argument("--on-malformed", choices=("fail", "dead_letter"), default="fail")
    agg.add_argument("--table-mode", choices=("append", "replace"), default="append")
    agg.add_argument("--multi-line", action="store_true",
                     help="quoted fields hold line breaks (without --stream this is found out by itself)")
    agg.add_argument("--mixed-headers", action="store_true", help="files may differ in their header (not with --stream)")
    agg.add_argument("--master", default=None, help="Spark master (leave unset under spark-submit)")

    snap = sub.add_parser("snapshot", help="landed price pages → price CSV")
    snap.add_argument("--pages", required=True, help="folder of JSON pages (arrays of coins)")
    snap.add_argument("-o", "--output", required=True)
    snap.add_argument("--multi-line", action="store_true", help="pretty-printed page files")
    snap.add_argument("--master", default=None)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master, shuffle_partitions=getattr(args, "parallelism", None))
    if args.command == "snapshot":
        from daybook.plans.jobs import price_snapshot

        result = {"prices_written": price_snapshot(spark, args.pages, args.output, args.multi_line)}
    elif args.stream:
        from daybook.sinks.files import write_dead_letters_csv
        from daybook.sinks.table import aggregate_sink
        from daybook.sources.files import read_prices
        from daybook.streaming.microbatch import (
            compact_partials,
            merged_daily_volume,
            run_daily_volume_stream,
            stream_dead_letters,
            transaction_stream,
        )

        run = run_daily_volume_stream(
            spark,
            transaction_stream(spark, args.transactions, max_files_per_trigger=args.files_per_batch,
                               max_bytes_per_trigger=args.bytes_per_batch, on_malformed=args.on_malformed,
                               multi_line=args.multi_line),
            read_prices(spark, args.prices),
            work_dir=args.work_dir,
            on_unknown=args.on_unknown,
        )
        if args.compact:
            compact_partials(spark, run, through_batch=(1 << 62))
        aggregate_sink(args.output, mode=args.table_mode)(merged_daily_volume(spark, run))
        write_dead_letters_csv(stream_dead_letters(spark, run), args.errors)
        result = asdict(run)
    else:
        from daybook.plans.jobs import daily_volume_job

        report = daily_volume_job(
            spark, args.transactions, args.prices, args.output, args.errors,
            on_unknown=args.on_unknown, on_malformed=args.on_malformed, table_mode=args.table_mode,
            multi_line=args.multi_line or None, mixed_headers=args.mixed_headers,
        )
        result = asdict(report)
    print(json.dumps(result))
    return result


def run() -> None:
    """Console-script entry (exit status 0 on success)."""
    main()


if __name__ == "__main__":
    run()
