"""Command line: run the whole pipeline and print the load summary.

    python -m martforge --tables /root/testdata/sf0.1         # fixture views over Parquet tables
    python -m martforge --csv /data/raw [--out /shared/star]  # four raw CSV files

A second run with the same ``--out`` maintains the star that is there.

Outputs go to ``--out`` or to a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from .plans.jobs import run
from .session import build_session, new_work_dir
from .sources.csv import read_raw_tables


def main() -> None:
    ap = argparse.ArgumentParser(prog="martforge")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with the Parquet input tables")
    src.add_argument("--csv", help="folder with customers.csv, orders.csv, products.csv, order_items.csv")
    ap.add_argument("--file", action="append", default=[], metavar="TABLE=NAME",
                    help="name of a raw CSV file, e.g. customers=people.csv")
    ap.add_argument("--multi-line", action="store_true", help="allow line breaks inside quotes (files are not split)")
    ap.add_argument("--long-rows", choices=["error", "skip"], default="error", help="rows with more fields than the header")
    ap.add_argument("--out", help="output folder (default: under spark.checkpoint.dir); an existing one is maintained")
    ap.add_argument("--clean-csv", help="folder for the cleaned tables as CSV")
    ap.add_argument("--master", default=None)
    args = ap.parse_args()
    spark = build_session(master=args.master)
    root = args.out or new_work_dir(spark, "run")
    files = dict(f.split("=", 1) for f in args.file)
    raw = read_raw_tables(spark, args.csv, files, args.multi_line, args.long_rows) if args.csv else None
    summary = run(spark, args.tables, root=root, raw_tables=raw, csv_out=args.clean_csv)
    summary.show(100, truncate=False)
    print(f"tables written under {root}")
    spark.stop()


if __name__ == "__main__":
    main()
