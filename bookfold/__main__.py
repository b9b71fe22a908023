"""``python -m bookfold``: one monthly run."""

from __future__ import annotations

import argparse

from bookfold.plans.monthly_run import run_refinery
from bookfold.schemas import GENERIC_COLUMNS
from bookfold.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="bookfold", description="Load, refine and check one month of extracts.")
    parser.add_argument("--landing", required=True, help="directory holding the monthly files")
    parser.add_argument("--root", required=True, help="directory of the stored tables")
    parser.add_argument("--month", help="YYYYMM; default: the latest month named by the chosen files")
    parser.add_argument("--keep-going", action="store_true", help="succeed even when quality checks find errors")
    parser.add_argument("--generic-columns", type=int, default=GENERIC_COLUMNS)
    parser.add_argument("--shuffle-bytes", type=int, default=1 << 40, help="what the widest shuffle may move; small partitions are merged")
    args = parser.parse_args()
    stats = run_refinery(
        build_session(shuffle_bytes=args.shuffle_bytes),
        args.landing,
        args.root,
        target_month=args.month,
        fail_on_quality_errors=not args.keep_going,
        generic_columns=args.generic_columns,
    )
    print(f"{stats.run_id} {stats.target_month} {stats.status}: {stats.source_rows_created} source rows")


if __name__ == "__main__":
    main()
