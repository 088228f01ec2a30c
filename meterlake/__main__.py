"""``spark-submit``/``python -m meterlake`` entry: choose steps, tables and parameters."""

from __future__ import annotations

import argparse
import json

from meterlake.params import Params
from meterlake.plans.jobs import STEPS, Marts, run
from meterlake.session import session
from meterlake.sources import Tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="meterlake")
    parser.add_argument("--steps", required=True, help=f"comma-separated, of {', '.join(STEPS)}")
    parser.add_argument("--marts", required=True, help="folder of the result tables")
    parser.add_argument("--tables", help="folder of parquet source tables; default is the catalog")
    parser.add_argument("--schemas", default="{}", help="JSON: schema per table, '' for the default")
    parser.add_argument("--names", default="{}", help="JSON: physical name per logical table")
    parser.add_argument("--checked", action="store_true", help="leave out source rows that do not fit the declared schemas")
    parser.add_argument("--run-id", help="note finished steps under this id, and skip them when started again")
    parser.add_argument("--params", required=True, help="JSON object, for example {\"as_of\": \"2024-01-20\"}")
    args = parser.parse_args(argv)

    spark = session()
    tables = Tables(
        spark, args.tables, json.loads(args.schemas), json.loads(args.names), checked=args.checked
    )
    steps = [s.strip() for s in args.steps.split(",") if s.strip()]
    done = run(steps, tables, Marts(args.marts), Params.from_json(args.params), args.run_id)
    for step, rows in done.items():
        print(f"{step}: {rows} rows")


if __name__ == "__main__":
    main()
