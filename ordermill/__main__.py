"""``python -m ordermill customers.csv products.csv orders.csv TARGET``"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from ordermill.runs import run_batch
from ordermill.session import build_session


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordermill", description=__doc__)
    for name in ("customers", "products", "orders"):
        parser.add_argument(name, help=f"CSV file or folder of the {name} feed")
    parser.add_argument("target", help="folder the sales fact is stored in")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    parser.add_argument("--flat", action="store_true", help="no subfolder per month")
    parser.add_argument("--date-format", action="append", help="accepted date shape, repeatable; told from the first dates if left out")
    parser.add_argument(
        "--single-line-cells",
        action="store_true",
        help="the feeds have no line breaks inside cells; spares a pass over them",
    )
    options = parser.parse_args(arguments)

    spark = build_session(master=options.master)
    run = run_batch(
        spark,
        options.customers,
        options.products,
        options.orders,
        options.target,
        by_month=not options.flat,
        date_formats=options.date_format,
        multi_line=False if options.single_line_cells else None,
    )
    for name, detail in run.details.items():
        print(f"\n{name}")
        detail.show(detail.count(), truncate=False)


if __name__ == "__main__":
    main()
