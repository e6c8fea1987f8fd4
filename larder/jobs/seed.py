"""Load a tab-separated export file into the raw cell table."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from larder.jobs.options import session
from larder.plans.tables import CellTables
from larder.sources.files import read_products_tsv


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--tables", required=True, help="folder of the cell tables")
    options = parser.parse_args(arguments)
    spark = session("seed")
    products = read_products_tsv(spark, options.input)
    counts = CellTables(spark, options.tables).seed(products)
    print(f"Seeded {counts['seeded']} source rows into the raw table, {counts['rejected']} rejected")


if __name__ == "__main__":
    main()
