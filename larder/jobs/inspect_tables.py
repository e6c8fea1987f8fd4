"""Print the row count of every cell table; print or store the status of every run."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from larder.jobs.options import session
from larder.plans.tables import CellTables


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the cell tables")
    parser.add_argument("--output", help="folder for the run statuses as CSV; default: print all of them")
    options = parser.parse_args(arguments)
    tables = CellTables(session("inspect"), options.tables)
    for row in tables.row_counts().collect():
        print(f"table {row['table_name']} holds {row['rows']} keys")
    statuses = tables.run_statuses()
    if options.output:
        statuses.write.mode("overwrite").option("header", True).csv(options.output)
        return
    for row in statuses.orderBy("run_id").toLocalIterator():
        print(f"run {row['run_id']} is {row['status']}")


if __name__ == "__main__":
    main()
