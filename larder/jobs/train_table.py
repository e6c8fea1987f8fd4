"""Train on the raw cell table and put the results back into the cell tables."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from larder.jobs.options import add_model_options, positive_int, session
from larder.plans.tables import CellTables, train_from_table


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the cell tables")
    parser.add_argument("--scan-limit", type=positive_int, help="only the first keys; default all")
    add_model_options(parser)
    options = parser.parse_args(arguments)
    run_id = str(uuid.uuid4())
    run = train_from_table(
        CellTables(session("train-table"), options.tables),
        run_id,
        options.clusters,
        options.seed,
        options.max_iterations,
        options.output,
        options.scan_limit,
    )
    print(
        f"Run {run_id} completed: read={run.input_rows}, published={run.usable_rows}, "
        f"silhouette={run.silhouette:.4f}"
    )


if __name__ == "__main__":
    main()
