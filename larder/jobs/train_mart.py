"""Refresh the product mart from the raw cell table, train on it, publish the results."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from larder.jobs.options import add_model_options, session
from larder.operators.prepare import assemble
from larder.plans.mart import ProductMart
from larder.plans.tables import CellTables
from larder.plans.train import train_prepared


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the cell tables")
    parser.add_argument("--mart", required=True, help="folder of the mart")
    add_model_options(parser)
    options = parser.parse_args(arguments)
    spark = session("train-mart")
    mart = ProductMart(spark, options.mart)
    run_id = str(uuid.uuid4())
    refreshed = mart.refresh(
        CellTables(spark, options.tables).raw_products(), version=str(uuid.uuid4())
    )
    mart.require_current(refreshed)
    with mart.tracked_run(run_id):
        run = train_prepared(
            assemble(mart.snapshot(refreshed.version)),
            options.clusters,
            options.seed,
            options.max_iterations,
            options.output,
        )
        # Published against the version trained on, whatever is current by now.
        published = mart.publish(
            run_id,
            run.assigned.select("code", "cluster"),
            run.silhouette,
            version=refreshed.version,
        )
    print(
        f"Mart version {refreshed.version}: trained={run.usable_rows}, "
        f"published={published}, silhouette={run.silhouette:.4f}"
    )


if __name__ == "__main__":
    main()
