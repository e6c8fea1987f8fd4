"""Train on a tab-separated export file."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from larder.jobs.options import add_model_options, session
from larder.plans.train import train_products
from larder.sources.files import read_products_tsv


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    add_model_options(parser)
    options = parser.parse_args(arguments)
    run = train_products(
        read_products_tsv(session("train-file"), options.input),
        options.clusters,
        options.seed,
        options.max_iterations,
        options.output,
    )
    print(
        f"Training completed: input_rows={run.input_rows}, usable_rows={run.usable_rows}, "
        f"silhouette={run.silhouette:.4f}, clusters={run.cluster_sizes}"
    )


if __name__ == "__main__":
    main()
