"""Store how often each word occurs in text files, most frequent first."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from larder.jobs.options import session
from larder.operators.text import word_count
from larder.sources.files import read_lines


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="text files, one line per row")
    parser.add_argument("--output", required=True, help="folder for the tab-separated counts")
    options = parser.parse_args(arguments)
    lines = read_lines(session("count-words"), options.input)
    word_count(lines).write.mode("overwrite").csv(options.output, sep="\t")


if __name__ == "__main__":
    main()
