from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larder.schema import FILE_LAYOUT  # noqa: E402
from workload.compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def file_products(spark):
    """Raw products in file spelling from tuples of the 11 texts."""
    return lambda *rows: spark.createDataFrame(list(rows), FILE_LAYOUT.raw_schema)


def export_lines() -> list[str]:
    """A 42-line export: 40 products, one of them twice, and a line without a key."""
    lines = ["\t".join(FILE_LAYOUT.columns)]
    for i in range(39):
        kind = i % 4
        values = [50 + 200 * kind + i, 10 * kind, 2 * kind, 5 + 15 * kind, i % 7, kind, 3 + i % 5, "0,1"]
        lines.append("\t".join(map(str, [f"1{i:03d}", f"Item {i}", f"Kind {kind}", *values])))
    for code, name, kind, *values in (
        ("1040", "Wrong by far", "Kind 9", 1733, 31, 9, 55, 21, 6, 17, "0,7"),
        ("1040", "Right on the scale", "", 286, 13, 8, 27, 4, 2, 12, "0,4"),
        ("", "Nameless key", "Kind 9", 73, 6, 2, 19, 8, 4, 5, "0,2"),
    ):
        lines.append("\t".join(map(str, (code, name, kind, *values))))
    return lines


@pytest.fixture
def export_path(tmp_path) -> str:
    path = tmp_path / "products.tsv"
    path.write_text("\n".join(export_lines()) + "\n", encoding="utf-8")
    return str(path)
