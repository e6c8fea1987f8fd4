"""A training cleans its products once, and its model scores those."""

from __future__ import annotations

from larder.operators import clean as operators
from larder.plans import train
from workload import queries


def test_products_are_cleaned_once_for_training_and_scoring(spark, sf_dir, monkeypatch):
    calls = []

    def counted(*given):
        calls.append(given)
        return operators.clean_products(*given)

    monkeypatch.setattr(train, "clean_products", counted)
    monkeypatch.setattr(queries, "clean_products", counted)
    found = queries.segment_products(spark, sf_dir)
    assert len(calls) == 1
    codes = sorted(row["code"] for row in found.select("code").collect())
    assert codes == sorted(row["code"] for row in queries.clean(spark, sf_dir).select("code").collect())
