"""Every registered query that has SQL gives the SQL's rows, and the entry point keeps its contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from workload.compare import duck, duck_bag, spark_bag
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, connection, name):
    frame = QUERIES[name](spark, sf_dir)
    sql = ORACLE[name]
    names = [column[0] for column in connection.execute(sql).description]
    assert sorted(frame.columns) == sorted(names)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for avoided in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert avoided not in plan
    found, expected = spark_bag(frame), duck_bag(connection, sql)
    assert expected.total() > 0
    assert found == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_one_cluster_per_product(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["code", "product_name", "categories", "cluster"]
    rows = frame.collect()
    assert len({row["code"] for row in rows}) == len(rows) > 0
    assert {row["cluster"] for row in rows} == {0, 1, 2, 3}
