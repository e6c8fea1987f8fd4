"""A single file of predictions is written in order by a task that holds none of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.sources.outputs import in_one_task, read_predictions, write_predictions
from larder.sources.scratch import stored


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def records(spark, rows):
    numbers = spark.range(0, rows, 1, 6).orderBy(F.hash("id"))
    text = F.format_string("%05d", "id")
    return numbers.select(text.alias("code"), F.lit("n").alias("product_name"), F.lit(None).cast("string").alias("categories"), F.lit(1).alias("cluster"))


def test_the_task_that_writes_one_file_does_not_sort(spark, tmp_path):
    path = tmp_path / "predictions"
    write_predictions(records(spark, 3000), str(path), single_file=True)
    files = [at for at in path.iterdir() if at.name.startswith("part-")]
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert len(lines) == 3000 and lines == sorted(lines)
    assert read_predictions(spark, str(path)).count() == 3000
    with stored(records(spark, 3000).repartitionByRange(5, "code").sortWithinPartitions("code"), "ordered") as ordered:
        single = in_one_task(ordered)
        assert len(ordered.inputFiles()) == 5 and single.rdd.getNumPartitions() == 1
        assert [row["code"] for row in single.collect()] == [f"{i:05d}" for i in range(3000)]
        assert "Sort" not in plan(single) and "Exchange" not in plan(single)
