"""Hard negatives against brute force over small tables, and the bounds they rest on."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, id string, data string, rank int"


def brute_force(rows, is_anchor, k=5):
    """Sorted result rows by the definition; ``rows`` are (id, label, vector)."""
    usable = [
        (i, label, [math.floor(256.0 * float(np.float32(x))) for x in vector])
        for i, label, vector in rows
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = []
    for i, label, vector in usable:
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(vector, w)), j, other) for j, other, w in usable if j != i]
        for rank, (own, j, _) in enumerate(sorted(s for s in scored if s[2] == label)[:k], 1):
            fitting = [s for s in scored if s[2] != label and 80 * -own <= 100 * -s[0] <= 100 * -own]
            found += [(i, j, r, n, -own, -score, rank) for r, (score, n, _) in enumerate(sorted(fitting)[:k], 1)]
    return sorted(found)


def mined(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.mine_hard_negatives(frame, F.col("id") % 10 == 0, **settings).collect()))


def vectors(rng, count, width=20):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(count):
        centre = rng.choice(centres)
        rows.append((i, rng.randrange(3), [x + rng.gauss(rng.choice([0, 0.5]), 0.4) for x in centre]))
    return rows


@pytest.mark.parametrize("block", [17, 8192])
def test_equal_to_brute_force(spark, block):
    rows = vectors(random.Random(block), 230)
    expected = brute_force(rows, lambda i: i % 10 == 0)
    assert len(expected) > 100 and mined(spark, rows, block=block) == expected


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = vectors(rng, 60, 3)
    rows += [(i, 1, [0.5, 0.25, 1.0]) for i in (100, 110, 117, 118, 119, 120)]  # ties
    rows += [(i, 2, [0.5, 0.25, 1.0]) for i in (130, 131)] + [rows[7], rows[7], rows[20], (12, 0, [1.0, 1.0, 1.0])]  # repeated ids
    rows += [(140, None, [1.0] * 3), (150, 1, None), (160, 1, [1.0, None, 1.0]), (170, 2, [float("nan")] * 3)]
    rows += [(180, 2, [float("inf"), 0.0, 0.0]), (None, 1, [9.0] * 3), (190, 7, [1.0] * 3), (200, 0, []), (210, 1, [2.0])]
    rows += [(220, 0, [-3.0, 0.0, 0.0]), (221, 0, [3.0, 0.0, 0.0])]  # a negative score allows nothing
    assert mined(spark, rows, block=13) == brute_force(rows, lambda i: i % 10 == 0)


def test_empty_tables_and_no_anchors(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, 1, [1.0])]) == [] and mined(spark, [(3, 1, [1.0]), (4, 1, [1.0])]) == []


def test_large_components_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, i % 2, [rng.uniform(0, 1.0) * 2**20 for _ in range(6)]) for i in range(80)]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(1, 1, [1e30])])


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(3)
    table = rng.integers(-500, 500, (60, 64)) + rng.integers(-300, 300, (60, 1))
    blob = negatives.packed_block(np.arange(60), np.zeros(60, np.int64), table)
    block = negatives.Block(blob, 64)
    scores, widths = table @ table.T, []
    for level in block.levels:
        middle, radius = negatives._bounds(level, level, None)
        assert (np.abs(scores - middle) <= radius + 1e-5 * np.outer(block.norms, block.norms)).all()
        widths.append(radius.mean())
    assert widths[0] > widths[1] > widths[2] > 0


def test_bounds_spare_exact_scores():
    """Vectors with different segment means: most pairs are settled without their score."""
    rng = np.random.default_rng(6)
    shape = np.repeat(rng.normal(0, 400, (900, 16)), 4, axis=1)
    table = (shape + rng.normal(0, 30, (900, 64))).astype(np.int64)
    rows = negatives.Block(negatives.packed_block(np.arange(900), np.zeros(900, np.int64), table), 64)
    some, others = np.arange(40), np.arange(900)
    scores = table[:40] @ table.T
    low = np.sort(scores, axis=1)[:, -6].astype(float)
    at, _, found = negatives.scored_pairs(rows, some, rows, others, np.ones((40, 900), bool), low, np.full(40, np.inf))
    assert len(at) < 0.05 * scores.size and set(scores[scores >= low[:, None]].tolist()) <= set(found.tolist())
