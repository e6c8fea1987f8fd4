"""Periodic runs against brute force over small texts, and the query against a plain rewriting of the contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import periods
from larder.llm.queries import QUERIES


def runs_by_definition(words, exponent=4, least=6):
    found = {}
    for period in range(1, len(words) // exponent + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(least, exponent * period):
                found.setdefault((at, end + period), period)  # the smallest comes first
            at = max(end, at) + 1
    return sorted((b, e, p) for (b, e), p in found.items())


def periodic_words(rng, letters):
    words = []
    for _ in range(rng.randint(0, 6)):
        words += [rng.choice(letters) for _ in range(rng.randint(0, 12))]
        cycle = [rng.choice(letters) for _ in range(rng.randint(1, 45))]
        if rng.random() < 0.4 and len(cycle) > 4:  # periodic inside its period as well
            cycle = cycle[:2] * (len(cycle) // 2) + cycle[:1]
        words += (cycle * 8)[: rng.randint(1, 7) * len(cycle) + rng.randint(0, len(cycle))]
    return words


def test_runs_equal_the_definition():
    rng = random.Random(11)
    for trial in range(400):
        words = periodic_words(rng, ["a", "b", "c"][: 2 + trial % 2] if trial % 3 else [f"w{i}" for i in range(40)])
        code = np.array([hash(word) % 1000 for word in words], np.int64)
        assert periods.runs_of(code) == runs_by_definition(code.tolist())


def test_runs_of_many_documents_stay_apart():
    rng = random.Random(4)
    lists = [[word.encode() for word in periodic_words(rng, ["x", "y"])] for _ in range(150)] + [[], [b"z"], [b"z"] * 6, [b"z"] * 5]
    assert periods.runs_by_document(lists, 4, 6) == [runs_by_definition(words) for words in lists]


def test_long_periods_and_long_texts():
    rng = random.Random(8)
    cycle = [rng.randrange(10**6) for _ in range(5003)]
    code = np.array([1, 2, 3] + cycle * 4 + cycle[:77] + [4, 5] * 9000 + [6], np.int64)
    runs = periods.runs_of(code)
    assert (3, 3 + 4 * 5003 + 77, 5003) in runs and [r for r in runs if r[2] == 2] == [(20092, 38092, 2)]
    assert periods.runs_of(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def test_too_low_an_exponent_is_refused():
    with pytest.raises(ValueError):
        periods.runs_of(np.zeros(10, np.int64), exponent=3)


def test_edges_of_the_table(spark):
    rows = [(1, "a " * 9 + "b", "x"), (None, None, None), (2, "", "y"), (1, " \t\n", "y"), (3, "ä ä " * 6, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("n_words", F.lit(7))
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(frame).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 10, [(0, 9, 1)], "a b"), (None, 0, [], ""), (2, 0, [], ""), (1, 0, [], ""), (3, 6, [(0, 6, 1)], "ä ä")], key=str
    )
    assert periods.periodic_runs(frame.limit(0)).isEmpty()


def digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_definition(words)
    best = max(runs, key=lambda r: ((r[1] - r[0]) / r[2], -r[0], -r[2]), default=None)
    gone = {i for b, e, p in runs for i in range(b + p, e)}
    kept = " ".join(word for i, word in enumerate(words) if i not in gone)
    lines = "".join(f"{b},{e - b},{p}\n" for b, e, p in runs)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    if best is None:
        return (doc_id, 0, None, None, None, None, *sha)
    length = best[1] - best[0]
    return (doc_id, len(runs), best[0], length, best[2], 1000 * length // best[2], *sha)


def test_query_equals_the_contract(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = {tuple(r[c] for c in columns) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert found == {digest(r["doc_id"], r["text"]) for r in documents}
    assert sum(row[1] > 0 for row in found) > 5
