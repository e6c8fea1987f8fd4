"""Removal of repeated word windows against brute force over small tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from larder.llm import subtrees

SCHEMA = "doc_id long, text string, id string, spans string, kept int"


def brute_force(rows):
    """Sorted (id, number of words, kept text) by the definition."""
    lists = [(i, (text or "").encode().split()) for i, text in rows]
    seen = {}
    for n, (i, words) in enumerate(lists):
        for at in range(len(words) - 19):
            seen.setdefault(tuple(words[at : at + 20]), []).append((float("-inf") if i is None else i, n, at))
    gone = [set() for _ in lists]
    for places in seen.values():
        least = min(i for i, _, _ in places)
        for i, n, at in places:
            if i > least or any(other == n and before < at for _, other, before in places):
                gone[n].update(range(at, at + 20))
    kept = [(i, len(words), " ".join(w.decode() for at, w in enumerate(words) if at not in gone[n])) for n, (i, words) in enumerate(lists)]
    return sorted(kept, key=str)


def removed(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA).repartition(4)
    found = subtrees.without_repeated_windows(frame, **settings).collect()
    for r in found:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"]) == r["n_words"] - len(r["kept"].split())
    return sorted([(r["doc_id"], r["n_words"], r["kept"]) for r in found], key=str)


def corpus(rng, count):
    """Texts of few words that share passages at all lengths around the window, at odd places, some periodic."""
    passages = [[f"p{i}.{j}" for j in range(rng.randint(17, 60))] for i in range(8)]
    passages += [["x"] * 45, ["y", "z"] * 30, [f"c{j % 7}" for j in range(50)], ["x"] * 19]
    rows = []
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 25))]
            passage = rng.choice(passages)
            low = rng.choice([0, 0, rng.randrange(len(passage))])
            words += passage[low : low + rng.choice([19, 20, 21, 60])]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_brute_force(spark, seed):
    rows = corpus(random.Random(seed), 120)
    assert removed(spark, rows, buckets=5) == brute_force(rows)


def test_groups_that_are_too_large_get_longer_prefixes(spark, monkeypatch):
    """All suffixes in one bucket and room for few: every prefix length is used, also in the tasks."""
    rng = random.Random(7)
    rows = corpus(rng, 60) + [(100 + i, " ".join(["x"] * 12 + [rng.choice("ab") for _ in range(30)])) for i in range(40)]
    found = subtrees.repeated_spans
    rounds = []
    monkeypatch.setattr(subtrees, "CHUNK", 8)
    monkeypatch.setattr(subtrees, "GROUP", 4)
    monkeypatch.setattr(subtrees, "repeated_spans", lambda *a: rounds.append(found(*a)) or rounds[-1])
    assert removed(spark, rows, buckets=1) == brute_force(rows) and len(rounds[0]) == len(subtrees.PREFIXES)


def test_odd_rows(spark):
    words = " ".join(f"ä{i}" for i in range(25))
    rows = [(3, words), (5, words), (5, words), (5, "q " + words), (None, words), (7, None), (8, ""), (9, " \t"), (10, "one two")]
    rows += [(11, "\n".join(words.split())), (12, words.upper()), (None, None), (-4, "again " * 60)]
    assert removed(spark, rows) == brute_force(rows)
    assert removed(spark, rows[1:4]) == brute_force(rows[1:4])
    assert removed(spark, [(1, None)]) == [(1, 0, "")] and removed(spark, []) == []


def test_a_long_text_and_a_hot_passage(spark):
    rng = random.Random(2)
    passage = " ".join(f"h{i}" for i in range(70))
    rows = [(i, f"u{i} {passage} v{i}") for i in range(300)]
    long = [f"l{rng.randrange(10**9)}" for _ in range(30_000)]
    rows += [(1000, " ".join(long + long[500:900])), (1001, " ".join(long[100:140]))]
    found = {i: (n, kept) for i, n, kept in removed(spark, rows, buckets=3)}
    assert found[0] == (72, rows[0][1]) and all(found[i][1] == f"u{i} v{i}" for i in range(1, 300))
    assert found[1000] == (30_400, " ".join(long)) and found[1001] == (40, "")


def test_subtree_depths_are_common_prefixes():
    rng = np.random.default_rng(4)
    counts = rng.integers(1, 9, 60)
    codes = rng.integers(0, 2, (counts + subtrees.SPAN - 1).sum())
    codes[300:330] = codes[100:130]
    zero = np.zeros(60, np.int64)
    group = subtrees.Pieces(np.arange(2, dtype=np.uint64), codes, counts, zero, np.arange(60), zero, zero)
    piece, offset = group.windows()
    suffixes = [codes[i : i + subtrees.SPAN].tolist() for i in group.firsts[piece] + offset]
    order, depth = group.subtree()
    listed = [suffixes[i] for i in order]
    assert listed == sorted(suffixes)
    for a, b, d in zip(listed, listed[1:], depth.tolist(), strict=False):
        assert a[:d] == b[:d] and (d == subtrees.SPAN or a[d] != b[d])
    again = subtrees.Pieces.unpacked(group.packed())
    assert (again.dictionary[again.codes] == group.dictionary[codes]).all() and (again.counts == counts).all()
    stay = rng.random(len(piece)) < 0.7
    left = group.kept(stay)
    piece, offset = left.windows()
    assert [left.codes[i : i + subtrees.SPAN].tolist() for i in left.firsts[piece] + offset] == [x for x, s in zip(suffixes, stay, strict=True) if s]
