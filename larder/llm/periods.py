"""Operator 12: periodic runs of words by string synchronising sets.

A run is a maximal stretch of words that repeats with its smallest period at least ``exponent`` times. Runs are
proposed scale by scale, each scale ``t`` a power of two responsible for the periods ``t`` to ``2 t - 1``:

* Every stretch of ``t`` words has a hashed name. A position synchronises if the least name of the ``t + 1`` names
  from it on stands at one of the two ends, so membership depends on ``2 t`` words only, and of any ``t``
  neighbouring positions one is a member.
* Names inside highly periodic regions (of period ``t / exponent`` at most) take no part, which keeps the set sparse.
  Those regions are exactly the runs that smaller scales have supplied; periods below ``SMALL`` are detected
  separately, by comparing the words at that distance.
* A member and the next one with an equal context of ``2 t`` words propose their distance as a period. In a run of
  period p, ``t <= p < 2 t``, with at least 4 p words, some member and its copy one period on have their
  contexts inside the run, and no nearer copy exists, so no run is missed.

A proposal becomes a run by comparing words in both directions, so hashes propose but never decide. Of proposals for
one stretch the smallest period stays: by the periodicity lemma the others are its multiples.

All of it runs per document inside the task that reads the document: no exchange, and memory for one stretch of
documents (``STRETCH`` words, or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL = 8
STRETCH = 1 << 19

_U = np.uint64
_TOP = _U(0xFFFFFFFFFFFFFFFF)

Run = tuple[int, int, int]  # start, end, period


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _ahead(values: np.ndarray, by: int, fill: np.uint64) -> np.ndarray:
    """``values`` moved ``by`` places to the front, filled up at the end."""
    moved = np.full_like(values, fill)
    if by < len(values):
        moved[: len(values) - by] = values[by:]
    return moved


def _doubled(names: np.ndarray, length: int) -> np.ndarray:
    """Names of twice the length. What runs past the end contains a separator, so its name occurs once."""
    return _mixed(names * _U(0x9E3779B97F4A7C15) + _ahead(names, length, _U(0)))


def small_periods(code: np.ndarray, exponent: int, least: int) -> Iterator[Run]:
    """Runs of periods below ``SMALL``, by comparing every word with the one a period later."""
    for period in range(1, min(SMALL, len(code))):
        same = np.zeros(len(code) - period + 2, np.int8)
        same[1:-1] = code[:-period] == code[period:]
        edges = np.flatnonzero(np.diff(same))
        start, end = edges[::2], edges[1::2] + period
        long_enough = end - start >= max(least, exponent * period)
        for b, e in zip(start[long_enough].tolist(), end[long_enough].tolist(), strict=True):
            yield b, e, period


def _excluded(count: int, length: int, runs: list[Run], exponent: int) -> np.ndarray:
    """Positions whose next ``length`` words lie in a run of a period of ``length / exponent`` at most."""
    change = np.zeros(count + 1, np.int32)
    for b, e, period in runs:
        if period * exponent <= length <= e - b:
            change[b] += 1
            change[e - length + 1] -= 1
    return np.cumsum(change[:-1]) > 0


def synchronising(names: np.ndarray, length: int, excluded: np.ndarray) -> np.ndarray:
    """Positions where the least of the ``length + 1`` names from there on stands at an end."""
    own = np.where(excluded, _TOP, names)
    least, span = own, 1
    while span < length:
        least = np.minimum(least, _ahead(least, span, _TOP))
        span *= 2
    last = _ahead(own, length, _TOP)
    least = np.minimum(least, last)
    return np.flatnonzero((least != _TOP) & ((least == own) | (least == last)))


def _extent(code: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` in which words ``period`` apart are identical."""
    end, step = at + period, 64
    while end < len(code):
        part = code[end : end + step]
        differs = np.flatnonzero(part != code[end - period : end - period + len(part)])
        if len(differs):
            end += int(differs[0])
            break
        end, step = end + len(part), step * 2
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        differs = np.flatnonzero(code[low:start] != code[low + period : start + period])
        if len(differs):
            start = low + int(differs[-1]) + 1
            break
        start, step = low, step * 2
    return start, end


def runs_of(code: np.ndarray, exponent: int = 4, least: int = 6, longest: int | None = None) -> list[Run]:
    """All runs of an array of word codes, by start and then period.

    Documents may be put one after another if a code that occurs once follows each of them: no run reaches past it,
    and with the ``longest`` document given no scale beyond it is looked at.
    """
    if exponent < 4 or least > SMALL:
        raise ValueError(f"exponent of at least 4 and length of at most {SMALL} expected, got {exponent} and {least}")
    code = np.asarray(code)
    longest = len(code) if longest is None else longest
    found = list(small_periods(code, exponent, least))
    names, length = _mixed(code.astype(_U) + _U(1)), 1
    while length < SMALL:
        names, length = _doubled(names, length), length * 2
    while longest >= exponent * length:
        contexts = _doubled(names, length)
        members = synchronising(names, length, _excluded(len(code), length, found, exponent))
        context = contexts[members]
        order = np.argsort(context, kind="stable")
        members, context = members[order], context[order]
        distance = np.diff(members)
        proposed = np.flatnonzero((context[1:] == context[:-1]) & (distance < 2 * length))
        by = np.lexsort((members[proposed], distance[proposed]))
        starts, periods = members[proposed][by].tolist(), distance[proposed][by].tolist()
        known = (-1, -1, 0)
        for at, period in zip(starts, periods, strict=True):
            if known[2] == period and known[0] <= at and at + period < known[1]:
                continue  # another member of the stretch just compared
            known = (*_extent(code, at, period), period)
            if known[1] - known[0] >= max(least, exponent * period):
                found.append(known)
        names, length = contexts, length * 2
    smallest: dict[tuple[int, int], int] = {}
    for b, e, period in found:
        smallest[b, e] = min(period, smallest.get((b, e), period))
    return sorted(((b, e, period) for (b, e), period in smallest.items()), key=lambda run: (run[0], run[2]))


def _stretches(lists: list[list[bytes]]) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Documents put together up to ``STRETCH`` words; those of one size class meet, so that scales fit them all."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]).bit_length())
    held: list[int] = []
    size = 0
    for i in order:
        if held and (size + len(lists[i]) > STRETCH or len(lists[i]).bit_length() != len(lists[held[0]]).bit_length()):
            yield held, [lists[j] for j in held]
            held, size = [], 0
        held.append(i)
        size += len(lists[i])
    if held:
        yield held, [lists[j] for j in held]


def runs_by_document(lists: list[list[bytes]], exponent: int, least: int) -> list[list[Run]]:
    """The runs of every list of words, with positions counted from the start of the list."""
    found: list[list[Run]] = [[] for _ in lists]
    for numbers, texts in _stretches(lists):
        sizes = np.array([len(words) for words in texts])
        if sizes.max() < least:
            continue
        words = pa.array([word for text in texts for word in text], pa.binary()).dictionary_encode()
        ends = np.cumsum(sizes + 1)
        code = np.empty(int(ends[-1]), np.int64)
        separator = np.zeros(len(code), bool)
        separator[ends - 1] = True
        code[~separator] = words.indices.to_numpy(zero_copy_only=False)
        code[separator] = len(words.dictionary) + np.arange(len(texts))
        for b, e, period in runs_of(code, exponent, least, int(sizes.max())):
            i = int(np.searchsorted(ends, b, side="right"))
            base = int(ends[i] - sizes[i] - 1)
            found[numbers[i]].append((b - base, e - base, period))
    return found


def _collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats (all but those after a run's first period), joined by one space."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for b, e, period in runs:
        dropped[b + period] += 1
        dropped[e] -= 1
    keeps = (np.cumsum(dropped[:-1]) == 0).tolist()
    return b" ".join([word for word, keep in zip(words, keeps, strict=True) if keep])


RUNS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]), False
)


def periodic_runs(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", exponent: int = 4, least: int = 6
) -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` (start, length, period, by start and then period), ``collapsed``.

    Words are separated by ASCII white space. A run has at least ``exponent`` periods and ``least`` words;
    ``collapsed`` is the text without the words after the first period of every run, joined by one space.
    Defined results: a null or empty text has no words, no runs and an empty ``collapsed``; rows are judged one by
    one, so null and repeated ids do no harm; an empty table gives no rows. Other columns are not read.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [text.split() for text in batch.column(1).cast(pa.binary()).to_pylist()]
            found = runs_by_document(lists, exponent, least)
            flat = np.array([(b, e - b, period) for runs in found for b, e, period in runs], np.int64).reshape(-1, 3)
            items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            offsets = np.cumsum([0, *[len(runs) for runs in found]], dtype=np.int32)
            collapsed = [_collapsed(words, runs).decode() for words, runs in zip(lists, found, strict=True)]
            columns = [
                batch.column(0),
                pa.array([len(words) for words in lists], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), items),
                pa.array(collapsed, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("n_words", T.LongType(), False)]
    schema = T.StructType([*fields, T.StructField("runs", RUNS, False), T.StructField("collapsed", T.StringType(), False)])
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id_column)
