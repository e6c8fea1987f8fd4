"""Operator 1: language identification by hierarchical discrimination.

A text becomes the normalised counts of its hashed byte pairs and triples. One-versus-one linear
support vector machines first vote on the language family; then those between the languages of that
family vote on the language. The machines are trained in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.scratch import materialize

BUCKETS = 4096
SLICE = 1 << 20
SALTS = 16
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")

# Families of the languages with two-letter codes that are common on the web. A code
# that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "es fr it pt ro ca gl oc ast la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "iranian": "fa ps ku tg",
    "indic": "hi ur bn mr gu pa ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "celtic": "ga gd cy br",
    "malayic": "id ms jv su tl",
}
TOGETHER = 512
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower().split("-")[0], f"only {language}")


def features(text: str) -> np.ndarray:
    """Unit vector of the whole text's hashed byte pairs and triples, in slices that overlap by two bytes."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(BUCKETS)
    for start in range(0, max(1, len(data) - 2), SLICE):
        part = data[start : start + SLICE + 2].astype(np.uint32)
        if len(part) < 3:
            break
        pairs = part[:-2] * np.uint32(31) + part[1:-1]
        triples = (pairs * np.uint32(0x9E3779B1) + part[2:] * np.uint32(0x85EBCA6B)) >> np.uint32(21)
        counts += np.bincount(np.concatenate([pairs & np.uint32(2047), triples + np.uint32(2048)]), minlength=BUCKETS)
    counts = np.sqrt(counts)
    return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, passes: int = 12) -> np.ndarray:
    """Weights (last: bias) of a linear SVM with squared hinge loss, by dual coordinate descent."""
    weights, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x))
    diagonal = np.einsum("ij,ij->i", x, x) + 1.0 + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(x)):
            gradient = y[i] * (float(weights @ x[i]) + bias) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights += np.float32(step) * x[i]
                bias += step
                alpha[i] = new
    return np.append(weights, np.float32(bias))


@dataclass
class Vote:
    """One-versus-one machines over some classes."""

    classes: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.empty((0, BUCKETS + 1)))

    @classmethod
    def trained(cls, x: np.ndarray, labels: np.ndarray) -> Vote:
        classes = sorted(set(labels))
        rows = []
        for a, b in combinations(classes, 2):
            chosen = (labels == a) | (labels == b)
            rows.append(train_svm(x[chosen], np.where(labels[chosen] == a, 1.0, -1.0)))
        return cls(classes, np.array(rows) if rows else np.empty((0, BUCKETS + 1)))

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winning class and the least certainty (0 to 1) of its decisions, per row."""
        n, k = len(x), len(self.classes)
        votes, worst = np.zeros((n, k)), np.ones((n, k))
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        for j, (a, b) in enumerate(combinations(range(k), 2)):
            sure = 1 / (1 + np.exp(-4 * margins[:, j].clip(-20, 20)))
            votes[:, a] += sure > 0.5
            votes[:, b] += sure <= 0.5
            worst[:, a] = np.minimum(worst[:, a], sure)
            worst[:, b] = np.minimum(worst[:, b], 1 - sure)
        best = np.argmax(votes + worst * 0.5, axis=1)
        return best, worst[np.arange(n), best]


@dataclass
class LanguageModel:
    families: Vote
    languages: list[Vote]

    @classmethod
    def trained(cls, x: np.ndarray, labels: np.ndarray) -> LanguageModel:
        of_row = np.array([family_of(label) for label in labels], dtype=object)
        families = Vote.trained(x, of_row)
        return cls(families, [Vote.trained(x[of_row == f], labels[of_row == f]) for f in families.classes])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of every text; feature vectors are held for ``TOGETHER`` of them at a time."""
        found = [self._predict(texts[at : at + TOGETHER]) for at in range(0, len(texts), TOGETHER)]
        return [name for names, _ in found for name in names], [score for _, scores in found for score in scores]

    def _predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        asked = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
        if not asked or not self.families.classes:
            return names, scores
        x = np.stack([features(texts[i]) for i in asked])
        family, certainty = self.families.decide(x)
        for f, vote in enumerate(self.languages):
            rows = np.flatnonzero(family == f)
            if len(rows):
                best, sure = vote.decide(x[rows])
                for row, b, s in zip(rows, best, np.minimum(sure, certainty[rows]), strict=True):
                    names[asked[row]], scores[asked[row]] = vote.classes[b], float(s)
        return names, scores


def train_languages(
    documents: DataFrame,
    trainable: Column,
    rows_per_language: int = 500,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """A model from at most ``rows_per_language`` labelled rows of each language, chosen by a hash of the id.

    The choice moves ids and labels only. ``trainable`` says which rows may be learned from.
    """
    labelled = documents.filter(trainable & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    narrow = labelled.select(F.col(id_column).alias("id"), F.col(lang_column).alias("lang"))
    # A language may hold most rows, so its first rows are chosen within salts before they meet in one task.
    first, salted = narrow.withColumn("salt", F.pmod(F.xxhash64("id", F.lit("salt")), F.lit(SALTS))), ["lang", "salt"]
    for keys in (salted, salted[:1]):
        by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        first = first.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= rows_per_language)
    chosen = materialize(first.select("id").distinct(), "language-sample")
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    ).join(chosen, "id", "left_semi")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(label, features(text).tobytes()) for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if _LETTER.search(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.binary())], ["lang", "vector"]
            )

    sample = rows.select("lang", "text").mapInArrow(vectors, "lang string, vector binary")
    found = sample.orderBy("lang", "vector").toArrow()  # at most rows_per_language of each language
    vectors = [np.frombuffer(value.as_buffer(), np.float32) for value in found.column("vector")]
    x = np.stack(vectors) if vectors else np.empty((0, BUCKETS), np.float32)
    return LanguageModel.trained(x, np.array(found.column("lang").to_pylist(), dtype=object))


def identify_languages(
    documents: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text", extra: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: id, the columns named in ``extra``, ``lang_pred`` and ``score`` from the whole text alone.

    Defined results: null texts and texts without a letter give ``und`` and 0; with no language learned all
    rows do; with one it is always predicted, with score 1. Null ids, repeated rows and an empty table need
    no rule, since rows are predicted one by one.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*[f.name for f in kept], "lang_pred", "score"],
            )

    rows = documents.select(id_column, *extra, F.col(text_column).alias("__text"))
    kept = rows.schema.fields[:-1]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string", "score double"])
    return rows.mapInArrow(predict, schema)


def keep_identified(documents: DataFrame, model: LanguageModel, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` with a determined language and a score of ``least`` or more, with all their columns."""
    place = documents.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(place).to_pylist())
            clear = [name != UNDETERMINED and score >= least for name, score in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(clear, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
