"""Imputation, standardisation and vector assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import quoted
from larder.operators.clean import clean_products
from larder.operators.statistics import lower_medians, summarise
from larder.schema import FEATURE_SLOTS, KEY, TABLE_LAYOUT, TEXT_COLUMNS, ProductLayout
from larder.sources.scratch import materialize

IMPUTED = "__imputed"


@dataclass(frozen=True)
class FeatureProfile:
    """What preparation learns from the clean products, per feature."""

    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]


def _imputer(features: Sequence[str]) -> Imputer:
    outputs = [name + IMPUTED for name in features]
    return Imputer(strategy="median", inputCols=list(features), outputCols=outputs)


def fit_profile(clean: DataFrame, features: Sequence[str], exact: bool = True) -> FeatureProfile:
    """Medians, and mean and sample deviation after filling with them.

    ``clean`` is read several times, so it should be a stored table. Without
    ``exact`` the medians are those of Spark's ``Imputer``.
    """
    summaries = summarise(clean, features, medians=exact)
    if exact:
        medians = {name: at.median for name, at in summaries.items()}
    else:
        medians = _imputer(features).fit(clean).surrogateDF.first().asDict()
    filled = {name: at.filled_with(medians[name]) for name, at in summaries.items()}
    return FeatureProfile(
        {name: medians[name] for name in summaries},
        {name: mean for name, (mean, _) in filled.items()},
        {name: deviation for name, (_, deviation) in filled.items()},
    )


def impute(frame: DataFrame, fills: Mapping[str, float], suffix: str = IMPUTED) -> DataFrame:
    """Add ``<name>__imputed``: the value, or the fill where it is null or NaN."""
    return frame.withColumns(
        {
            name + suffix: F.coalesce(
                F.nanvl(quoted(name), F.lit(None).cast("double")), F.lit(fill)
            )
            for name, fill in fills.items()
        }
    )


def impute_median(frame: DataFrame, features: Sequence[str], exact: bool = True) -> DataFrame:
    """Median imputation; a column without any value is an error.

    ``exact=False`` takes Spark's ``Imputer`` with its approximate quantiles:
    one pass, but the fill can be off by a thousandth of the ranks.
    """
    if exact:
        return impute(frame, lower_medians(frame, features))
    return _imputer(features).fit(frame).transform(frame)


def scaled(value, mean: float, deviation: float):
    """Centred and scaled value; a constant column becomes 0.0."""
    return (value - F.lit(mean)) * F.lit(1.0 / deviation if deviation else 0.0)


def standardize(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by their standard scores (sample deviation)."""
    summaries = summarise(frame, columns)
    return frame.withColumns(
        {
            name: scaled(quoted(name), summaries[name].mean, summaries[name].variance**0.5)
            for name in columns
        }
    )


def apply_profile(
    clean: DataFrame, profile: FeatureProfile, features: Sequence[str] | None = None
) -> DataFrame:
    """Prepared products: texts without nulls, ``f0..`` without nulls."""
    features = list(features or profile.medians)
    texts = [F.coalesce(quoted(name), F.lit("")).alias(name) for name in TEXT_COLUMNS]
    slots = [
        scaled(
            F.coalesce(quoted(name), F.lit(profile.medians[name])),
            profile.means[name],
            profile.deviations[name],
        ).alias(f"f{i}")
        for i, name in enumerate(features)
    ]
    return clean.select(KEY, *texts, *slots)


def prepare_products(raw: DataFrame, layout: ProductLayout = TABLE_LAYOUT) -> DataFrame:
    """Raw text products to standardised products, one row per key (L1)."""
    clean = materialize(clean_products(raw, layout), "clean")
    if clean.isEmpty():
        raise ValueError("raw table contains no products with a key and a measurement")
    return apply_profile(clean, fit_profile(clean, layout.features), layout.features)


def assemble(
    frame: DataFrame, columns: Sequence[str] = FEATURE_SLOTS, output: str = "features"
) -> DataFrame:
    """Collect the columns into a vector; a null or NaN among them is an error (M2)."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")
    return assembler.transform(frame)


def spread(
    frame: DataFrame, vector: str = "features", names: Sequence[str] = FEATURE_SLOTS
) -> DataFrame:
    """Replace a vector column by one double column per position."""
    kept = [name for name in frame.columns if name != vector]
    listed = frame.select(
        *[quoted(name) for name in kept], vector_to_array(quoted(vector)).alias(vector)
    )
    return listed.select(
        *[quoted(name) for name in kept],
        *[F.col(vector).getItem(i).alias(name) for i, name in enumerate(names)],
    )
