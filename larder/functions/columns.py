"""Scalar column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by literal name; measurement names carry hyphens."""
    return F.col("`" + name.replace("`", "``") + "`")


def locale_number(text: Column) -> Column:
    """Text to double with every comma read as a decimal point; null if unreadable.

    ``try_cast`` rather than ``cast``: under ANSI mode a plain cast fails the
    job on the first malformed value.
    """
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def within_bounds(number: Column, low: float, high: float) -> Column:
    """The number if it is a real number in [low, high], else null.

    Adding 0.0 turns -0.0 into 0.0, so equal measurements also hash equally.
    """
    return F.when(~F.isnan(number) & number.between(low, high), number + F.lit(0.0))


def not_blank(text: Column) -> Column:
    """True for text that has more than blanks in it; false for null."""
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))


# The white space of Unicode, and the four separators of ASCII.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def stripped(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def has_content(text: Column) -> Column:
    """True for text that has more than white space in it; false for null. Cells go by this.

    A printable ASCII sign after blanks settles it; only other texts are searched for white space of all kinds,
    which takes a hundred times as long.
    """
    unindented = F.ltrim(text)
    printable = (unindented >= F.lit("!")) & (unindented < F.lit("\x7f"))
    return F.coalesce(F.when(printable, F.lit(True)).otherwise(F.length(stripped(text)) > 0), F.lit(False))


def any_present(columns: Iterable[Column]) -> Column:
    return F.coalesce(*columns).isNotNull()


def evaluated_once(columns: Mapping[str, Column]) -> Column:
    """Select-list item yielding the columns, computed once per row.

    A filter on computed columns is normally pushed below their projection,
    with every expression copied into it: the eight parses of a product ran
    twice, in a generated method so large that the JVM refused to compile it
    (six times slower at 600k rows). A filter is not pushed through a generator.
    """
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))


def composite_key(*parts: Column) -> Column:
    """``a:b`` key; null if any part is null (``concat_ws`` would skip it)."""
    return reduce(lambda left, right: F.concat(left, F.lit(":"), right), parts)


def squared_distance(point: Sequence[Column], centre: Sequence[float]) -> Column:
    """Squared Euclidean distance to one fixed point, summed in column order."""
    squares = [
        (value - F.lit(float(at))) * (value - F.lit(float(at)))
        for value, at in zip(point, centre, strict=True)
    ]
    return reduce(lambda left, right: left + right, squares)
