"""Operator 7: mixing sources to target weights by Pareto order sampling.

A source's rate is its target over its size. Every document is taken ``floor(rate)`` times for
certain. The rest of the target is a fixed-size sample with unequal probabilities: a document's
inclusion odds come from its size (``min(1, rest * size / sum of squared sizes)``, so the expected
words are the rest), its rank is random odds over inclusion odds, and the lowest ranks are taken until
their words reach the rest. Long documents rank early, so the cut falls among short ones and the words
taken come near the target.

A document that doesn't fit into what is left is left out alone: a further round goes on along the ranks with the
documents that fit, three rounds in all.

Ranks are whole numbers of 52 bits (``rank / (1 + rank)`` scaled), and the cut is found by counting
words per source and leading 13 bits, four times, each time within the bin that holds the cut. No
source is ever sorted or gathered, so a hot source costs one counter per bin and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tables import WORD
from larder.sources.scratch import materialize

#: How often a source's sample goes on behind a document that doesn't fit.
ROUNDS = 3
RANK_BITS = 52
BITS_PER_PASS = 13


def random_unit(id_column: Column) -> Column:
    """A number in (0, 1) that depends on the id alone, so reruns agree."""
    digits = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**RANK_BITS))


def pareto_rank(unit: Column, inclusion: Column) -> Column:
    """``q / (1 + q)`` in 52 bits for q = random odds / inclusion odds; the order is that of q."""
    later = unit * (F.lit(1.0) - inclusion)
    return F.floor(later / (later + (F.lit(1.0) - unit) * inclusion) * F.lit(float(2**RANK_BITS))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Targets of the sources from their sizes: source, source_size, target.

    Weights repeat over the sources by code point, null last. The total is shared by weight; no source
    gets more than ``cap`` times its size, and the excess is shared again by weight. That ends at
    ``min(cap * size, level * weight)`` for one common level, found over the sources in order of
    ``cap * size / weight``: of the levels that fit, the first is the largest. The window has one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    weighed = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(cap))
    by_level = every.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    levelled = weighed.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    common = F.max(fits).over(every)
    return levelled.withColumn("common", common).select(
        "source",
        "source_size",
        F.least("most", F.coalesce(F.col("common") * F.col("weight"), F.col("most"))).alias("target"),
    )


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per row: id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``size`` counts the words of the whole text, ``copies`` is how often the document enters the mix (at
    most ``cap`` times), ``taken`` is copies times size. Defined results: a null text has size 0; a null
    source is a source of its own, the last; a null id takes part like any other; rows that repeat an id
    with equal size and source share their rank and are taken together; documents without words get the
    certain copies only; without any words all targets are 0; an empty table gives no rows. Further columns
    are not read.
    """
    base = documents.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = materialize(base, "mix-sizes")
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size").cast("decimal(38,0)") * F.col("size")).cast("double").alias("squares"),
    )
    squares = sums.select(F.col("source").alias("s"), "squares")
    targets = source_targets(sums.select("source", "source_size"), weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (
        targets.join(squares, targets["source"].eqNullSafe(squares["s"]))
        .drop("s")
        .withColumn("certain", F.floor(rate).cast("long"))
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
    )
    plan = materialize(plan.withColumnRenamed("source", "of_source"), "mix-plan")
    inclusion = F.when(
        F.col("squares") > 0, F.least(F.lit(1.0), F.col("rest") * F.col("size") / F.col("squares"))
    ).otherwise(F.lit(0.0))
    ranked = materialize(
        sized.join(plan, sized["source"].eqNullSafe(plan["of_source"])).select(
            "id",
            "source",
            "size",
            F.when(inclusion > 0, pareto_rank(random_unit(F.col("id")), inclusion)).alias("rank"),
        ),
        "mix-ranks",
    )
    fitted = fill_rests(ranked.filter("rank is not null and size > 0"), plan, rounds)
    chosen = F.coalesce(taken_in(F.col("rounds"), F.col("rank"), F.col("size")), F.lit(False))
    taken = ranked.join(fitted, ranked["source"].eqNullSafe(fitted["of_source"])).withColumn(
        "copies", F.col("certain") + F.when(chosen, 1).otherwise(0)
    )
    return taken.select(
        F.col("id").alias(id_column),
        F.col("source"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def taken_in(rounds: Column, rank: Column, size: Column) -> Column:
    """Whether one of the rounds takes a document: its rank is up to the cut, and it fits into what was left."""
    return F.exists(rounds, lambda at: (rank <= at["cut"]) & (size <= at["left"]))


def fill_rests(ranked: DataFrame, plan: DataFrame, rounds: int) -> DataFrame:
    """``plan`` with ``rounds``: per source and round the rank up to which documents are taken, and the words left before.

    A round goes along the ranks of the documents that fit into what is left, up to the first one that would pass it;
    the next round goes on behind it with what still fits. So a long document that doesn't fit is
    left out alone. The last round takes the document at its cut if that brings the words nearer.
    """
    nothing = F.array().cast("array<struct<cut: long, left: double>>")
    state = plan.select("of_source", F.col("rest").cast("double").alias("left"), nothing.alias("rounds"))
    for number in range(1, rounds + 1):
        state = materialize(rank_cuts(ranked, materialize(state, "mix-rounds"), number == rounds), "mix-cuts")
    filled = state.select(F.col("of_source").alias("c"), "rounds")
    return plan.join(filled, F.col("of_source").eqNullSafe(F.col("c"))).drop("c")


def rank_cuts(ranked: DataFrame, state: DataFrame, nearest: bool) -> DataFrame:
    """``state`` (of_source, left, rounds) after one more round.

    Each pass keeps, per source, the bin in which the words pass what is left, and the words before it. After
    the last pass a bin is one rank. It is taken if it fits, or with ``nearest`` if that brings the words nearer.
    """
    bounds = state.select(
        "of_source", F.col("left").alias("rest"), "rounds", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("words")
    )
    for shift in range(RANK_BITS - BITS_PER_PASS, -1, -BITS_PER_PASS):
        bounds = materialize(bounds, "mix-bounds")
        width = 1 << (shift + BITS_PER_PASS)
        inside = ranked.join(bounds, ranked["source"].eqNullSafe(bounds["of_source"])).filter(
            (F.col("rank") >= F.col("low"))
            & (F.col("rank") < F.col("low") + width)
            & (F.col("size") <= F.col("rest"))
            & ~taken_in(F.col("rounds"), F.col("rank"), F.col("size"))
        )
        bins = inside.groupBy("of_source", F.shiftright(F.col("rank"), shift).alias("bin")).agg(
            F.sum("size").alias("held")
        )
        running = Window.partitionBy("of_source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("held").over(running), F.lit(0))
        last = Window.partitionBy("of_source").orderBy(F.desc("bin"))
        # The bin in which the rest is reached; the last bin if all words together stay below it.
        reached = (
            bins.withColumn("before", before)
            .withColumn("from_end", F.row_number().over(last))
            .join(bounds.withColumnRenamed("of_source", "b"), F.col("of_source").eqNullSafe(F.col("b")))
            .withColumn("so_far", F.col("words") + F.col("before"))
            .filter(
                (F.col("so_far") <= F.col("rest"))
                & ((F.col("so_far") + F.col("held") > F.col("rest")) | (F.col("from_end") == 1))
            )
        )
        found = reached.select(
            F.col("of_source").alias("f"),
            F.shiftleft(F.col("bin"), shift).alias("new_low"),
            F.col("so_far"),
            F.col("held").alias("last_held"),
        )
        bounds = (
            bounds.select("of_source", "rest", "rounds")
            .join(found, F.col("of_source").eqNullSafe(F.col("f")), "left")
            .select(
                "of_source",
                "rest",
                "rounds",
                F.coalesce("new_low", F.lit(0)).cast("long").alias("low"),
                F.coalesce("so_far", F.lit(0)).cast("long").alias("words"),
                *([F.coalesce("last_held", F.lit(0)).alias("last_held")] if shift == 0 else []),
            )
        )
    over = F.col("words") + F.col("last_held") - F.col("rest")
    takes = (F.col("last_held") > 0) & (over <= (F.col("rest") - F.col("words") if nearest else F.lit(0.0)))
    this = F.struct(F.when(takes, F.col("low")).otherwise(F.col("low") - 1).alias("cut"), F.col("rest").alias("left"))
    used = F.col("words") + F.when(takes, F.col("last_held")).otherwise(0)
    return bounds.select("of_source", (F.col("rest") - used).alias("left"), F.concat("rounds", F.array(this)).alias("rounds"))


def mixed_rows(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings
) -> DataFrame:
    """``documents`` with every row as often as the mix takes it, all columns kept.

    Copies are per id; rows that repeat an id with different texts or sources would share them, so the
    copies are joined on id, source and size.
    """
    copies = (
        mix_sources(documents, id_column=id_column, text_column=text_column, source_column=source_column, **settings)
        .filter("copies > 0")
        .select(F.col(id_column).alias("id"), F.col("source"), F.col("size"), F.col("copies"))
        .distinct()
        .select(F.struct("id", "source", "size", "copies").alias("of"))
    )
    # Whatever the documents' columns are called, theirs are one struct and those of the mix another.
    rows = documents.select(F.struct(*[documents[name] for name in documents.columns]).alias("row"))
    own = F.col("row")
    words = F.coalesce(F.regexp_count(own[text_column], F.lit(WORD)), F.lit(0)).cast("long")
    same = own[id_column].eqNullSafe(F.col("of.id")) & own[source_column].eqNullSafe(F.col("of.source"))
    joined = rows.join(copies, same & (words == F.col("of.size")))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("of.copies")))
    return joined.select("row", again.alias("again")).select("row.*")
