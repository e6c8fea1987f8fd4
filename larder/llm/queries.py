"""The registered queries of this folder and the SQL that some of them must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, exact, htmltext, langid, lattice, lm, minhash, mixing, negatives, periods, repeats, subtrees, token_files
from larder.llm.tables import WORD, crc_remainder, read, share_code

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    documents = read(spark, sf_dir, "documents")
    remainder = crc_remainder("doc_id", 5)
    model = langid.train_languages(documents, remainder != 0)
    held_out = documents.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False)))
    return langid.identify_languages(held_out, model, extra=("held_out",))


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    cut = repeats.without_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    remainder = crc_remainder("doc_id", 7)
    scored = lm.score_documents(read(spark, sf_dir, "documents"), remainder != 2, BYTE_BPE)
    held_out = F.coalesce(crc_remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return bpe.round_trip(read(spark, sf_dir, "documents"), BYTE_BPE)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact.exact_duplicates(read(spark, sf_dir, "documents"))
    return decided.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return lattice.near_embeddings(read(spark, sf_dir, "embeddings"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return htmltext.extract_text(read(spark, sf_dir, "pages"), htmltext.train_extractor())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    manifest = token_files.write_token_files(read(spark, sf_dir, "documents"), WORD_BPE)
    return token_files.read_token_files(spark, manifest)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    embeddings = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_hard_negatives(embeddings.withColumn("label", moved), F.col("id") % 100 == 0)


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents, by a hash of their id, repeats a stretch of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    seeds = documents.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    n, g = F.size("words"), F.col("g")
    starts = seeds.select("*", F.when(n > 0, g % n).cast("int").alias("a"))
    after = n - F.col("a")
    placed = starts.select("*", (F.floor(after / (g % 8 + 3)) + 1).cast("int").alias("p"))
    head = F.slice("words", F.lit(1), F.col("a"))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(after / F.col("p")).cast("int"))), F.lit(1), after)
    planted = F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return placed.select("doc_id", planted.alias("text"))


def _greatest_exponent(best: Column, run: Column) -> Column:
    """Of two runs the one with the greater length / period, compared in whole numbers; runs come in order."""
    greater = run["length"] * best["period"] > best["length"] * run["period"]
    return F.when(best.isNull() | greater, run).otherwise(best)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    found = periods.periodic_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    nothing = F.lit(None).cast(periods.RUNS.elementType)
    best = F.aggregate("runs", nothing, _greatest_exponent)
    line = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    cut = subtrees.without_repeated_windows(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_repeated_bytes": op2_repeated_bytes,
    "op3_lm_score": op3_lm_score,
    "op4_bpe": op4_bpe,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_html_text": op8_html_text,
    "op9_token_files": op9_token_files,
    "op10_near_dedup": op10_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repeated_windows": op13_repeated_windows,
}

EXACT_SQL = """
with texts as (select doc_id, coalesce(text, '') as content from documents),
     grouped as (select content, max(doc_id) as keep_id, count(*) as group_size from texts group by content)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(content) as text_sha256
from texts join grouped using (content)
"""

#: The mix in DuckDB, but for its rounds.
MIX_CTES = r"""
sizes as (
    select doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as unit
    from {documents}),
sums as (
    select source, sum(size)::bigint as source_size, sum(size::hugeint * size)::double as squares
    from sizes group by source),
weighed as (
    select *, [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source is null, source) - 1) % 3 + 1] as weight,
           source_size * 3.0::double as most
    from sums),
levelled as (
    select *,
           (sum(source_size) over ()::bigint - coalesce(sum(most) over (order by most / weight, source is null, source
                rows between unbounded preceding and 1 preceding), 0.0::double))
           / sum(weight) over (order by most / weight, source is null, source rows between current row and unbounded following) as level
    from weighed),
levels as (select *, max(case when level <= most / weight then level end) over () as common from levelled),
targets as (
    select *, least(most, coalesce(common * weight, most)) as target,
           case when source_size > 0 then floor(least(most, coalesce(common * weight, most)) / source_size)::bigint else 0 end as certain
    from levels),
rates as (select *, target - certain * source_size as rest from targets),
included as (
    select doc_id, sizes.source, size, source_size, target, certain, rest, unit,
           case when squares > 0 then least(1.0::double, rest * size / squares) else 0.0::double end as inclusion
    from sizes join rates on sizes.source is not distinct from rates.source),
ranked as (
    select *, case when inclusion > 0 then floor(unit * (1.0::double - inclusion)
                   / (unit * (1.0::double - inclusion) + (1.0::double - unit) * inclusion) * 4503599627370496.0::double)::bigint end as rank
    from included),
{rounds}mixed as (
    select doc_id, ranked.source, size, source_size, target, certain + case when {taken} then 1 else 0 end as copies
    from ranked left join {state} on ranked.source is not distinct from {state}.source)
"""

#: A round goes along the ranks of what fits and is not taken yet. {fits} says whether the rank at hand is taken.
MIX_ROUND = """grouped{n} as (
    select ranked.source, left{before}, rank, sum(size)::bigint as held
    from ranked join state{before} on ranked.source is not distinct from state{before}.source
    where rank is not null and size > 0 and size <= left{before} and not {taken}
    group by ranked.source, left{before}, rank),
running{n} as (
    select *, coalesce(sum(held) over (partition by source order by rank rows between unbounded preceding and 1 preceding), 0)::bigint as words
    from grouped{n}),
found{n} as (
    select source, max(rank) filter (where {fits}) as last, max(words + held) filter (where {fits}) as used
    from running{n} group by source),
state{n} as (
    select state{before}.*, coalesce(last, -1) as cut{n}, left{before} - coalesce(used, 0) as left{n}
    from state{before} left join found{n} on state{before}.source is not distinct from found{n}.source),
"""


def mix_ctes(documents: str, rounds: int = mixing.ROUNDS) -> str:
    """The mix of a table with doc_id, text and source as common table expressions, ending in ``mixed``."""

    def taken(count: int) -> str:
        conditions = [f"(rank <= cut{n} and size <= left{n - 1})" for n in range(1, count + 1)]
        return "coalesce(" + " or ".join(conditions or ["false"]) + ", false)"

    parts = ["state0 as (select source, rest::double as left0 from rates),\n"]
    for n in range(1, rounds + 1):
        left = f"left{n - 1}"
        fits = f"words + held <= {left}"
        if n == rounds:
            fits = f"words <= {left} and ({fits} or words + held - {left} <= {left} - words)"
        part = MIX_ROUND.replace("{n}", str(n)).replace("{before}", str(n - 1)).replace("{taken}", taken(n - 1))
        parts.append(part.replace("{fits}", fits))
    text = MIX_CTES.replace("{documents}", documents).replace("{rounds}", "".join(parts))
    return text.replace("{taken}", taken(rounds)).replace("{state}", f"state{rounds}")


NEGATIVES_SQL = """
with moved as (
    select vec_id, embedding, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label from embeddings),
usable as (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 256.0)::bigint) as v
    from moved
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
           list_sum(list_transform(list_zip(a.v, r.v), lambda x: x[1] * x[2]))::bigint as score
    from usable a join usable r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score,
           row_number() over (partition by anchor_id order by score desc, other_id)::int as positive_rank
    from scored where same
    qualify positive_rank <= 5)
select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score, positive_rank,
       row_number() over (partition by anchor_id, positive_rank order by score desc, other_id)::int as rank
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

WINDOWS_SQL = r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
starts as (select doc_id, unnest(range(len(words) - 19)) as place, words from texts where len(words) >= 20),
windows as (
    select doc_id, place, row_number() over (partition by list_slice(words, place + 1, place + 20) order by doc_id, place) as occurrence
    from starts),
gone as (select distinct doc_id, unnest(range(place, place + 20)) as place from windows where occurrence > 1),
listed as (select doc_id, unnest(words) as word, unnest(range(len(words))) as place from texts),
kept as (
    select doc_id, string_agg(word, ' ' order by place) as kept
    from listed anti join gone using (doc_id, place) group by doc_id),
counts as (select doc_id, count(*) as n_removed from gone group by doc_id)
select doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (doc_id) left join counts using (doc_id)
"""

ORACLE = {
    "op13_repeated_windows": WINDOWS_SQL,
    "op11_hard_negatives": NEGATIVES_SQL,
    "op5_exact_dedup": EXACT_SQL,
    "op7_mix_sources": "with "
    + mix_ctes("documents")
    + " select doc_id, size, source_size, target, (copies * size)::bigint as taken from mixed",
}
