"""Operators on the corpus against brute force over small tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import attention, exact, lattice, lm, minhash, mixing, repeats
from larder.llm.components import connected_components
from larder.llm.queries import BYTE_BPE, ORACLE, QUERIES
from workload.compare import duck, duck_bag, spark_bag

SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, salt int, digest string"


def corpus(spark, texts, first=0):
    rows = [(first + i, text, "en", f"s{i % 3}" if i % 7 else None, "k", 1, "d") for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(words))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_bag(QUERIES[name](spark, sf_dir)) == duck_bag(duck(sf_dir), ORACLE[name])


def test_exact_duplicates_with_colliding_digests(spark):
    texts = ["a", "b", "a", None, "", "b ", "a", "A"]
    frame = corpus(spark, texts).repartition(4)
    for digest in (exact.sha256, lambda text: F.substring(F.sha2(text, 256), 1, 0)):
        found = {r["doc_id"]: r for r in exact.exact_duplicates(frame, salts=2, digest=digest).collect()}
        for i, text in enumerate(texts):
            same = [j for j, other in enumerate(texts) if (other or "") == (text or "")]
            assert (found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (max(same), len(same), i == max(same))
    assert exact.exact_duplicates(frame.limit(0)).isEmpty()
    kept = exact.drop_exact_duplicates(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {1, 4, 5, 6, 7}


def test_null_and_repeated_ids_in_exact_dedup(spark):
    rows = spark.createDataFrame([(None, "x"), (None, "y"), (1, "y"), (2, "z"), (2, "z")], "doc_id long, text string")
    found = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact.exact_duplicates(rows).collect())
    assert found == [("1", "1", 2, True), ("2", "2", 2, True), ("2", "2", 2, True), ("None", "1", 2, False), ("None", "None", 1, True)]


def test_no_python_in_the_exact_plan(spark):
    plan = exact.exact_duplicates(corpus(spark, ["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(5)
    texts = [sentence(rng, rng.randint(1, 80)) for _ in range(600)] + [None, "", "  "]
    rows = mixing.mix_sources(corpus(spark, texts)).collect()
    again = mixing.mix_sources(corpus(spark, texts).repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(total)
    for source, target in targets.items():
        assert abs(sum(r["taken"] for r in rows if r["source"] == source) - target) <= 40
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in rows)
    assert mixing.mix_sources(corpus(spark, []).limit(0)).isEmpty()
    assert {r["target"] for r in mixing.mix_sources(corpus(spark, [None, ""])).collect()} == {0.0}


@pytest.mark.parametrize("long,short,count", [(12_000, 20, 400), (100_000, 200, 500)])
def test_a_dominating_document_leaves_the_others_to_the_mix(spark, long, short, count):
    """A source of one long document that doesn't fit into its target, and short ones that do."""
    rest = 15 * long // 16  # other sources, so that the target is an eighth of all words
    rows = [(i, "w " * short, "z") for i in range(count)] + [(9_999, "w " * long, "z"), (None, "w " * short, "z")]
    rows += [(20_000 + i, "w " * 500, s) for s in "ab" for i in range(rest // 500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(frame).collect()
    target = {r["target"] for r in found if r["source"] == "z"}.pop()
    assert target < short * count and abs(sum(r["taken"] for r in found if r["source"] == "z") - target) <= short
    for r in found:
        assert r["taken"] <= 3 * r["size"]


def test_mixed_rows_with_other_names_and_clashing_columns(spark):
    rows = [(i, f"{'w ' * (i % 9)}", "ab"[i % 2], 1, 2, 3) for i in range(60)] + [(None, "x y", None, 1, 2, 3), (5, "other text", "a", 1, 2, 3)]
    frame = spark.createDataFrame(rows, "number long, body string, origin string, copies int, `row` int, source int")
    mixed = mixing.mixed_rows(frame, id_column="number", text_column="body", source_column="origin")
    assert mixed.columns == frame.columns
    named = frame.select(F.col("number").alias("doc_id"), F.col("body").alias("text"), F.col("origin").alias("source"))
    expected = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.mix_sources(named).collect()}
    counted = Counter((r["number"], r["origin"], len(r["body"].split())) for r in mixed.collect())
    assert counted == Counter({key: n for key, n in expected.items() if n})
    assert mixing.mixed_rows(frame.limit(0), id_column="number", text_column="body", source_column="origin").isEmpty()


def test_targets_reshare_the_excess(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, None: 500, "d": 3}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame, (5, 2, 1), 3).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        shares = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if shares[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    expected = {s: 3 * sizes[s] for s in capped} | shares
    assert found == pytest.approx(expected)


def components_of(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "x long, y long"), "x", "y")
    expected = components_of({n for link in links for n in link}, links)
    assert {r["node"]: r["component"] for r in found.collect()} == expected
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").isEmpty()


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(60)]
    for i in range(60):
        words = texts[i].split()
        for _ in range(rng.choice([1, 1, 3])):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", " \n", texts[0], texts[0] + "  ", "one", "one", "one two"]
    shingles = []
    for text in texts:
        words = (text or "").split()
        shingles.append(Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter())
    links = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if shingles[i] and 10 * (shingles[i] & shingles[j]).total() >= 8 * (shingles[i] | shingles[j]).total()
    ]
    expected = components_of(range(len(texts)), links)
    found = minhash.near_duplicates(corpus(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)
    assert minhash.near_duplicates(corpus(spark, ["x"]).limit(0)).isEmpty()


def test_dart_signatures_estimate_weighted_similarity():
    rng = random.Random(4)
    words = sentence(rng, 400).split()
    a, b = minhash.strips(" ".join(words), 1), minhash.strips(" ".join(words[:300] + words[100:150]), 1)
    common = len(np.intersect1d(a, b))
    truth = common / (len(a) + len(b) - common)
    agree = np.mean(minhash.signature(a, 2000) == minhash.signature(b, 2000))
    assert abs(agree - truth) < 0.04


def test_bins_never_exclude_a_similar_pair():
    rng = np.random.default_rng(8)
    for n in (1, 30, 5000, 400_000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.02, 0.1, 0.12, 0.3):
            other = base.copy()
            other[: int(share * n)] = rng.integers(0, 1 << 63, int(share * n), dtype=np.uint64)
            common = len(np.intersect1d(base, other))
            similar = 100 * common >= 80 * (2 * n - common)
            found = minhash.may_be_similar(minhash.unit_bins(other)[None], np.array([n]), minhash.unit_bins(base), n, 80)
            assert found[0] or not similar
            if n in (30, 5000) and share == 0.3:
                assert not found[0] or n > minhash.BINS


def test_copies_that_miss_their_leader_meet_in_a_bucket(spark):
    """Chains of edits: the ends of a chain are not similar, so links between other members must be found."""
    rng = random.Random(12)
    texts = []
    for _ in range(6):
        words = sentence(rng, 150).split()
        for step in range(25):
            words[(step * 11) % 150] = f"edit{step}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    sets = [Counter(tuple(t.split()[i : i + 5]) for i in range(146)) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 10 * (sets[i] & sets[j]).total() >= 8 * (sets[i] | sets[j]).total()]
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(corpus(spark, texts)).collect()}
    assert found == components_of(range(len(texts)), links)


def test_null_ids_are_near_to_nothing(spark):
    rows = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    found = sorted((str(r["doc_id"]), str(r["class_id"]), r["kept"]) for r in minhash.near_duplicates(rows).collect())
    assert found == [("1", "1", True), ("2", "1", False), ("None", "None", True)]


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(150, 64))
    near = vectors[:120] + rng.normal(size=(120, 64)) * rng.uniform(0.1, 0.6, (120, 1))
    rows = [(i, [float(x) for x in np.float32(v)], i % 2) for i, v in enumerate(np.concatenate([vectors, near]))]
    rows += [(500 + i, rows[0][1], 0) for i in range(30)] + [(600, rows[0][1], 1)]
    odd = [(700, None, 0), (701, [0.0] * 64, 0), (702, [float("nan")] + [1.0] * 63, 0), (703, [None] + [1.0] * 63, 0), (704, rows[0][1], None), (705, [], 0), (706, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    schema = "vec_id long, embedding array<float>, label int, rep long, key string"
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows + odd], schema).repartition(5)
    links = []
    for x, (i, u, label) in enumerate(rows):
        for j, v, other in rows[:x]:
            if label == other and np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                links.append((i, j))
    degree = Counter(i for link in links for i in link)
    expected = components_of([r[0] for r in rows], links)
    for block in (8, 1024):
        found = {r["vec_id"]: r for r in lattice.near_embeddings(frame, block=block).collect()}
        assert {i: (found[i]["n_links"], found[i]["component_id"]) for i in expected} == {i: (degree[i], c) for i, c in expected.items()}
        assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (700, 701, 702, 703, 704, 705, 706, None))
    assert lattice.near_embeddings(frame.limit(0)).isEmpty()


@pytest.mark.parametrize("dimensions", [64, 384])
def test_lattice_cells_find_near_vectors_and_part_others(dimensions):
    import inspect

    given = inspect.signature(lattice.near_embeddings).parameters
    settings = [given[name].default for name in ("tables", "scale", "probes")]
    rng = np.random.default_rng(7)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def keys(x):
        return lattice.cell_keys(x, np.zeros(len(x), np.int64), *settings)

    def meet(a, b):
        return (a[..., :1] == b).any((-1, -2)) | (b[..., :1] == a).any((-1, -2))

    one = unit(rng.normal(size=(2000, dimensions)))
    aside = rng.normal(size=one.shape)
    aside = unit(aside - (aside * one).sum(1, keepdims=True) * one)
    for cosine, least in ((0.93, 0.99), (0.95, 0.998)):
        assert meet(keys(one), keys(cosine * one + math.sqrt(1 - cosine**2) * aside)).mean() >= least
    held = keys(one)
    together = sum(meet(held[i + 1 :], held[i][None]).sum() for i in range(len(one) - 1))
    assert together < 0.001 * len(one) * (len(one) - 1) / 2


def test_nearest_lattice_points():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    own = lattice.nearest_e8(x)
    near = own[:, None, :] + lattice.ROOTS[None]
    assert (((x - own) ** 2).sum(1) <= ((x[:, None, :] - near) ** 2).sum(2).min(1) + 1e-9).all()
    assert len({tuple(r) for r in lattice.ROOTS}) == 240 and np.allclose((lattice.ROOTS**2).sum(1), 2)


def removed_by_force(rows):
    seen: dict[bytes, int] = {}
    out = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if seen.get(data[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        for p in range(len(data) - 49):
            seen.setdefault(data[p : p + 50], i)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), kept)
    return out


def test_repeated_strings_equal_brute_force(spark):
    rng = random.Random(6)
    base = [sentence(rng, 120) for _ in range(12)]
    texts = list(base)
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        texts.append(sentence(rng, 5) + a[i : i + rng.randint(30, 200)] + rng.choice(["", "x", "é"]) + b[j : j + rng.randint(40, 70)] + sentence(rng, 4))
    texts += [None, "", "short", "a" * 400, "ab" * 300, "a" * 300 + "b" + "a" * 300, base[0], base[0], "x" * 49, "x" * 50, "y" + "x" * 50]
    expected = removed_by_force(list(enumerate(texts)))
    for buckets in (1, 7):
        found = repeats.without_repeats(corpus(spark, texts).repartition(6), buckets=buckets).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found} == expected
    assert repeats.without_repeats(corpus(spark, ["x"]).limit(0)).isEmpty()


def test_short_periodic_repeats_equal_brute_force(spark):
    rng = random.Random(14)
    texts = []
    for period in range(1, 26):
        for length in (50, 51, 56, 62, 75):
            unit = "".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(period))
            start = rng.randrange(period)
            common = (unit * 80)[start : start + length]
            # One goes on with the period on its right, the other on its left.
            texts.append(sentence(rng, 20) + "|" + common + (unit * 80)[start + length :][: rng.randint(0, 30)] + sentence(rng, 20))
            ahead = (unit * 40 + unit[:start])[-rng.randint(1, 30) :]
            texts.append(sentence(rng, 20) + ahead + common + "~" + sentence(rng, 20))
    expected = removed_by_force(list(enumerate(texts)))
    found = repeats.without_repeats(corpus(spark, texts), buckets=3).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found} == expected


def test_runs_of_a_cut_text_cover_the_same_positions(monkeypatch):
    rng = random.Random(8)
    text = sentence(rng, 2000).encode()

    def covered():
        runs = repeats._runs([b"other " * 20, text])
        own = runs["doc"] == 1
        return {p for at, n in zip(runs["at"][own], runs["n"][own], strict=True) for p in range(at, at + n)}

    whole = covered()
    monkeypatch.setattr(repeats, "CHUNK", 700)
    assert covered() == whole == set(range(len(text) - 49))


def test_ids_that_repeat_or_are_null_in_repeats(spark):
    long = "q" * 30 + "r" * 40
    rows = spark.createDataFrame([(None, long), (3, long), (3, long + "!"), (5, "z" + long)], "doc_id long, text string")
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in repeats.without_repeats(rows).collect())
    assert found == [("3", 70, 70), ("3", 71, 70), ("5", 71, 70), ("None", 70, 0)]


def test_scores_of_the_base_and_a_proper_model(spark):
    rng = random.Random(9)
    texts = [sentence(rng, rng.randint(0, 60)) for _ in range(80)] + [None, "", "Ünïcode WORDS\x0b and\x1cmore"]
    frame = corpus(spark, texts).withColumn("ids", F.lit("clash"))
    learned = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    found = {r["doc_id"]: r for r in lm.score_documents(frame, learned, BYTE_BPE, chunks=3, sample=20, rounds=1).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), "end"] for i, t in enumerate(texts)}
    counts = Counter(w for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
    total = counts.total()
    for i, own in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        row = found[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert row["base_score"] == pytest.approx(base) and math.isfinite(row["score"]) and row["score"] < 0
    assert lm.score_documents(frame.limit(0), learned, BYTE_BPE, chunks=2, sample=5, rounds=1).isEmpty()


def test_long_unsplit_words_are_scored_by_their_length(spark):
    rng = random.Random(9)
    drawn = "".join(rng.choice("漢字仮名交文日本語東京大学中") for _ in range(5000))
    texts = [sentence(rng, 60) for _ in range(30)] + [drawn, drawn[:2500], drawn[:1250]]
    frame = corpus(spark, texts)
    rows = lm.score_documents(frame, F.col("doc_id") < 30, BYTE_BPE, chunks=2, sample=10, rounds=1).collect()
    whole, half, quarter = (next(r["score"] for r in rows if r["doc_id"] == i) for i in (30, 31, 32))
    assert whole < -5000 and whole / half == pytest.approx(2, rel=0.1) and half / quarter == pytest.approx(2, rel=0.1)
    shares, spelled = np.array([0.0, 0.25, 0.0, 0.5]), np.array([-40_000.0, -40_000.0, -2.0, -1.0])
    expected = [(-40_000 + np.log(0.5)) / np.log(10), np.log10(0.125), np.log10(0.5 * np.exp(-2)), np.log10(0.25 + 0.5 * np.exp(-1))]
    assert lm.mixed_log10(shares, spelled) == pytest.approx(expected)


def test_all_training_documents_are_counted_and_learned_from(spark):
    rng = random.Random(10)
    texts = [sentence(rng, rng.randint(0, 40)) for _ in range(40)] + ["漢字" * 300, ""]
    frame = corpus(spark, texts).select(F.col("doc_id").alias("id"), "text").repartition(3)
    tree = lm.encoder(BYTE_BPE, lm.LEAF)
    end = len(tree.token_bytes) - 1
    ids = [lm._sequence(tree, lm.words_of(text), True) for text in texts]
    follow = Counter(pair for own in ids for pair in zip([end, *own[:-1].tolist()], own.tolist(), strict=True))
    words = lm.counted_words(frame.withColumn("train", F.lit(True)).withColumn("chunk", F.lit(0)), BYTE_BPE, 2)
    pairs = lm.neighbours(frame, words, BYTE_BPE)
    found = Counter()
    for row in pairs.collect():
        found[row["left"], row["right"]] += row["n"]
    assert found == follow
    counts = lm.subword_counts(pairs, end + 1)
    assert counts.tolist() == np.bincount(np.concatenate(ids), minlength=end + 1).tolist()
    classes = np.random.default_rng(1).integers(0, attention.CLASSES, end + 1)
    expected = np.zeros((attention.CLASSES, attention.CLASSES))
    for text in texts:
        before = end
        for word in [*lm.words_of(text), None]:
            own = [end] if word is None else np.frombuffer(lm.subwords(tree, word), "<u4")
            expected[classes[before], classes[own[0]]] += 1
            before = own[-1]
    assert (lm.class_pairs(pairs, classes) == expected).all()
    # Every subword is a target once, whatever the size of the parts, and sees the same before it.
    for most in (32, 64):
        parts = list(lm._windows(ids, end, most))
        assert sorted(t for _, w in parts for t in w[w >= 0].tolist()) == sorted(np.concatenate(ids).tolist())
    long = ids[40]
    seen, wanted, _ = attention.windows([long], end)
    parts = list(lm._windows([long], end, 32))
    assert (np.concatenate([s for s, _ in parts]) == seen).all() and (np.concatenate([w for _, w in parts]) == wanted).all()
    # A text without white space alone changes the parameters.
    tables = attention.Tables.counted(np.where(np.arange(end + 1) < end, 1, 0), attention.head_subwords(counts), counts, np.zeros((attention.HEADS, attention.HEADS)), np.ones(attention.HEADS), expected)
    start = attention.start_parameters()
    unspaced = lm.attention_parameters(frame.filter("id = 40"), BYTE_BPE, tables, start, 1, 0.001)
    assert not np.array_equal(attention.flatten(unspaced), attention.flatten(start))


def test_training_documents_are_read_as_the_ids_they_were_encoded_to_once(spark):
    rng = random.Random(11)
    frame = corpus(spark, [*(sentence(rng, n) for n in (0, 1, 40, 90)), "don't 東京\xa0x 's"]).select(F.col("doc_id").alias("id"), "text")
    tree = lm.encoder(BYTE_BPE, lm.LEAF)
    ids = lm.encoded(frame.coalesce(1), BYTE_BPE)
    assert ids.columns == ["ids"] and lm.encoded(ids, BYTE_BPE).columns == ["ids"]
    texts = [row["text"] for row in frame.coalesce(1).collect()]
    for row, text in zip(ids.collect(), texts, strict=True):
        assert np.frombuffer(row["ids"], "<u2").tolist() == lm._sequence(tree, lm.words_of(text), True).tolist()
    # The text is not asked for again.
    words = lm.counted_words(frame.withColumn("train", F.lit(True)).withColumn("chunk", F.lit(0)), BYTE_BPE, 2)
    from_ids, from_text = ({tuple(row) for row in lm.neighbours(rows, words, BYTE_BPE).collect()} for rows in (ids, frame))
    assert from_ids == from_text
    end = len(tree.token_bytes) - 1
    zeros = np.zeros((attention.HEADS, attention.HEADS))
    tables = attention.Tables.counted(
        np.where(np.arange(end + 1) < end, 1, 0), attention.head_subwords(np.arange(end + 1)), np.ones(end + 1), zeros, np.ones(attention.HEADS), np.ones((attention.CLASSES, attention.CLASSES))
    )
    start = attention.start_parameters()
    trained = [attention.flatten(lm.attention_parameters(rows, BYTE_BPE, tables, start, 1, 0.001)) for rows in (ids, frame.coalesce(1))]
    assert trained[0] == pytest.approx(trained[1]) and not np.array_equal(trained[0], attention.flatten(start))


def test_words_travel_packed_and_documents_come_back_as_their_words_and_counts(spark):
    rng = random.Random(12)
    texts = [sentence(rng, rng.randint(0, 50)) for _ in range(40)] + ["", " \t\n", "\x0b A\x0cb\x1cC  D\x85e\xa0F\r\nÀ İ 's ", "漢字" * 300]
    rows = [(i if i % 9 else None, i % 5 != 0, text) for i, text in enumerate([*texts, *texts[:6]])]
    frame = spark.createDataFrame(rows, "id long, train boolean, text string").repartition(3)
    for text in texts:
        words, lengths = lm.words_in(lm.pa.array([text, text]))
        assert words.to_pylist() == lm.words_of(text) * 2 and lengths.tolist() == [len(lm.words_of(text))] * 2
    dealt = lm.dealt_documents(frame, 3)
    words = lm.counted_words(dealt, BYTE_BPE, 3)
    # A record for every chunk and bucket, not for every word of a chunk.
    assert words.filter("chunk is not null").count() <= 9 and words.filter("chunk is null").count() <= 3
    counts = Counter(word for _, train, text in rows if train for word in lm.words_of(text))
    totals = words.filter("chunk is null").agg(F.sum("total"), F.sum("known")).first()
    assert tuple(totals) == (counts.total(), len(counts))
    tree = lm.encoder(BYTE_BPE, lm.LEAF)
    spelled = lm.spelled_documents(dealt, words, BYTE_BPE, 3, counts.total() + 3, len(counts) + 1)
    found = sorted((r["id"] or -1, r["place"], r["train"], r["ids"], lm._from_planes(r["n"], r["n_tokens"] - 1).tolist()) for r in spelled.collect())
    ids = [lm._sequence(tree, lm.words_of(text), True).astype("<u2").tobytes() for _, _, text in rows]
    expected = [(i or -1, train, own, [counts[word] for word in lm.words_of(text)]) for (i, train, text), own in zip(rows, ids, strict=True)]
    assert sorted((i, train, own, n) for i, _, train, own, n in found) == sorted(expected)
    # Documents of one id keep the order of their texts.
    unnamed = [own for i, _, _, own, _ in found if i == -1]
    assert unnamed == [own for _, own in sorted((text, own) for (i, _, text), own in zip(rows, ids, strict=True) if not i)]


@pytest.fixture
def small_model():
    rng = np.random.default_rng(0)
    size = 40
    classes = rng.integers(0, 5, size)
    heads = np.full(size, attention.HEADS - 1)
    heads[:25], heads[-1] = np.arange(25), 25
    counts = rng.integers(0, 9, size).astype(float)
    inside = np.zeros((attention.HEADS, attention.HEADS))
    inside[:25, :26] = rng.integers(0, 4, (25, 26))
    pairs = rng.integers(0, 5, (attention.CLASSES, attention.CLASSES)).astype(float)
    tables = attention.Tables.counted(classes, heads, counts, inside, np.ones(attention.HEADS), pairs)
    return attention.LanguageModel(attention.start_parameters(), tables)


def test_next_subword_probabilities_sum_to_one(small_model):
    start = np.array([3, 30, 7, 39, 2])
    total = sum(math.exp(small_model.log_probabilities([np.append(start, nxt)])[-1]) for nxt in range(40))
    held = small_model.tables.classes
    empty = np.setdiff1d(np.arange(attention.CLASSES), held)
    seen, _, _ = attention.windows([np.append(start, 0)], 39)
    last = np.append(small_model.tables.heads, -1)[seen]
    logits = attention._forward(small_model.parameters, small_model.tables.before, last)["logits"][0, len(start)]
    share = np.exp(logits - logits.max())
    lost = share[empty].sum() / share.sum()
    assert total == pytest.approx(1 - lost, abs=1e-4)


def test_openings_are_the_sum_over_opening_subwords_and_spellings_sum_to_one(small_model):
    rng = np.random.default_rng(5)
    opens = rng.random(40) < 0.4
    opens[39] = True
    small_model.openings = small_model.tables.openings(opens)
    for history in ([], [3], [3, 30, 7, 38, 2], rng.integers(0, 39, 21).tolist()):
        each = np.array([small_model.log_probabilities([np.array([*history, i])])[-1] for i in range(40)])
        opening = small_model.id_and_opening_logs([np.array([*history, 0])])[1][-1]
        assert np.exp(each[opens]).sum() == pytest.approx(np.exp(opening), rel=1e-4)
    # Words of one subword, of two, and the end, after a history that ends a word; longer ones have the rest.
    history, spelled, left = [3, 30], [], 0.0
    for first in np.flatnonzero(opens):
        logs, opening = small_model.id_and_opening_logs([np.array([*history, first, 39])])
        log, before, follows = logs[-2], opening[-2], opening[-1]
        found = lm.spelled_logs(np.array([log, logs[-1]]), np.array([before, follows]), np.array([first == 39, True]))[0]
        spelled.append(math.exp(found))
        if first != 39:
            further = [small_model.id_and_opening_logs([np.array([*history, first, i, 39])]) for i in np.flatnonzero(~opens)]
            spelled += [math.exp(l[-3] + l[-2] - before + o[-1]) for l, o in further]
            left += sum(math.exp(l[-3] + l[-2] - before) * (1 - math.exp(o[-1])) for l, o in further)
    empty = np.setdiff1d(np.arange(attention.CLASSES), small_model.tables.classes)
    assert len(empty)  # classes without ids keep a small part
    assert 0.9 < sum(spelled) + left <= 1 + 1e-4


def test_scores_are_the_same_for_any_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_ROWS", 16)
    rng = random.Random(4)
    frame = corpus(spark, [sentence(rng, rng.randint(5, 50)) for _ in range(60)])
    learned = F.col("doc_id") % 5 != 0
    found = [
        {r["doc_id"]: r["score"] for r in lm.score_documents(frame.repartition(n), learned, BYTE_BPE, chunks=n, sample=15, rounds=1).collect()}
        for n in (2, 7)
    ]
    assert found[0] == pytest.approx(found[1], rel=1e-5)


def test_every_subword_is_scored_once_and_sees_only_what_is_before(small_model):
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 40, n) for n in (1, 15, 16, 17, 70)]
    seen, wanted, own = attention.windows(ids, 39)
    assert [len(x) for x in ids] == np.bincount(own, (wanted >= 0).sum(1)).astype(int).tolist()
    assert np.concatenate(ids).tolist() == wanted[wanted >= 0].tolist()
    whole = small_model.log_probabilities(ids)
    changed = ids[4].copy()
    changed[60] = (changed[60] + 1) % 40
    assert small_model.log_probabilities([changed])[:60] == pytest.approx(whole[-70:][:60], abs=1e-5)


def test_training_raises_the_likelihood_of_what_it_sees(small_model):
    ids = [np.tile(np.array([1, 2, 3, 4, 5, 6, 7, 8]), 12) for _ in range(30)]
    seen, wanted, _ = attention.windows(ids, 39)
    seen, wanted = np.append(small_model.tables.heads, -1)[seen], np.append(small_model.tables.classes, -1)[wanted]
    before = attention.class_log_probabilities(small_model.parameters, small_model.tables.before, seen, wanted).sum()
    trained = attention.train(small_model.parameters, small_model.tables.before, seen, wanted, 10, 0.01, batch=32)
    assert attention.class_log_probabilities(trained, small_model.tables.before, seen, wanted).sum() > before
    assert np.allclose(attention.flatten(attention.unflatten(attention.flatten(trained))), attention.flatten(trained))


def test_gradients_are_those_of_the_likelihood_also_for_large_logits(small_model):
    rng = np.random.default_rng(3)
    seen, wanted, _ = attention.windows([rng.integers(0, 40, n) for n in (5, 16, 40)], 39)
    seen, wanted = np.append(small_model.tables.heads, -1)[seen], np.append(small_model.tables.classes, -1)[wanted]
    before = small_model.tables.before
    for more in (0, 100):  # what is added to all log odds is no matter
        flat = attention.flatten(small_model.parameters).astype(np.float32)
        slope = attention._gradients(attention.unflatten(flat), before + np.float32(more), seen, wanted)
        for _ in range(3):
            way = rng.normal(size=len(flat)) * (np.abs(slope) > 0)
            step = 0.02 * way / np.linalg.norm(way)
            up, down = (
                -attention.class_log_probabilities(attention.unflatten(flat + sign * step), before + np.float32(more), seen, wanted).astype(float).sum()
                for sign in (1, -1)
            )
            assert (up - down) / 2 / (wanted >= 0).sum() == pytest.approx(float(slope @ step), rel=0.02, abs=1e-5)


def test_pipeline_stages_against_brute_force(spark):
    rng = random.Random(12)
    long = [sentence(rng, rng.randint(20, 60)) for _ in range(40)]
    texts = [*long, long[3], long[3], "12345", None, long[5] + " tail", " ".join(["changed", *long[6].split()[1:]])]
    frame = corpus(spark, texts)
    kept = corpus_pipeline.keep_identified(spark, frame, "")
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {42, 43}
    unique = corpus_pipeline.drop_exact_copies(spark, kept, "")
    assert {r["doc_id"] for r in unique.collect()} == set(range(len(texts))) - {3, 40, 42, 43}
    near = corpus_pipeline.drop_near_copies(spark, unique, "")
    assert {r["doc_id"] for r in near.collect()} == set(range(40)) - {3} | {41}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(near).collect()}
    mixed = corpus_pipeline.mix(spark, near, "")
    assert mixed.columns == frame.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(copies)
    tokens = corpus_pipeline.tokenize(spark, mixed, "")
    assert tokens.count() == sum(copies.values()) and all(r["n_tokens"] == len(r["ids"]) for r in tokens.collect())


def test_digest_is_of_the_normalised_text(spark):
    row = exact.exact_duplicates(corpus(spark, ["é"])).first()
    assert bytes(row["digest"]).hex() == hashlib.sha256("é".encode()).hexdigest()
