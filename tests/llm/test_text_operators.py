"""Operators on single texts and pages against the libraries, gold labels and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import bpe, htmltext, langid, token_files
from larder.llm.queries import BYTE_BPE, WORD_BPE

ODD_TEXTS = [
    "", " ", "a" * 3000, " " * 50 + "x", "a  b \n c  d e", "<|endoftext|>x <|endoftext|> y<|endoftext|>",
    "don't I'll 12345 ++-- \x1c a \x1f\x85 b", "é" * 500 + " " + "漢字" * 400, "ab" * 2000 + "cab" * 500,
    " ​ x", "\n \n x", "x ", "tab\t x \t", "ÀÉß œ µ ª", "é ́x", "a b　c",
]


@pytest.fixture
def odd(spark):
    """Odd texts, a null, a repeated row, a null id, and columns that clash with an operator's own."""
    rows = [(i, text, "x", 1) for i, text in enumerate(ODD_TEXTS)] + [(99, None, "x", 1), (0, "", "x", 1), (None, "null id", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


@pytest.mark.parametrize("leaf", [8, 256])
def test_tree_encoder_agrees_with_the_library(leaf):
    tree, library = bpe.TreeEncoder(BYTE_BPE, leaf), Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(1)
    mixed = ["".join(rng.choice("abthe  .\n'é1") for _ in range(600)) for _ in range(60)]
    unsplit = ["".join(rng.choice("abtheringo") for _ in range(2000)) for _ in range(20)]
    for text in [*ODD_TEXTS, *mixed, *unsplit]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert tree.encode(text).tolist() == expected
        assert tree.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_encode_and_decode_are_a_round_trip(odd):
    encoded = bpe.encode_documents(odd, BYTE_BPE)
    back = bpe.decode_documents(encoded, BYTE_BPE)
    expected = sorted((row["doc_id"] is None, row["doc_id"] or 0, row["text"] or "") for row in odd.collect())
    assert sorted((row["doc_id"] is None, row["doc_id"] or 0, row["text"]) for row in back.collect()) == expected
    digests = {row["doc_id"]: row for row in bpe.round_trip(odd, BYTE_BPE).collect()}
    assert digests[99]["n_tokens"] == 0 and digests[99]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(odd.limit(0), BYTE_BPE).isEmpty()


@pytest.mark.parametrize("plane_bits", [1, 8])
def test_token_files_hold_all_ids_in_order(spark, odd, plane_bits):
    library = Tokenizer.from_file(WORD_BPE)
    manifest = token_files.write_token_files(odd, WORD_BPE, files=3, block=64, plane_bits=plane_bits)
    rows = token_files.read_token_files(spark, manifest).orderBy("start").collect()
    texts = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in rows] == [i for i, _ in texts]
    start = 0
    for row, (_, text) in zip(rows, texts, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.read_token_files(spark, token_files.write_token_files(odd.limit(0), WORD_BPE, files=2)).isEmpty()


def test_word_encoder_agrees_with_the_library():
    """Whole vocabulary, words around the length that the library takes over from, odd and special signs."""
    encoder, library = token_files.WordEncoder(WORD_BPE, 1_000), Tokenizer.from_file(WORD_BPE)
    rng = random.Random(3)
    signs = [*"ab'sSrevlmdt <|>\t\n\x0b\x0c\r\x1c\x1f\x85\xa0éÉß×÷ÀıİK１²中0_-.", "e\u0301", "<|endoftext|>", "'ll"]
    mixed = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3_000)]
    long = ["".join(rng.choices(kind, k=k)) for kind in ("ab", "etaoinsrhE", ".-=!", "éäüa") for k in (255, 256, 257, 20_000)]
    vocabulary = [token.removesuffix("</w>") for token in library.get_vocab()]
    texts = [*ODD_TEXTS, *mixed, *long, *vocabulary]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(pa.array(texts))]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert list(encoder.encode(pa.array(texts).slice(2, 0))) == []
    assert list(encoder.encode(pa.array(["", "a"]).slice(0, 1))) == [b""]


def test_planes_come_back(tmp_path):
    ids = np.random.default_rng(0).integers(0, 1 << 32, 1001, dtype=np.uint32)
    for width in (1, 8):
        planes = token_files.to_planes(ids, width)
        assert len(planes) == 32 // width
        assert (token_files.from_planes(planes, len(ids), width) == ids).all()


def test_languages_of_held_out_texts_are_found(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    model = langid.train_languages(documents, remainder != 0, rows_per_language=60)
    found = langid.identify_languages(documents.filter(remainder == 0), model, extra=("lang",)).collect()
    assert np.mean([row["lang"] == row["lang_pred"] for row in found]) > 0.97
    assert all(0.0 <= row["score"] <= 1.0 for row in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (None, "und der die")], "doc_id long, text string")
    rows = {row["doc_id"]: row for row in langid.identify_languages(odd, model).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert rows[None]["lang_pred"] == "de"


def test_no_or_one_language_learned(spark):
    rows = spark.createDataFrame([(1, "some text", None), (2, "more text", "en")], "doc_id long, text string, lang string")
    nothing = langid.train_languages(rows, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify_languages(rows, nothing).collect()} == {"und"}
    one = langid.train_languages(rows, F.lit(True))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify_languages(rows, one).collect()} == {("en", 1.0)}


def test_slices_of_a_long_text_count_every_triple(monkeypatch):
    text = "der und die " * 500
    whole = langid.features(text)
    monkeypatch.setattr(langid, "SLICE", 97)
    assert np.allclose(langid.features(text), whole)


def test_families_come_before_languages():
    assert langid.family_of("en") == langid.family_of("de") == "germanic"
    assert langid.family_of("es") == langid.family_of("fr") == "romance"
    assert langid.family_of("xx") != langid.family_of("yy")


@pytest.fixture(scope="module")
def extractor():
    return htmltext.train_extractor()


def test_labelled_pages_not_trained_on(extractor):
    pages = [htmltext.leaf_blocks(page) for page in htmltext.labelled_pages(100, seed=99)]
    right = [label == block.gold for page in pages for block, label in zip(page, extractor.labels(page), strict=True)]
    assert np.mean(right) > 0.95


def test_articles_of_the_given_pages(spark, sf_dir, extractor):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in htmltext.extract_text(pages, extractor, extra=("url", "html")).collect():
        inside = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL)[1]
        spaced = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))
        assert row["text"] == " ".join(html.unescape(spaced).split())
        assert row["n_chars"] == len(row["text"])


def test_viterbi_finds_the_best_path(extractor):
    from itertools import product

    page = htmltext.leaf_blocks(htmltext.labelled_pages(1, seed=4)[0])[:8]

    def score(path):
        leads = sum(label * sum(extractor.lean.get(f, 0) for f in block.features) for block, label in zip(page, path, strict=True))
        return leads + sum(extractor.step[a, b] for a, b in zip(path, path[1:], strict=False))

    best = max(product((0, 1), repeat=len(page)), key=score)
    assert score(extractor.labels(page)) == pytest.approx(score(best))


def test_broken_and_empty_pages(spark, extractor):
    rows = [(1, None), (2, ""), (3, "<p>unclosed <b>bold &amp; <i>deep<p>next"), (4, "<" * 50), (5, "<!-- open"), (6, "<script>var a='</p>';"), (None, "text")]
    pages = spark.createDataFrame([(i, "u", page, "x") for i, page in rows], "page_id long, url string, html string, text string")
    found = {row["page_id"]: row["text"] for row in htmltext.extract_text(pages, extractor).collect()}
    assert len(found) == 7 and found[1] == found[2] == found[6] == ""
    assert [b.text for b in htmltext.leaf_blocks(rows[2][1])] == ["unclosed bold & deep", "next"]


def test_pages_without_end_tags_keep_their_text(extractor):
    body = "<article><h1>Some title</h1><p>The first sentence of the text.</p><p>And the second one of it.</p></article>"
    kept = ["Some title", "The first sentence of the text.", "And the second one of it."]
    head = "<!doctype html><html><head><meta charset=utf-8><title>t</title><link rel=x href=y><script>var a;</script>"
    assert htmltext.main_text(f"{head}</head><body>{body}", extractor) == " ".join(kept)
    for opened in ("<body>", "", "</head>", "<main>"):
        assert htmltext.main_text(f"{head}{opened}{body}", extractor) == " ".join(kept)
    assert [b.text for b in htmltext.leaf_blocks(head + "bare text <p>next")] == ["bare text", "next"]
    for tag in ("audio", "video", "object", "svg", "canvas"):
        page = f"<div><p>one</p><{tag} src=x><p>two</p></div><div><{tag}>fallback</{tag}><p>three</p></div><{tag} data=y><p>four"
        assert [b.text for b in htmltext.leaf_blocks(page)] == ["one", "two", "three", "four"]
    formula = "<p>We know <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds.</p><p>after"
    assert [b.text for b in htmltext.leaf_blocks(formula)] == ["We know x = 1 2 holds.", "after"]


def test_a_late_copyright_sign_counts():
    for sign in ("(c)", "(C)", "&copy;"):
        block = htmltext.leaf_blocks(f"<p>{'word ' * 100}{sign} 2020")[0]
        assert "copyright" in block.features and "no copyright" not in block.features


_NEWS = "The river rose by two metres in the night and the lower streets were closed until noon."
_MAIN = f"<h1>High water</h1><p>{_NEWS}</p><p>Nobody was hurt.</p>"
_PAGES = {
    "comments inside main": (
        f'<header class=masthead><a href=/>The Daily Post</a></header><main>{_MAIN}<section id="comments"><h2>Comments</h2><div class="comment">'
        "<p>I saw it with my own eyes from the bridge, it was frightening.</p></div><div class=comment><p>Thanks for the report.</p></div></section></main>"
        "<footer>(c) 2020 The Daily Post</footer>"
    ),
    "advert, form and related box inside the article": (
        f'<div id=masthead>The Daily Post</div><article><h1>High water</h1><p>{_NEWS}</p><div class="ad-slot"><p>Buy new boots today, half price until '
        "Friday at all our shops.</p></div><p>Nobody was hurt.</p><form action=/n><p>Get our letter every morning</p><label>Mail</label><input name=m>"
        '<button>Send</button></form><aside class="related"><h3>More on this</h3><ul><li><a href=/1>Bridge closed for repairs</a></li>'
        "<li><a href=/2>Rain expected</a></li></ul></aside></article>"
    ),
    "table layout": (
        "<table width=100%><tr><td colspan=2 class=logo>The Daily Post</td></tr><tr><td width=150><a href=/>Home</a><br><a href=/news>News</a><br>"
        f"<a href=/s>Sport</a></td><td class=content>{_MAIN}</td></tr><tr><td colspan=2>Copyright &copy; 2001</td></tr></table>"
    ),
    "choices after the article": (
        f"<div class=content>{_MAIN}</div><select name=lang><option>English<option>German<option>French</select><footer>&copy; 2020</footer>"
    ),
    "menu and share buttons inside the article": (
        "<div class=site-title>The Daily Post</div><article><nav class=toc><ul><li><a href=#a>Start</a></li><li><a href=#b>End</a></li></ul></nav>"
        f'{_MAIN}<div class="share-buttons"><a href=/t>Share</a> <a href=/f>Send</a></div></article>'
    ),
    "list of comments, site name as heading": (
        f"<div id=wrapper><div id=header><h1>The Daily Post</h1></div><div class=post>{_MAIN}<ol class=commentlist><li><p>Well written, thank you.</p></li>"
        "<li><p>My cellar is full of water and nobody came to help us until the evening.</p></li></ol></div>"
        "<div id=sidebar><p>Popular: what to do when water comes.</p></div></div>"
    ),
}


@pytest.mark.parametrize("name", _PAGES)
def test_parts_inside_articles_and_layouts_go(extractor, name):
    page = f"<!doctype html><html><head><title>t</title></head><body>{_PAGES[name]}</body></html>"
    assert htmltext.main_text(page, extractor) == f"High water {_NEWS} Nobody was hurt."


def test_very_long_pages_of_any_depth_take_seconds(extractor):
    import time

    def name(i):
        return "".join("abcdefghijklmnop"[i >> shift & 15] for shift in (0, 4, 8, 12, 16))

    odd = {
        "unclosed": "<div>" * 216_000 + "</p>" * 216_000,
        "nested": "".join(f"<div class=n{name(i)}>x{i}" for i in range(80_000)),
        "quotes": "<p title=it's>a" * 130_000,
        "no end": '<p x="a ' * 250_001,
    }
    for page in odd.values():
        assert len(page) > 1_700_000
        began = time.monotonic()
        htmltext.main_text(page, extractor)
        assert time.monotonic() - began < 30
    assert len(htmltext.leaf_blocks(odd["nested"])) == 80_000
    assert [b.text for b in htmltext.leaf_blocks("<p title=it's>one</p><p a='b>c' d=\"e>f\">two</p>")] == ["one", "two"]


def test_features_of_blocks_are_those_of_all_elements_around():
    blocks = htmltext.leaf_blocks('<div class="a"><div class="a b"><p>one</p></div><p id=c>two</p></div><p>three')
    names = [{f for f in block.features if f.startswith(("name", "in "))} for block in blocks]
    assert names == [{"in div", "in p", "name a", "name b"}, {"in div", "in p", "name a", "name c"}, {"in p"}]


def test_empty_table_of_pages_and_clashing_columns(spark, extractor):
    schema = "page_id long, url string, html string, text string, n_chars string, __html string"
    assert htmltext.extract_text(spark.createDataFrame([], schema), extractor).count() == 0
    page = f"<body><article>{_MAIN}</article></body>"
    rows = spark.createDataFrame([(1, None, page, "x", "y", "z"), (1, None, page, "x", "y", "z")], schema)
    found = htmltext.extract_text(rows, extractor).collect()
    text = f"High water {_NEWS} Nobody was hurt."
    assert len(found) == 2
    assert all(tuple(row) == (1, None, text, len(text)) for row in found)


def test_public_files_are_where_the_queries_look():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE
