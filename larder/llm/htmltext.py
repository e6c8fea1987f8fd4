"""Operator 8: main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks: the runs of text between block-level tags, each with the
elements it stands in. Features are the tags, class and id words of the ancestors and a few measures of
the text. The field has the labels boilerplate and article; it is trained in numpy on labelled pages, and
Viterbi decoding labels the blocks of each page together.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset(
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
    "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
UNSEEN = frozenset("script style noscript template svg iframe object head title audio video canvas".split())
EMBEDDED = frozenset("svg object audio video canvas".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
_CLOSES = {  # an open element on the left ends where one on the right begins
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
        "main menu nav ol p pre section table ul li dd dt td th tr".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
    "option": frozenset(["option"]),
}
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_EMBEDDED = re.compile(r"<(?:" + "|".join(sorted(EMBEDDED)) + r")\b", re.IGNORECASE)
_LABEL = re.compile(r"data-gold=\"([01])\"")
_HIDDEN = re.compile(r"\bhidden\b|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    own: frozenset[str]
    around: _Element | None = None
    gold: int | None = None

    @property
    def features(self) -> set[str]:
        """All features: those of the text and those of every element around it."""
        found, element = set(self.own), self.around
        while element is not None:
            found |= element.added
            element = element.parent
        return found


class _Element:
    """An open block-level element and the features that it adds to those of the elements around it.

    Elements are linked to the one they stand in, so a page of any depth takes space for its own names only.
    """

    __slots__ = ("tag", "added", "parent", "gold", "unseen")

    def __init__(self, tag: str, attributes: str, parent: _Element | None, known: set[str]):
        names = {f"in {tag}"}
        if attributes:
            for match in _NAMES.finditer(attributes):
                value = match[1] or match[2] or match[3] or ""
                names.update(f"name {w}" for w in _WORD.findall(_CAMEL.sub(" ", value).lower()))
            if _HIDDEN.search(attributes):
                names.add("hidden")
        self.tag, self.parent = tag, parent
        self.added = names - known
        gold = _LABEL.search(attributes) if attributes else None
        self.gold = int(gold[1]) if gold else (parent.gold if parent else None)
        self.unseen = tag in UNSEEN or (parent.unseen if parent else False)


def _text_features(text: str, linked: int, tag: str) -> set[str]:
    words = text.count(" ") + 1
    share = linked / len(text)
    return {
        f"leaf {tag}",
        f"words {min(6, int(math.log2(words)))}",
        "links most" if share > 0.6 else "links some" if share > 0.15 else "links few",
        "sentence" if text[-1] in ".!?:;\"'”»" else "no sentence",
        "copyright" if "©" in text or "(c)" in text.lower() else "no copyright",
    }


def _raw_end(page: str, tag: str, position: int) -> int:
    end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, position)
    return end.end() if end else len(page)


def _unclosed(page: str) -> set[int]:
    """Where embedded elements begin that no end tag of their own closes; what follows them is not inside."""
    found: set[int] = set()
    if not _EMBEDDED.search(page):
        return found
    stack: list[tuple[str, int]] = []
    open_tags: Counter[str] = Counter()
    position = 0
    while match := _MARKUP.search(page, position):
        position = match.end()
        tag = (match[2] or "").lower()
        if not tag or tag in INLINE or tag in MATH or tag in VOID:
            continue
        if match[1]:
            if open_tags[tag]:
                while (top := stack.pop())[0] != tag:
                    open_tags[top[0]] -= 1
                    if top[0] in EMBEDDED:
                        found.add(top[1])
                open_tags[tag] -= 1
        elif tag in RAW:
            position = _raw_end(page, tag, position)
        elif not match[3].rstrip().endswith("/") or tag not in UNSEEN:
            stack.append((tag, match.start()))
            open_tags[tag] += 1
    return found | {start for name, start in stack if name in EMBEDDED}


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, their text decoded and with single spaces."""
    unclosed = _unclosed(page)
    blocks: list[Block] = []
    stack: list[_Element] = []
    open_tags: Counter[str] = Counter()
    known: set[str] = set()  # features of the open elements
    text: list[str] = []
    links = linked = position = 0

    def end_block() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split()) if text else ""
        if joined:
            top = stack[-1] if stack else None
            found = _text_features(joined, min(linked, len(joined)), top.tag if top else "none")
            blocks.append(Block(joined, frozenset(found), top, top.gold if top else None))
        text.clear()
        linked = 0

    def close() -> str:
        element = stack.pop()
        open_tags[element.tag] -= 1
        known.difference_update(element.added)
        return element.tag

    def add(piece: str) -> None:
        nonlocal linked
        if stack and stack[-1].tag == "head" and piece.strip():
            close()
        if piece and not (stack and stack[-1].unseen):
            text.append(piece)
            if links:
                linked += len(piece)

    while match := _MARKUP.search(page, position):
        add(page[position : match.start()])
        position = match.end()
        name = match[2]
        if name is None:
            continue
        tag = name.lower()
        if match[1]:
            if tag in INLINE or tag in MATH:
                links = max(0, links - (tag == "a"))
            elif open_tags[tag]:
                end_block()
                while close() != tag:
                    pass
            elif tag in ("p", "br"):
                end_block()
            continue
        if stack and stack[-1].tag == "head" and tag not in IN_HEAD:
            close()  # its end tag may be left out
        if tag in MATH:
            add(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 1
            elif tag in ("img", "input"):
                add(" ")
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                add(" ")
            continue
        if tag in RAW:
            position = _raw_end(page, tag, position)
            continue
        end_block()
        if match.start() in unclosed:
            continue
        links = 0
        while stack and tag in _CLOSES.get(stack[-1].tag, ()):
            close()
        if not match[3].rstrip().endswith("/") or tag not in UNSEEN:
            stack.append(_Element(tag, match[3], stack[-1] if stack else None, known))
            open_tags[tag] += 1
            known |= stack[-1].added
    add(page[position:])
    end_block()
    return blocks


class BlockField:
    """Linear-chain field with two labels: weights per feature and label, and for neighbouring labels."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.index, self.emit, self.step = index, emit, step
        self.lean = {name: float(emit[i, 1] - emit[i, 0]) for name, i in index.items()}

    @classmethod
    def trained(cls, pages: list[list[Block]], rounds: int = 120, decay: float = 5e-5) -> BlockField:
        """Maximum likelihood by Adam; all pages at once, forward and backward in log space."""
        pages = [page for page in pages if page]
        index = {name: i for i, name in enumerate(sorted({f for page in pages for b in page for f in b.features}))}
        longest = max(map(len, pages))
        x = np.zeros((sum(map(len, pages)), len(index)))
        gold = np.zeros((len(pages), longest), np.int64)
        real = np.zeros((len(pages), longest), bool)
        for row, block in enumerate(block for page in pages for block in page):
            x[row, [index[f] for f in block.features]] = 1
        for p, page in enumerate(pages):
            for t, block in enumerate(page):
                gold[p, t], real[p, t] = block.gold or 0, True
        emit, step = np.zeros((len(index), 2)), np.zeros((2, 2))
        pairs = real[:, 1:].astype(float)
        truth = np.eye(2)[gold] * real[..., None]
        seen_pairs = np.einsum("pta,ptb,pt->ab", truth[:, :-1], truth[:, 1:], pairs)
        moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
        blocks = real.sum()
        for turn in range(1, rounds + 1):
            score = np.zeros((*real.shape, 2))
            score[real] = x @ emit
            forward, backward = np.empty_like(score), np.zeros_like(score)
            forward[:, 0] = score[:, 0]
            for t in range(1, longest):
                moved = np.logaddexp.reduce(forward[:, t - 1, :, None] + step, axis=1) + score[:, t]
                forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                moved = np.logaddexp.reduce(step + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(real[:, t + 1, None], moved, 0.0)
            total = np.logaddexp.reduce(forward[:, -1], axis=1)
            node = np.exp(forward + backward - total[:, None, None]) * real[..., None]
            edge = forward[:, :-1, :, None] + step + (score[:, 1:] + backward[:, 1:])[:, :, None, :]
            edge = np.exp(edge - total[:, None, None, None]) * pairs[..., None, None]
            slopes = (
                x.T @ (truth - node)[real] / blocks - decay * emit,
                (seen_pairs - edge.sum(axis=(0, 1))) / blocks - decay * step,
            )
            for k, (weights, slope) in enumerate(zip((emit, step), slopes, strict=True)):
                mean, square = moments[2 * k], moments[2 * k + 1]
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                weights += 0.3 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        return cls(index, emit, step)

    def leads(self, page: list[Block]) -> list[float]:
        """The lead of article over boilerplate of each block; that of an element is summed once for all blocks inside."""
        known: dict[int, float] = {}
        found = []
        for block in page:
            path, element = [], block.around
            while element is not None and id(element) not in known:
                path.append(element)
                element = element.parent
            lead = known[id(element)] if element is not None else 0.0
            for element in reversed(path):
                lead += sum(self.lean.get(f, 0.0) for f in element.added)
                known[id(element)] = lead
            # A text's own feature names are none of an element's.
            found.append(lead + sum(self.lean.get(f, 0.0) for f in block.own))
        return found

    def labels(self, page: list[Block]) -> list[int]:
        """The most probable labels of a page's blocks (Viterbi over the leads)."""
        if not page:
            return []
        (stay0, to1), (to0, stay1) = self.step.tolist()
        back: list[tuple[int, int]] = []
        zero = one = 0.0
        for t, lead in enumerate(self.leads(page)):
            if t:
                from0 = (0 if zero + stay0 >= one + to0 else 1, 0 if zero + to1 > one + stay1 else 1)
                back.append(from0)
                zero, one = max(zero + stay0, one + to0), max(zero + to1, one + stay1)
            one += lead
        label = int(one > zero)
        found = [label]
        for choice in reversed(back):
            label = choice[label]
            found.append(label)
        return found[::-1]


# Vocabulary of the labelled pages: names that pages give to parts of either kind.
_ARTICLE_NAMES = ["content", "main content", "post", "entry content", "article body", "story", "text", "post-body"]
_PARTS = {
    "menu": (["nav", "div", "ul"], ["menu", "nav", "navbar", "navigation", "breadcrumb", "top menu"]),
    "header": (["header", "div"], ["header", "masthead", "site-header", "top", "logo", "banner", "site title", "branding", "tagline"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "bottom", "copyright", "colophon"]),
    "sidebar": (["aside", "div"], ["sidebar", "related", "widget", "recommended", "popular", "teaser", "promo", "see also", "more stories"]),
    "notice": (["div", "section", "dialog"], ["cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "cookie banner", "subscribe", "newsletter", "paywall"]),
    "advert": (["div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "adsense", "promo ad", "ad-slot", "ad box"]),
    "form": (["form", "div"], ["form", "search", "login", "signup", "contact form"]),
    "comments": (["section", "div", "ol"], ["comments", "comment", "respond", "replies", "disqus", "comment list", "commentlist", "discussion", "comment thread"]),
    "share": (["div", "ul"], ["share", "social", "tags", "meta", "byline", "author", "pagination", "share buttons"]),
    "choice": (["select", "div"], ["language", "picker", "select", "archive", "dropdown"]),
}
_INSIDE = ["advert", "sidebar", "share", "notice", "menu", "form", "form", "comments", "comments", "header", "footer", "choice"]


def labelled_pages(count: int = 500, seed: int = 5) -> list[str]:
    """Pages whose parts carry their label as ``data-gold``, made from the vocabulary above by rule.

    Text of either kind has any length, so that the elements around a block decide unless they say nothing. Parts
    of every kind stand before, after and inside articles and in what wraps these, also in cells of layout tables.
    """
    rng = np.random.default_rng(seed)
    letters = list("abdehilnorstu")
    vocabulary = ["".join(rng.choice(letters, size)) for size in rng.integers(2, 9, 400)]

    def words(low: int, high: int) -> str:
        n = int(np.exp(rng.uniform(math.log(low), math.log(high))))
        return " ".join(rng.choice(vocabulary, n)).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])

    def attributes(names: list[str], chance: float) -> str:
        if rng.random() > chance:
            return ""
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"'

    def part(kind: str) -> str:
        tags, names = _PARTS[kind]
        tag = str(rng.choice(tags))
        named = attributes(names, 1.0 if tag in ("div", "section", "ul", "ol") else 0.4)
        inside = []
        for _ in range(rng.integers(1, 6)):
            text = words(1, 60 if kind in ("advert", "comments", "notice", "sidebar", "footer") else 6)
            if kind == "choice":
                inside.append(f"<option>{text}</option>")
                continue
            if kind in ("menu", "share") or rng.random() < 0.15:
                text = f'<a href="/x">{text}</a>'
            if kind == "footer" and rng.random() < 0.6:
                text = "&copy; " + text
            wrap = str(rng.choice(["p", "div", "span", "li", ""])) if tag not in ("ul", "ol") else "li"
            if kind == "form" and rng.random() < 0.6:
                text = f"<label>{text}</label><input name=q><button>{words(1, 3)}</button>"
            if kind == "comments" and rng.random() < 0.5:
                text = f'<div class="{rng.choice(["comment", "comment body", "reply"])}"><p>{text}</p></div>'
            inside.append(f"<{wrap}>{text}</{wrap}>" if wrap else text + "<br>")
        if tag not in ("ul", "ol", "select") and kind != "choice" and rng.random() < (0.6 if kind == "header" else 0.3):
            level = str(rng.choice(["h1", "h1", "h2"] if kind == "header" else ["h2", "h3", "h4"]))
            inside = [f"<{level}>{words(1, 5)}</{level}>", *inside[: rng.integers(0, 4)]]
        if tag in ("aside", "nav", "div") and kind in ("menu", "sidebar") and rng.random() < 0.4:
            inside.append("<ul>" + "".join(f'<li><a href="/z">{words(1, 8)}</a></li>' for _ in range(rng.integers(1, 5))) + "</ul>")
        held = "".join(inside)
        if kind == "choice" and tag != "select":
            held = f"<select>{held}</select>"
        return f'<{tag}{named} data-gold="0">{held}</{tag}>'

    def cell(kind: str) -> str:
        """A part as a cell of a layout table; links and short lines may be all that tells it."""
        named = attributes(_PARTS[kind][1], 0.5 if kind in ("menu", "footer") else 1.0)
        lines = [words(1, 6) for _ in range(rng.integers(1, 7))]
        if kind == "menu":
            lines = [f'<a href="/x">{line}</a>' for line in lines]
        if kind == "footer":
            lines[0] = "&copy; " + lines[0]
        gap = str(rng.choice(["<br>", "</p><p>"]))
        return f'<td{named} data-gold="0">{gap.join(lines)}</td>'

    def article() -> str:
        tag = str(rng.choice(["article", "article", "main", "div", "section"]))
        named = attributes(_ARTICLE_NAMES, 1.0 if tag in ("div", "section") and rng.random() < 0.8 else 0.3)
        inside = [f"<h1>{words(2, 14)}</h1>"] if rng.random() < 0.85 else []
        if inside and rng.random() < 0.2:
            inside = [f"<header>{inside[0]}</header>"]
        for _ in range(rng.integers(1, 14)):
            text = words(1, 150)
            if rng.random() < 0.15:
                text = text.replace(" ", ' <a href="/y">', 1) + "</a>"
            wrap = str(rng.choice(["p", "p", "p", "p", "p", "h2", "h3", "blockquote", "li", "pre", "td", "figcaption", "div", "b"]))
            inside.append({"li": f"<ul><li>{text}</li></ul>", "td": f"<table><tr><td>{text}</td></tr></table>", "b": f"<b>{text}<br>"}.get(wrap, f"<{wrap}>{text}</{wrap}>"))
            if rng.random() < 0.2:
                inside.append(part(str(rng.choice(_INSIDE))))
        if rng.random() < 0.25:
            inside.insert(0, part(str(rng.choice(["menu", "share", "header", "advert"]))))
        if rng.random() < 0.3:
            inside.append(part(str(rng.choice(["comments", "sidebar", "form", "share", "footer"]))))
        return f'<{tag}{named} data-gold="1">{"".join(inside)}</{tag}>'

    def in_table() -> str:
        middle = f'<td{attributes(_ARTICLE_NAMES, 0.5)} data-gold="1">{article()}</td>'
        row = [cell("menu"), middle, cell(str(rng.choice(["advert", "sidebar", "menu"])))][: rng.integers(2, 4)]
        rows = ["".join(row if rng.random() < 0.8 else row[::-1])]
        if rng.random() < 0.6:
            rows.insert(0, cell("header"))
        if rng.random() < 0.6:
            rows.append(cell("footer"))
        return "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"

    pages = []
    for _ in range(count):
        before = [part(k) for k in ("notice", "header", "menu", "advert", "form", "sidebar") if rng.random() < 0.45]
        after = [part(k) for k in ("share", "comments", "advert", "sidebar", "form", "choice", "notice", "footer") if rng.random() < 0.4]
        rng.shuffle(before)
        main = in_table() if rng.random() < 0.15 else article()
        if rng.random() < 0.25:
            held = "".join([main, *after[: rng.integers(0, 3)]])
            main = f"<{(tag := rng.choice(['main', 'div', 'section', 'div']))}{attributes(['main', 'content', 'column', 'page'], 0.6)}>{held}</{tag}>"
        body = "".join([*before, main, *after])
        if rng.random() < 0.4:
            body = f'<div{attributes(["page", "wrapper", "container", "site", "row"], 0.8)}>{body}</div>'
        pages.append(f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title></head><body>{body}</body></html>")
    return pages


def train_extractor(pages: list[str] | None = None) -> BlockField:
    """A field from labelled pages; by default those of ``labelled_pages``."""
    return BlockField.trained([leaf_blocks(page) for page in pages or labelled_pages()])


def main_text(page: str, model: BlockField) -> str:
    blocks = leaf_blocks(page)
    return " ".join(block.text for block, label in zip(blocks, model.labels(blocks), strict=True) if label)


def extract_text(
    pages: DataFrame, model: BlockField, id_column: str = "page_id", html_column: str = "html", extra: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Per row: id, the columns named in ``extra``, ``text``, ``n_chars`` (code points).

    Defined results: a null or empty page and a page without article blocks give an empty text; rows are
    handled one by one, so null ids, repeated rows and an empty table need no rule; other columns are not read.
    """
    rows = pages.select(id_column, *extra, F.coalesce(F.col(html_column), F.lit("")).alias("__html"))
    kept = rows.schema.fields[:-1]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), model) for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                [*[f.name for f in kept], "text", "n_chars"],
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "text string", "n_chars long"])
    return rows.mapInArrow(extract, schema)
