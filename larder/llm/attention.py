"""The causal self-attention model of operator 3, in numpy.

A subword's probability is that of its class after the subwords before it, times its share of the class.
One layer of causal self-attention over subword and place embeddings moves the log odds of the classes away
from those after the subword just before; these, and the shares, come from counts over all training documents.

Windows hold ``2 * STRIDE`` subwords and overlap by half: each window scores its second half, so every
subword is scored once, with at least ``STRIDE`` subwords before it where the text has them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CLASSES = 64
#: Subwords with an embedding and pair counts of their own; the last stands for all others.
HEADS = 2048
WIDTH = 16
STRIDE = 16
WINDOW = 2 * STRIDE
#: Windows computed at once: their arrays stay in the processor's caches, and their products below a million
#: multiplications, which BLAS does without copying the operands first.
PART = 52

_CAUSAL = (np.arange(WINDOW)[None, :] <= STRIDE + np.arange(STRIDE)[:, None]).astype(np.float32)
_MOST, _LEAST = np.float32(40), np.float32(1e-30)
_SHAPES = {
    "embed": (HEADS, WIDTH),
    "place": (WINDOW, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "out": (WIDTH, CLASSES),
}
_ENDS = np.cumsum([np.prod(shape) for shape in _SHAPES.values()])[:-1]
#: Where the embedding of each head lies among all of them.
_PLACES = np.arange(HEADS * WIDTH).reshape(HEADS, WIDTH)
Parameters = dict[str, np.ndarray]


def start_parameters() -> Parameters:
    rng = np.random.default_rng(17)
    found = {name: rng.normal(0, 0.3, shape).astype(np.float32) for name, shape in _SHAPES.items()}
    found["out"] *= 0.1
    return found


def flatten(parameters: Parameters) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in _SHAPES]).astype(np.float64)


def unflatten(values: np.ndarray) -> Parameters:
    """Views of ``values`` where these are 32-bit floats."""
    parts = np.split(np.asarray(values, np.float32), _ENDS)
    return {name: part.reshape(shape) for (name, shape), part in zip(_SHAPES.items(), parts, strict=True)}


def windows(ids: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, WINDOW) and targets (n, STRIDE) of the windows of sequences, and the sequence of each.

    Before the first subword of a sequence stands ``start``. Padding is -1.
    """
    counts = np.array([len(part) for part in ids], np.int64)
    blocks = -(-counts // STRIDE)
    # A block of padding, then the blocks of the sequence: as targets, and as inputs moved on by one id.
    first = np.cumsum(blocks + 1) - (blocks + 1)
    targets = np.full((int((blocks + 1).sum()), STRIDE), -1, np.int32)
    inputs = np.full(targets.shape, -1, np.int32)
    flat = np.concatenate(ids) if len(ids) else np.empty(0, np.int32)
    at = np.arange(len(flat)) + np.repeat((first + 1) * STRIDE - (np.cumsum(counts) - counts), counts)
    targets.ravel()[at] = flat
    inputs.ravel()[1:] = targets.ravel()[:-1]
    inputs[targets < 0] = -1
    inputs.ravel()[(first[counts > 0] + 1) * STRIDE] = start
    own = np.repeat(np.arange(len(ids)), blocks)
    rows = np.arange(len(own)) + own
    return np.concatenate([inputs[rows], inputs[rows + 1]], axis=1), targets[rows + 1], own


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One product for the whole batch; numpy would make one per window."""
    return (a.reshape(-1, a.shape[-1]) @ b).reshape(*a.shape[:-1], b.shape[-1])


def _turned(a: np.ndarray) -> np.ndarray:
    """The windows' matrices turned, in a copy: products with a turned view take three times as long."""
    return np.ascontiguousarray(a.transpose(0, 2, 1))


def _joined(p: Parameters) -> tuple[np.ndarray, ...]:
    """The matrices for queries, and for keys and values at once; and the turned ones, for the way back."""
    both = np.concatenate([p["key"], p["value"]], axis=1)
    return p["query"] * np.float32(WIDTH**-0.5), both, np.ascontiguousarray(both.T), np.ascontiguousarray(p["out"].T)


def _forward(p: Parameters, before: np.ndarray, seen: np.ndarray, joined: tuple[np.ndarray, ...] | None = None) -> dict[str, np.ndarray]:
    """Masked attention of a batch of windows of heads. ``weights`` are not divided by their ``sums``, the context is."""
    to_query, to_both, *_ = joined or _joined(p)
    heads = np.maximum(seen, 0).astype(np.intp)
    x = p["embed"].take(heads, axis=0)
    x += p["place"]
    asking = np.ascontiguousarray(x[:, STRIDE:])
    query = _times(asking, to_query)
    both = _times(x, to_both)
    key, value = both[:, :, :WIDTH], both[:, :, WIDTH:]
    weights = query @ _turned(key)
    if weights.max(initial=0) > _MOST:
        np.minimum(weights, _MOST, out=weights)  # scores stay far below; this replaces a shift by the maximum
    np.exp(weights, out=weights)
    weights *= _CAUSAL
    weights[np.flatnonzero(seen[:, 0] < 0), :, :STRIDE] = 0  # a sequence's first window has nothing before
    sums = np.maximum(_sums(weights), _LEAST)[..., None]
    context = weights @ value
    context /= sums
    logits = _times(context, p["out"])
    logits += before.take(heads[:, STRIDE:], axis=0)
    return {
        **{"heads": heads, "x": x, "asking": asking, "query": query, "key": key, "value": value},
        **{"weights": weights, "sums": sums, "context": context, "logits": logits},
    }


def _sums(a: np.ndarray) -> np.ndarray:
    """Sums along the last axis."""
    return (a.reshape(-1, a.shape[-1]) @ np.ones(a.shape[-1], a.dtype)).reshape(a.shape[:-1])


def _to_odds(logits: np.ndarray) -> np.ndarray:
    """The logits in place as odds; where some are large, what was taken from them before."""
    shift = np.zeros(1, np.float32)
    if logits.max(initial=0) > _MOST:
        shift = logits.max(axis=-1, keepdims=True)
        logits -= shift
    np.exp(logits, out=logits)
    return shift[..., 0]


def class_and_opening_logs(
    p: Parameters, before: np.ndarray, seen: np.ndarray, wanted: np.ndarray, openings: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Natural logs (n, STRIDE): the probability of the wanted classes, and that any opening id comes there; 0 at padding.

    ``openings`` (head, class): the share of opening ids in a class after a head. Without it their log is 0.
    """
    joined = _joined(p)
    chosen, total, opened = (np.empty(wanted.shape, np.float32) for _ in range(3))
    for start in range(0, len(seen), PART):
        part = slice(start, start + PART)
        forward = _forward(p, before, seen[part], joined)
        logits, here = forward["logits"], forward["heads"][:, STRIDE:]
        at = np.arange(here.size) * CLASSES + np.maximum(wanted[part], 0).ravel()
        chosen[part] = logits.ravel().take(at).reshape(here.shape)
        chosen[part] -= _to_odds(logits)
        total[part] = _sums(logits)
        if openings is not None:
            np.einsum("nij,nij->ni", logits, openings.take(here, axis=0), out=opened[part])
    real = wanted >= 0
    found = np.where(real, chosen - np.log(total), np.float32(0))
    if openings is None:
        return found, np.zeros_like(found)
    return found, np.where(real, np.log(np.maximum(opened / total, _LEAST)), np.float32(0))


def class_log_probabilities(p: Parameters, before: np.ndarray, seen: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log probabilities (n, STRIDE) of the wanted classes; 0 at padding."""
    return class_and_opening_logs(p, before, seen, wanted)[0]


def _gradients(p: Parameters, before: np.ndarray, seen: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Gradients of a batch, summed over parts and flat as the parameters are."""
    flat = np.zeros(sum(value.size for value in p.values()), np.float32)
    total = unflatten(flat)
    count, joined = np.float32(max(1, (wanted >= 0).sum())), _joined(p)
    for start in range(0, len(seen), PART):
        _add_gradients(total, p, joined, before, seen[start : start + PART], wanted[start : start + PART], count)
    return flat


def _add_gradients(
    total: Parameters, p: Parameters, joined: tuple[np.ndarray, ...], before: np.ndarray, seen: np.ndarray, wanted: np.ndarray, count: np.float32
) -> None:
    f = _forward(p, before, seen, joined)
    _, _, from_both, from_logits = joined
    x, query, weights, context, slope = (f[name] for name in ("x", "query", "weights", "context", "logits"))
    _to_odds(slope)
    odds = _sums(slope)
    # The slope is this difference times ``scale``, which goes to the narrower arrays instead.
    slope.ravel()[np.arange(wanted.size) * CLASSES + np.maximum(wanted, 0).ravel()] -= odds.ravel()
    scale = ((wanted >= 0) / (count * odds))[..., None].astype(np.float32)
    to_context = _times(slope, from_logits)
    to_context *= scale / f["sums"]
    to_scores = to_context @ _turned(f["value"])
    to_scores -= np.einsum("niw,niw->ni", to_context, context)[..., None]
    to_scores *= weights
    to_query = to_scores @ f["key"]
    to_query *= np.float32(WIDTH**-0.5)
    to_both = np.empty((len(x), WINDOW, 2 * WIDTH), np.float32)  # to the key, then to the value
    np.matmul(to_scores.transpose(0, 2, 1), query, out=to_both[:, :, :WIDTH])  # the query is scaled already
    np.matmul(weights.transpose(0, 2, 1), to_context, out=to_both[:, :, WIDTH:])
    to_x = _times(to_both, from_both)  # 0 where padding is
    to_x[:, STRIDE:] += _times(to_query, p["query"].T)
    np.add.at(total["embed"].reshape(-1), _PLACES.take(f["heads"], axis=0).ravel(), to_x.ravel())

    def outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.reshape(-1, a.shape[-1]).T @ b.reshape(-1, b.shape[-1])

    total["place"] += to_x.sum(axis=0)
    total["query"] += outer(f["asking"], to_query)
    both = outer(x, to_both)
    total["key"] += both[:, :WIDTH]
    total["value"] += both[:, WIDTH:]
    context *= scale
    total["out"] += outer(context, slope)


def train(
    p: Parameters, before: np.ndarray, seen: np.ndarray, wanted: np.ndarray, rounds: int, rate: float, batch: int = 256, seed: int = 1
) -> Parameters:
    """Adam over shuffled batches of windows."""
    flat = flatten(p).astype(np.float32)
    p = unflatten(flat)
    mean, square, move = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    rng, step = np.random.default_rng(seed), 0
    for _ in range(rounds):
        order = rng.permutation(len(seen))
        for start in range(0, len(order), batch):
            step += 1
            some = order[start : start + batch]
            slope = _gradients(p, before, seen[some], wanted[some])
            np.subtract(slope, mean, out=move)
            move *= 0.1
            mean += move
            slope *= slope
            slope -= square
            slope *= 0.001
            square += slope
            np.divide(square, 1 - 0.999**step, out=move)
            np.sqrt(move, out=move)
            move += 1e-8
            np.divide(mean, move, out=move)
            move *= rate / (1 - 0.9**step)
            flat -= move
    return p


def common_subwords(counts: np.ndarray) -> np.ndarray:
    """The ids whose company tells classes apart: the most frequent without the end, the last id."""
    return np.argsort(-counts[:-1], kind="stable")[:200]


def subword_classes(counts: np.ndarray, left: np.ndarray, right: np.ndarray, n: np.ndarray, spaced: np.ndarray, least: int = 5) -> np.ndarray:
    """A class for each subword id, by clustering the company that the ids keep.

    ``counts`` per id; ``n`` says how often ``right`` follows ``left``, for the pairs with a common subword. The
    last id (end of text) is class 0; ids rarer than ``least`` take class 1 or 2 by whether they begin a word
    (``spaced``).
    """
    size = len(counts)
    classes = np.where(spaced, 1, 2)
    classes[size - 1] = 0
    counts = counts.copy()
    counts[size - 1] = 0
    known = np.flatnonzero(counts >= least)
    wanted = min(CLASSES - 3, len(known))
    if not wanted:
        return classes
    common = np.full(size, -1)
    top = common_subwords(counts)
    common[top] = np.arange(len(top))
    row = np.full(size, -1)
    row[known] = np.arange(len(known))
    company = np.zeros((len(known), 2 * len(top)), np.float32)
    for here, there, shift in ((right, left, 0), (left, right, len(top))):
        use = (row[here] >= 0) & (common[there] >= 0)
        np.add.at(company, (row[here[use]], common[there[use]] + shift), n[use])
    company = np.sqrt(company)
    company /= np.maximum(np.linalg.norm(company, axis=1, keepdims=True), 1e-9)
    by_count = np.argsort(-counts[known], kind="stable")
    centres = company[by_count[:wanted]].copy()
    weight = np.sqrt(counts[known]).astype(np.float32)[:, None]
    for _ in range(12):
        group = np.argmax(company @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, company * weight)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centres)
    classes[known] = 3 + group
    classes[size - 1] = 0
    return classes


def head_subwords(counts: np.ndarray) -> np.ndarray:
    """The head of each subword id: the most frequent ids by ``counts``, the end, and one for all others."""
    counts = counts.copy()
    counts[-1] = counts.max(initial=0) + 1
    top = np.argsort(-counts, kind="stable")[: HEADS - 1]
    heads = np.full(len(counts), HEADS - 1)
    heads[top[counts[top] > 0]] = np.arange((counts[top] > 0).sum())
    return heads


@dataclass
class Tables:
    """What counts say: log odds of classes after each head, shares of ids in their class, alone and by head before."""

    classes: np.ndarray
    heads: np.ndarray
    before: np.ndarray
    shares: np.ndarray
    paired: np.ndarray

    @classmethod
    def counted(
        cls, classes: np.ndarray, heads: np.ndarray, counts: np.ndarray, inside: np.ndarray, ends: np.ndarray, crossing: np.ndarray
    ) -> Tables:
        """``counts`` per id; ``inside`` (head, head) pairs within words; ``ends``: how often a head ends a word.

        Pairs of heads across words are not counted: what follows a word goes by ``crossing``, the class pairs.
        """
        held = counts + 0.5
        alone = held / np.bincount(classes, held, CLASSES)[classes]
        of_head = np.full(HEADS, -1)
        of_head[heads[heads < HEADS - 1]] = classes[heads < HEADS - 1]
        member = (of_head[:, None] == np.arange(CLASSES)).astype(float)
        to_class = inside @ member
        follows = crossing + 0.1
        follows /= follows.sum(axis=1, keepdims=True)
        overall = np.bincount(classes, held, CLASSES) / held.sum()
        # What follows the head of all others goes by the overall classes.
        after = np.where((of_head >= 0)[:, None], follows[np.maximum(of_head, 0)], overall)
        odds = to_class + ends[:, None] * after + 5 * overall
        before = np.log(np.maximum(odds / odds.sum(axis=1, keepdims=True), 1e-30)).astype(np.float32)
        kinds = (inside > 0).astype(float) @ member + 1
        own = np.ones(HEADS)
        own[heads[heads < HEADS - 1]] = alone[heads < HEADS - 1]
        column = np.maximum(of_head, 0)
        paired = np.log((inside + kinds[:, column] * own) / (to_class + kinds)[:, column]).astype(np.float32)
        # An id without a head has its class's rest after any head.
        rest = np.log(kinds / (to_class + kinds)).astype(np.float32)
        return cls(classes, heads, before, np.log(alone), np.concatenate([paired[:, :-1], rest], axis=1))


    def openings(self, opens: np.ndarray) -> np.ndarray:
        """The share (head, class) that the ids marked in ``opens`` have of a class after a head."""
        plain = self.heads == HEADS - 1
        member = np.zeros((HEADS - 1, CLASSES))
        own = opens & ~plain
        member[self.heads[own], self.classes[own]] = 1
        rest = np.bincount(self.classes[opens & plain], np.exp(self.shares[opens & plain]), CLASSES)
        paired = np.exp(self.paired)
        return (paired[:, : HEADS - 1] @ member + paired[:, HEADS - 1 :] * rest).astype(np.float32)


@dataclass
class LanguageModel:
    parameters: Parameters
    tables: Tables
    #: Of ``Tables.openings``; ids that open a word or end the text.
    openings: np.ndarray | None = None

    def log_probabilities(self, ids: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of every id, sequence after sequence, given those before it in its sequence.

        A sequence ends with the end id, the last of the vocabulary.
        """
        return self.id_and_opening_logs(ids)[0]

    def id_and_opening_logs(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``log_probabilities``, and at the place of every id the log of the chance that some opening id comes there."""
        tables = self.tables
        seen, wanted, _ = windows(ids, len(tables.classes) - 1)
        heads, classes = np.append(tables.heads, -1), np.append(tables.classes, -1)
        seen = heads[seen]
        real = wanted >= 0
        logs, opening = class_and_opening_logs(self.parameters, tables.before, seen, classes[wanted], self.openings)
        target, last = wanted[real], seen[:, STRIDE:][real]
        plain = tables.heads[target] == HEADS - 1
        column = np.where(plain, HEADS - 1 + tables.classes[target], tables.heads[target])
        found = logs[real].astype(np.float64) + tables.paired[last, column] + np.where(plain, tables.shares[target], 0.0)
        return found, opening[real].astype(np.float64)
