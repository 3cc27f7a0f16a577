"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features, and those of the lines before and after it, and the label of
its neighbours decide; forward-backward gives each line's probability of being good, and the document's
score is their mean, weighted by length. Lines are trained with the label of their document.

A text of many lines is worked in pieces: a piece takes over the sums of the lines before and after it and
the two lines at its borders, so a text of any number of lines needs the memory of a piece, and some 40
bytes a line, and gets the score it would get whole.

Defined cases: a null text is an empty one, and an empty text is one empty line; without labelled rows
every score is 0.5; repeated rows score alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import fold, narrowed, slices, table
from wattloom.llm.labelled import labelled_texts

DOCUMENTS_PER_LABEL = 800
GOOD_FROM = 0.3
PENALTY, ROUNDS = 1e-3, 80
#: Bytes of text whose lines are worked on together.
SLICE_BYTES = 1 << 20
#: Lines whose features are held at once; lines of a training text that are learned from.
PIECE_LINES, TRAINED_LINES = 16_384, 500

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _SYMBOL, _CALL, _OTHER = range(8)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[128:] = _LOWER
for _kind, _bytes in ((_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_LOWER, b"abcdefghijklmnopqrstuvwxyz"), (_DIGIT, b"0123456789"), (_SPACE, b" \t\n\r\x0b\x0c"), (_STOP, b".,;:'\"-()?"), (_SYMBOL, b"#*$%&|<>{}[]\\^~`=+_@/"), (_CALL, b"!")):
    _KIND[np.frombuffer(_bytes, np.uint8)] = _kind
#: Features of a line; those of both neighbours and two marks of a text's edge follow.
OWN = 18
FEATURES = 3 * OWN + 3
_MARKS = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and the number of lines of each text."""
    counts = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    kind = _KIND[data]

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(np.float64)

    upper, lower, digit, stop, symbol, call = (per_line(kind == k) for k in (_UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _CALL))
    bars = per_line(data == ord("|"))
    space = kind == _SPACE
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    finish = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    line_of = np.searchsorted(ends, begins)
    words = np.bincount(line_of, minlength=len(ends)).astype(np.float64)
    # Equal neighbours: same length, first byte and sum of marks.
    total = np.concatenate([[np.uint64(0)], np.cumsum(_MARKS[data], dtype=np.uint64)])
    mark = (total[finish] - total[begins]) ^ (data[begins].astype(np.uint64) << np.uint64(3))
    same = np.zeros(len(begins), dtype=bool)
    same[1:] = (mark[1:] == mark[:-1]) & (line_of[1:] == line_of[:-1])
    again = np.bincount(line_of[same], minlength=len(ends)).astype(np.float64)
    mark_of_line = total[ends] - total[starts]
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((np.arange(len(ends)), length, mark_of_line, owner))
    repeated = np.zeros(len(ends))
    repeated[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (mark_of_line[order[1:]] == mark_of_line[order[:-1]]) & (length[order[1:]] == length[order[:-1]]) & (length[order[1:]] > 0)
    n, w, letters = np.maximum(length, 1), np.maximum(words, 1), np.maximum(upper + lower, 1)
    last = data[np.maximum(ends - 1, starts)]
    own = np.column_stack(
        [
            np.log1p(length) / 10, np.log1p(words) / 8, upper / letters, digit / n, np.minimum(stop / w, 3), np.minimum(symbol / w, 5), np.minimum(call / w, 3), np.minimum(bars / w, 1),
            np.minimum((upper + lower) / w / 10, 3), again / w, repeated, length == 0, words <= 3, np.isin(last, np.frombuffer(b".!?", np.uint8)) & (length > 0), words < 20,
            4 * again > words, 10 * symbol > 3 * words, 2 * upper > letters,
        ]
    ).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    is_first, is_last = np.zeros(len(ends)), np.zeros(len(ends))
    is_first[first], is_last[first + counts - 1] = 1, 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[is_first > 0], after[is_last > 0] = 0, 0
    return np.column_stack([own, before, after, is_first, is_last, np.ones(len(ends))]), length, counts


def forward_backward(odds: np.ndarray, counts: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability that each line is good, summed probabilities of neighbouring labels, and the log partition function.

    ``odds`` is each line's score for good (bad scores 0), ``links[a, b]`` the score of b after a. All texts step together.
    """
    order = np.argsort(-counts, kind="stable")
    size = counts[order]
    begin = (np.cumsum(counts) - counts)[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")
    forward, backward = np.zeros((len(odds), 2)), np.zeros((len(odds), 2))
    own = np.column_stack([np.zeros(len(odds)), odds])
    for t in range(longest):
        at = begin[: alive[t]] + t
        if t == 0:
            forward[at] = own[at]
        else:
            before = forward[at - 1]
            forward[at] = own[at] + np.logaddexp(before[:, :1] + links[0], before[:, 1:] + links[1])
    for t in range(longest - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        after = own[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(after[:, :1] + links[:, 0], after[:, 1:] + links[:, 1])
    whole = np.logaddexp(*forward[begin + size - 1].T) if longest else np.zeros(0)
    of = np.empty(len(odds), dtype=np.int64)
    of[np.repeat(begin, size) + np.arange(len(odds)) - np.repeat(np.cumsum(size) - size, size)] = np.repeat(np.arange(len(size)), size)
    good = np.exp(forward[:, 1] + backward[:, 1] - whole[of])
    inner = np.ones(len(odds), dtype=bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            pairs[a, b] = np.exp(forward[at - 1, a] + links[a, b] + own[at, b] + backward[at, b] - whole[of[at]]).sum()
    return good, pairs, float(whole.sum())


def _running(own: np.ndarray, links: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """For each line and label, the log sum over the labels of all lines up to it; ``before`` is that of the line before the first.

    Blocks of lines step together: each sums for either label before it, and the blocks are then joined.
    """
    n = len(own)
    size = int(np.ceil(np.sqrt(n)))
    steps = np.zeros((size * size, 2))
    steps[:n] = own
    steps = steps.reshape(size, size, 2)
    sums = np.empty((size, size, 2, 2))  # step, block, label before the block, label
    for t in range(size):
        if t:
            past = sums[t - 1]
            sums[t] = np.logaddexp(past[:, :, :1] + links[0], past[:, :, 1:] + links[1]) + steps[:, t, None, :]
        else:
            sums[t] = links[None] + steps[:, t, None, :]
    if before is None:  # the first line of a text follows none
        sums[0, 0] = steps[0, 0]
        for t in range(1, size):
            past = sums[t - 1, 0]
            sums[t, 0] = np.logaddexp(past[:, :1] + links[0], past[:, 1:] + links[1]) + steps[0, t]
        before = np.array([0.0, -np.inf])
    out = np.empty((size, size, 2))
    for k in range(size):
        out[k] = np.logaddexp(before[0] + sums[:, k, 0], before[1] + sums[:, k, 1])
        before = out[k, -1]
    return out.reshape(-1, 2)[:n]


def long_score(model: tuple[np.ndarray, np.ndarray], text: bytes, piece: int = PIECE_LINES) -> float:
    """What ``scored`` gives for one text, in pieces of so many lines."""
    weights, links = model
    data = np.frombuffer(text, np.uint8)
    ends = np.append(np.flatnonzero(data == 10), len(data))
    starts = np.append(0, ends[:-1] + 1)
    n, cuts = len(ends), range(0, len(ends), piece)
    keys = np.zeros(n, dtype=np.uint64)
    for s in cuts:
        e = min(n, s + piece)
        total = np.append(np.uint64(0), np.cumsum(_MARKS[data[starts[s] : ends[e - 1]]], dtype=np.uint64))
        mark = total[ends[s:e] - starts[s]] - total[starts[s:e] - starts[s]]
        keys[s:e] = (mark * np.uint64(0x9E3779B97F4A7C15)) ^ (ends[s:e] - starts[s:e]).astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    repeated = np.zeros(n, dtype=bool)
    repeated[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    repeated &= ends > starts
    del keys, order
    odds = np.empty(n)
    for s in cuts:
        e = min(n, s + piece)
        low, high = max(0, s - 1), min(n, e + 1)  # with the line before and the line after
        features, _, _ = line_features([text[starts[low] : ends[high - 1]]])
        again = np.zeros(high - low + 2)
        again[1:-1] = repeated[low:high]
        features[:, 10], features[:, OWN + 10], features[:, 2 * OWN + 10] = again[1:-1], again[:-2], again[2:]
        odds[s:e] = (features @ weights)[s - low : e - low]
    carried, before = [], None
    for s in cuts:
        carried.append(before)
        own = np.column_stack([np.zeros(min(n, s + piece) - s), odds[s : s + piece]])
        before = _running(own, links, before)[-1]
        before = before - before.max()
    after, good, whole = None, 0.0, 0.0
    for s, before in zip(reversed(cuts), reversed(carried), strict=True):
        own = np.column_stack([np.zeros(min(n, s + piece) - s), odds[s : s + piece]])
        both = _running(own[::-1], links.T, after)[::-1]
        after = both[0] - both[0].max()
        both = both + _running(own, links, before) - own
        weight = (ends[s : s + piece] - starts[s : s + piece]) + 1.0
        good += float(weight @ np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1])))
        whole += float(weight.sum())
    return good / whole


def fit(labels: list[int], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of neighbouring labels: the penalised maximum of the conditional likelihood, by L-BFGS."""
    weights, links = np.zeros(FEATURES), np.zeros((2, 2))
    if not texts or len(set(labels)) < 2:
        return weights, links
    features, _, counts = line_features(texts)
    good = np.repeat(np.array(labels, dtype=np.float64), counts)
    inner = np.ones(len(good), dtype=bool)
    inner[np.cumsum(counts) - counts] = False
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = (inner & (good == 0)).sum(), (inner & (good == 1)).sum()
    scale = len(texts)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = x[:FEATURES], x[FEATURES:].reshape(2, 2)
        odds = features @ w
        p, pairs, whole = forward_backward(odds, counts, t)
        value = (whole - good @ odds - (seen * t).sum()) / scale + PENALTY * x @ x
        slope = np.concatenate([features.T @ (p - good), (pairs - seen).ravel()]) / scale + 2 * PENALTY * x
        return value, slope

    x = minimised(loss, np.zeros(FEATURES + 4))
    return x[:FEATURES], x[FEATURES:].reshape(2, 2)


def minimised(loss, x: np.ndarray, rounds: int = ROUNDS, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with halving steps."""
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, kept = slope.copy(), []
        for s, y in reversed(steps):
            a = s @ q / (s @ y)
            q -= a * y
            kept.append(a)
        if steps:
            s, y = steps[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(steps, reversed(kept), strict=True):
            q += s * (a - y @ q / (s @ y))
        step = 1.0 if steps else 1 / max(1.0, float(np.abs(slope).sum()))
        while True:
            to = x - step * q
            new, new_slope = loss(to)
            if new <= value - 1e-4 * step * (q @ slope) or step < 1e-8:
                break
            step /= 2
        s, y = to - x, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        done = value - new < 1e-7 * max(1.0, abs(value))
        x, value, slope = to, new, new_slope
        if done:
            break
    return x


def scored(model: tuple[np.ndarray, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Each text's length-weighted mean probability of a good line."""
    weights, links = model
    out = np.zeros(len(texts))
    together: list[int] = []
    held = 0

    def flush() -> None:
        if together:
            features, length, counts = line_features([texts[i] for i in together])
            good, _, _ = forward_backward(features @ weights, counts, links)
            first, weight = np.cumsum(counts) - counts, length + 1.0
            out[together] = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
            together.clear()

    for i, text in enumerate(texts):
        lines = text.count(b"\n") + 1
        if lines > PIECE_LINES:
            out[i] = long_score(model, text)
            continue
        if held + lines > PIECE_LINES:
            flush()
            held = 0
        together.append(i)
        held += lines
    flush()
    return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, per_label: int = DOCUMENTS_PER_LABEL) -> tuple[np.ndarray, np.ndarray]:
    sample = labelled_texts(docs, labels, "quality", per_label)
    return fit([label for label, _ in sample], [b"\n".join(text.split(b"\n", TRAINED_LINES)[:TRAINED_LINES]) for _, text in sample])


def rated(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            found = scored(model, [t or b"" for t in part.column("text").to_pylist()])
            yield pa.record_batch([part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= GOOD_FROM).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = narrowed(docs.withColumn("held_out", fold(5) == 0), "doc_id", "held_out")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], least: float = GOOD_FROM) -> DataFrame:
    """The documents that score at least ``least``; columns stay as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            texts = [(t or "").encode("utf-8", "replace") for t in part.column("text").to_pylist()]
            yield part.filter(pa.array(scored(model, texts) >= least))

    return docs.mapInArrow(keep, docs.schema)


def op6_line_crf(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rated(docs, train(docs, table(spark, sf_dir, "labels")))
