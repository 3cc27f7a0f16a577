"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language gives longest matches. A text is parsed greedily
into the longest phrases that occur in the language's sample; the language that needs the fewest
phrases, divided by what its own text needs, wins.

Defined cases: null text and text without a letter are ``und`` with score 0; a tie goes to the
smaller language code; without any labelled row every text is ``und``. Repeated rows get equal
results. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattloom.llm.common import fold, labelled_sample, narrowed, slices, table

#: Bytes of labelled text an automaton is built from, and of further text its own phrase rate is measured on.
SAMPLE_BYTES, RATE_BYTES = 32_768, 16_384
#: Sampled documents per language, and the bound on all automata together, in bytes of text.
DOCUMENTS_PER_LANGUAGE, ALL_SAMPLES = 96, 1 << 20
#: A text is parsed in blocks of this many symbols, each on its own; phrases are summed.
BLOCK = 1024
#: How sharply the score of the best language grows with its lead.
SHARPNESS = 12


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    symbols: np.ndarray  # of each byte; 0 parts words
    steps: np.ndarray  # state + symbol -> state, 0 where no phrase goes on; states are multiples of the alphabet's size
    roots: np.ndarray  # of each language
    rates: np.ndarray  # phrases a symbol that a language's own text needs


def letters_only(text: bytes, decoded: str | None = None) -> bytes:
    """Lower-cased letters and bytes beyond ASCII; each run of anything else becomes one space."""
    low = (decoded if decoded is not None else text.decode("utf-8", "replace")).lower().encode("utf-8", "replace")
    return low.translate(_PARTED)


_PARTED = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


def suffix_automaton(sample: Iterable[int], width: int) -> list[list[int]]:
    """Transitions by state and symbol; 0 is no state, 1 is the root."""
    step, link, length, last = [[0] * width, [0] * width], [0, 0], [0, 0], 1
    for symbol in sample:
        new = len(step)
        step.append([0] * width)
        length.append(length[last] + 1)
        link.append(1)
        at, last = last, new
        while at and not step[at][symbol]:
            step[at][symbol] = new
            at = link[at]
        if not at:
            continue
        seen = step[at][symbol]
        if length[seen] == length[at] + 1:
            link[new] = seen
            continue
        copy = len(step)
        step.append(step[seen][:])
        length.append(length[at] + 1)
        link.append(link[seen])
        link[seen] = link[new] = copy
        while at and step[at][symbol] == seen:
            step[at][symbol] = copy
            at = link[at]
    return step


def fit(samples: dict[str, bytes]) -> LanguageModel:
    """``samples``: parted text of each language; its first SAMPLE_BYTES build the automaton, the next RATE_BYTES its rate."""
    languages = sorted(k for k, v in samples.items() if v.strip())
    most = min(SAMPLE_BYTES, ALL_SAMPLES // max(1, len(languages)))
    build = {k: samples[k][: max(1, min(most, len(samples[k]) * 2 // 3))] for k in languages}
    used = sorted({b for v in build.values() for b in v} | {32})
    symbols = np.full(256, len(used), dtype=np.int64)  # the last symbol: in no sample
    for i, b in enumerate([32, *[b for b in used if b != 32]]):
        symbols[b] = i
    width = len(used) + 1
    parts, roots, offset = [], [], 0
    for k in languages:
        step = np.array(suffix_automaton(symbols[np.frombuffer(build[k], np.uint8)].tolist(), width), dtype=np.int32)
        parts.append(np.where(step > 0, (step + offset) * width, 0).astype(np.int32))
        roots.append((1 + offset) * width)
        offset += len(step)
    steps = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)
    model = LanguageModel(languages, symbols, steps, np.array(roots, dtype=np.int32), np.ones(len(languages)))
    rates = []
    for i, k in enumerate(languages):
        own = samples[k][len(build[k]) :][:RATE_BYTES] or build[k]
        phrases, n = phrase_counts(model, [own])
        rates.append(max(phrases[i, 0] / max(n[0], 1), 1e-6))
    return LanguageModel(languages, symbols, steps, model.roots, np.array(rates))


def phrase_counts(model: LanguageModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases by language and text, and symbols by text. All blocks of all texts step together."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = model.symbols[np.frombuffer(b"".join(texts), np.uint8)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    keep = np.ones(len(data), dtype=bool)
    if len(data):
        keep[1:] = (data[1:] > 0) | (data[:-1] > 0) | (owner[1:] != owner[:-1])
    data, sizes = data[keep], np.bincount(owner[keep], minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    blocks = -(-sizes // BLOCK)
    of = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin, length = starts[of] + nth * BLOCK, np.minimum(BLOCK, sizes[of] - nth * BLOCK)
    order = np.argsort(-length, kind="stable")
    begin, length, of = begin[order], length[order], of[order]
    width = int(model.symbols.max()) + 1
    first = model.steps[model.roots[:, None] + np.arange(width)]
    first = np.where(first > 0, first, model.roots[:, None]).astype(np.int32)
    state = np.repeat(model.roots[:, None], len(of), axis=1)
    phrases = np.zeros(state.shape, dtype=np.int64)
    root = model.roots[:, None]
    alive = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
    for t, k in enumerate(alive):
        symbol = data[begin[:k] + t]
        at = state[:, :k]
        to = model.steps[at + symbol]
        stuck = to == 0
        phrases[:, :k] += stuck | (at == root)  # a phrase begins
        state[:, :k] = np.where(stuck, first[:, symbol], to)  # at the root again if no phrase begins so
    total = np.zeros((len(model.languages), len(texts)), dtype=np.int64)
    for i in range(len(model.languages)):
        total[i] = np.bincount(of, weights=phrases[i], minlength=len(texts)).astype(np.int64)
    return total, sizes


def judge(model: LanguageModel, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    parted, has = [], []
    for text in texts:
        decoded = (text or b"").decode("utf-8", "replace")
        parted.append(letters_only(b"", decoded))
        has.append(bool(text) and (not decoded.isascii() or parted[-1].strip() != b"") and any(map(str.isalpha, decoded)))
    if not model.languages or not texts:
        return ["und"] * len(texts), [0.0] * len(texts)
    phrases, _ = phrase_counts(model, parted)
    needed = np.maximum(phrases, 1) / model.rates[:, None]
    best = needed.argmin(axis=0)
    weight = (needed.min(axis=0) / needed) ** SHARPNESS
    score = 1 / weight.sum(axis=0)
    return [model.languages[b] if h else "und" for b, h in zip(best, has, strict=True)], [float(s) if h else 0.0 for s, h in zip(score, has, strict=True)]


def train(docs: DataFrame) -> LanguageModel:
    """Learns from rows whose fold (crc32 of the id modulo 5) is not 0 and whose lang is given."""
    rows = narrowed(docs.where(fold(5) != 0), "doc_id", "lang").withColumnRenamed("lang", "label").where("trim(label) <> ''")
    samples: dict[str, bytes] = {}
    for row in labelled_sample(rows, DOCUMENTS_PER_LANGUAGE):
        samples[row["label"]] = samples.get(row["label"], b"") + b" " + letters_only(bytes(row["text"]))
    return fit({k: b" ".join(v.split()) for k, v in samples.items()})


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang)."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            language, certainty = judge(shared.value, part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), part.column("held_out"), pa.array(language, pa.string()), pa.array(certainty, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = narrowed(docs.withColumn("held_out", fold(5) == 0), "doc_id", "held_out")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, least: float = 0.3, model: LanguageModel | None = None) -> DataFrame:
    """The documents with a language: rows that are ``und``, or scored below ``least``, go. Columns stay as they are."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [None if t is None else t.encode("utf-8", "replace") for t in part.column("text").to_pylist()]
            language, certainty = judge(shared.value, texts)
            yield part.filter(pa.array([x != "und" and s >= least for x, s in zip(language, certainty, strict=True)]))

    return docs.mapInArrow(keep, docs.schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
