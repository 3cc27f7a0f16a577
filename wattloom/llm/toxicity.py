"""Toxicity by a weighted finite-state grammar over clauses.

Words fall into few classes: insult, threat, target (who is addressed), negation, reporting, other.
Transducers for insults at a target, threats at a target, negated and reported clauses are composed
into one deterministic weighted transducer over classes, which reads each clause that holds an insult
or a threat; a clause's weight, not a word's, enters the score. Insulting words and word beginnings
are learned from labelled documents; how matched clauses turn into a probability is, too.

Defined cases: null and empty texts have no clause and score what such documents score; without
labelled rows of both kinds only the fixed words match and the score is a fixed curve; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattloom.llm.common import fold, narrowed, slices, table
from wattloom.llm.labelled import labelled_texts
from wattloom.llm.quality import minimised

DOCUMENTS_PER_LABEL = 2500
TOXIC_FROM = 0.5
#: Learned words and beginnings: least toxic documents, least log odds, least log odds in standard errors.
LEAST_DOCUMENTS, LEAST_ODDS, LEAST_ERRORS = 3, 1.8, 3.0
BEGINNINGS = range(4, 9)
#: Words a worker remembers the class of; it starts afresh beyond.
REMEMBERED = 400_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Fixed words of the grammar.
THREATS = "kill hurt destroy beat shoot stab burn strangle murder töten schlagen umbringen vernichten tuer frapper détruire brûler matar golpear destruir quemar"
TARGETS = "you your yours yourself u ya they them he him she her du dich dir ihr euch dein sie tu te toi vous ton votre tú ti usted ustedes vosotros tus"
NEGATIONS = "not no never isn't aren't don't didn't wasn't neither nor nicht kein keine nie niemals ne pas jamais sin nunca ningún"
REPORTS = "said says say told tells quoted quote claimed wrote called reported asked sagte sagt schrieb zitierte dit disait écrit rapporte dijo dice escribió citó"

_LETTERS = bytes(b if b >= 0x80 or 65 <= b <= 90 or 97 <= b <= 122 or b == 39 else 32 for b in range(256))
_CLAUSE = re.compile(rb"[.!?;:\n]+")


# --- transducers -------------------------------------------------------------------------------
# A transducer is (start, {(state, class): (state, factor, gain)}): a clause's running weight w becomes
# factor * w + gain. Classes without an entry keep the state.


def insult_transducer() -> tuple:
    """An insult counts 1; one that comes with a target counts half as much again."""
    arcs = {("none", INSULT): ("insult", 1.0, 1.0), ("none", TARGET): ("target", 1.0, 0.0), ("target", INSULT): ("both", 1.0, 1.5)}
    arcs |= {("insult", INSULT): ("insult", 1.0, 1.0), ("insult", TARGET): ("both", 1.0, 0.5), ("both", INSULT): ("both", 1.0, 1.5)}
    return "none", arcs


def threat_transducer() -> tuple:
    """A threat counts once it has a target, before or after it."""
    arcs = {("none", THREAT): ("threat", 1.0, 0.0), ("none", TARGET): ("target", 1.0, 0.0), ("target", THREAT): ("both", 1.0, 1.5), ("threat", TARGET): ("both", 1.0, 1.5)}
    return "none", arcs


def negation_transducer() -> tuple:
    """What follows a negation within three words counts a quarter."""
    arcs = {(s, NEGATION): (3, 1.0, 0.0) for s in range(4)}
    arcs |= {(s, c): (s - 1, 0.25, 0.0) for s in (1, 2, 3) for c in (OTHER, INSULT, THREAT, TARGET, REPORT)}
    return 0, arcs


def report_transducer() -> tuple:
    """After a reporting verb the clause is somebody else's and counts half."""
    return "own", {("own", REPORT): ("told", 1.0, 0.0), **{("told", c): ("told", 0.5, 0.0) for c in (INSULT, THREAT, TARGET)}}


def composed() -> tuple[int, list[list[tuple[int, float]]]]:
    """(start, arcs[state][class] = (state, gain)): what the first two add, scaled by the factors of the other two."""
    parts = [insult_transducer(), threat_transducer(), negation_transducer(), report_transducer()]
    start = tuple(p[0] for p in parts)
    number, arcs, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for word_class in range(6):
            to, gain, factor = [], 0.0, 1.0
            for at, (_, moves) in zip(state, parts, strict=True):
                new, scale, more = moves.get((at, word_class), (at, 1.0, 0.0))
                to.append(new)
                gain, factor = gain + more, factor * scale
            to = tuple(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append((number[to], gain * factor))
        arcs.append(row)
    return 0, arcs


class Grammar(dict):
    """Class and weight of a word, remembered; the learned words with the composed transducer."""

    def __init__(self, words: dict[bytes, float], beginnings: dict[bytes, float]):
        super().__init__()
        self.words, self.beginnings = words, beginnings
        self.fixed: dict[bytes, int] = {}
        for text, word_class in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT)):
            self.fixed |= dict.fromkeys(text.encode().split(), word_class)
        self.start, self.arcs = composed()
        self.lengths = sorted({len(b) for b in beginnings})

    def __missing__(self, word: bytes) -> tuple[int, float]:
        weight = max([self.words.get(word, 0.0), *[self.beginnings.get(word[:k], 0.0) for k in self.lengths if k <= len(word)]])
        found = (INSULT, weight) if weight else (self.fixed.get(word, OTHER), 1.0)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def clause_weight(self, words: list[bytes]) -> float:
        state, total = self.start, 0.0
        for word in words:
            word_class, weight = self[word]
            state, gain = self.arcs[state][word_class]
            total += gain * weight
        return total

    def matched(self, text: bytes) -> tuple[float, int, float, int]:
        """Summed and largest clause weight, matched clauses, and words of a text."""
        words = lower_words(text)
        heavy = {w for w in set(words) if self[w][0] in (INSULT, THREAT)}
        if not heavy:
            return 0.0, 0, 0.0, len(words)
        total, clauses, most = 0.0, 0, 0.0
        for clause in _CLAUSE.split(text):
            of = lower_words(clause)
            if heavy.isdisjoint(of):
                continue
            weight = self.clause_weight(of)
            if weight > 0:
                total, clauses, most = total + weight, clauses + 1, max(most, weight)
        return total, clauses, most, len(words)


def lower_words(text: bytes) -> list[bytes]:
    """Runs of letters and apostrophes, lower-cased (beyond ASCII as well)."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_LETTERS).lower().split()


def learned_words(sample: list[tuple[int, bytes]]) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """Words, and beginnings of words, whose share of toxic documents stands out; their log odds."""
    found = (Counter(), Counter())
    documents = [0, 0]
    for label, text in sample:
        documents[label] += 1
        terms = set()
        for word in set(lower_words(text)):
            terms.add((word, True))
            decoded = word.decode("utf-8", "replace")
            terms |= {(decoded[:k].encode(), False) for k in BEGINNINGS if k < len(decoded)}
        found[label].update(terms)
    if not all(documents):
        return {}, {}
    chosen: tuple[dict[bytes, float], dict[bytes, float]] = ({}, {})
    for (term, whole), toxic in found[1].items():
        if toxic < LEAST_DOCUMENTS:
            continue
        clean = found[0][(term, whole)]
        odds = math.log((toxic + 0.5) / (documents[1] - toxic + 0.5)) - math.log((clean + 0.5) / (documents[0] - clean + 0.5))
        error = math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5) + 1 / (documents[1] - toxic + 0.5) + 1 / (documents[0] - clean + 0.5))
        if odds >= LEAST_ODDS and odds >= LEAST_ERRORS * error:
            chosen[0 if whole else 1][term] = odds
    return chosen


def signals(grammar: Grammar, texts: list[bytes]) -> np.ndarray:
    rows = np.array([grammar.matched(t) for t in texts], dtype=np.float64).reshape(-1, 4)
    total, clauses, most, words = rows.T
    share = 100 * total / np.maximum(words, 20)
    return np.column_stack([np.log1p(total), np.log1p(share), np.log1p(clauses), np.log1p(most), np.log1p(words) / 8, np.ones(len(texts))])


#: Used where nothing can be learned: half at about one strong clause in fifty words.
FALLBACK = np.array([0.5, 1.5, 0.0, 0.5, -0.5, -3.0])


def train(docs: DataFrame, labels: DataFrame, per_label: int = DOCUMENTS_PER_LABEL) -> tuple[dict, dict, np.ndarray]:
    """Words and beginnings from one half of the sample by turns; the curve from halves the words have not seen."""
    sample = labelled_texts(docs, labels, "toxic", per_label)
    if len({label for label, _ in sample}) < 2:
        return {}, {}, FALLBACK
    halves = [[x for i, x in enumerate(sample) if i % 2 == h] for h in (0, 1)]
    rows, truth = [], []
    for words_from, curve_from in (halves, halves[::-1]):
        grammar = Grammar(*learned_words(words_from))
        rows.append(signals(grammar, [t for _, t in curve_from]))
        truth += [label for label, _ in curve_from]
    x, y = np.concatenate(rows), np.array(truth, dtype=np.float64)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ w
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return float((np.logaddexp(0, z) - y * z).mean() + 1e-3 * w @ w), x.T @ (p - y) / len(y) + 2e-3 * w

    return *learned_words(sample), minimised(loss, np.zeros(x.shape[1]), rounds=200)


def rated(docs: DataFrame, model: tuple[dict, dict, np.ndarray]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    words, beginnings, curve = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, beginnings)
        for part in slices(batches):
            x = signals(grammar, [t or b"" for t in part.column("text").to_pylist()])
            found = 1 / (1 + np.exp(-np.clip(x @ curve, -500, 500)))
            yield pa.record_batch([part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= TOXIC_FROM).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = narrowed(docs.withColumn("held_out", fold(5) == 0), "doc_id", "held_out")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op10_clause_grammar(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rated(docs, train(docs, table(spark, sf_dir, "labels")))
