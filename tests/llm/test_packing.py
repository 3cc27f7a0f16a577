from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from wattloom.llm import packing

PATH = packing.public_vocabulary()


def _one_by_one(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [(free, i) for i, free in enumerate(bins) if free >= length]
        if fits:
            bins[min(fits)[1]] -= length
        else:
            bins.append(capacity - length)
    return sorted(bins)


def test_runs_pack_like_single_pieces():
    draw = random.Random(5)
    for _ in range(200):
        capacity = draw.choice([10, 37, 2048])
        lengths = [draw.randint(1, capacity if draw.random() < 0.6 else max(1, capacity // 8)) for _ in range(draw.randint(1, 150))]
        counts = Counter(lengths)
        plan = packing.best_fit(counts, capacity)
        length = np.array(sorted(lengths))
        rank = np.concatenate([np.arange(counts[n]) for n in sorted(counts)])
        filled: dict[int, int] = {}
        for sequence, offset, n in sorted(zip(*plan.place(length, rank), length, strict=True)):
            assert filled.get(sequence, 0) == offset
            filled[sequence] = offset + n
        assert sorted(capacity - n for n in filled.values()) == _one_by_one(lengths, capacity)


def test_tree_finds_the_tightest():
    draw, tree, there = random.Random(1), packing.CapacityTree(100), set()
    for _ in range(2000):
        c = draw.randint(0, 100)
        (there.discard if c in there else there.add)(c)
        tree.set(c, c in there)
        n = draw.randint(0, 100)
        assert tree.tightest(n) == min((x for x in there if x >= n), default=None)


TEXTS = [
    "Hello, World!! it's 3 o'clock*** <|endoftext|>x a<|startoftext|> b",
    "é É ÀÇñ ſt İstanbul ΑΣ ßtraße x́ ́y ﬁ ①",
    "  a\x1cb\x85c\xa0d — «q» ... --- $$$### re've 'll",
    "日本語 тест ǅ ª º ẞ",
    "",
]


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    for text in TEXTS:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(b"".join(map(words.__getitem__, text.encode().split())), "<u4").tolist() == ids, text


@pytest.mark.parametrize("word", ["word”.", "wait…)", "yes😀!!", "»,", "—(", "है,", "x́,", "İ!", "\u0958.", "H\u0331", "J\u030c:", "straße!", "ÉTÉ.", "日本。)", "\u1100\u1161!"])
def test_punctuation_stays_with_what_is_no_letter(word):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(PATH)[word.encode()], "<u4").tolist() == ids


def test_pieces_cover_texts_and_fill_sequences(odd_docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    out = packing.pack(odd_docs, PATH, capacity=64).collect()
    pieces: dict = {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for row in odd_docs.collect():
        if row["doc_id"] in (None, 6):
            continue
        ids = np.array([*whole.encode(row["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cut = [ids[i : i + 64] for i in range(0, len(ids), 64)]
        assert sorted(pieces[row["doc_id"]]) == [(k, 64 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(cut)]
    filled: dict[int, int] = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled.get(r["sequence_id"], 0) == r["offset"]
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 64
    assert len(filled) == len(_one_by_one([r["length"] for r in out], 64))


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


@pytest.mark.parametrize("counts", [{}, {5: 3}, {2048: 2, 1: 4096}])
def test_small_plans(counts):
    assert packing.best_fit(counts).bins == -(-sum(k * n for k, n in counts.items()) // 2048)
