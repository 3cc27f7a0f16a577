from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from wattloom.llm import alignment

TEXTS = ["plain words, nothing else", "naïve café — “quoted”…", "日本語のテキスト 😀😀!!", "tabs\t\tand\n\nlines  ", " leading", "<|endoftext|> and <s> </s> <0x41>", "▁ mark", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "\x00\x01", "x́ हैं, ", " " * 5000, "123456 7,890.12 it's we'll"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _tokens(libraries, text):
    a, b = libraries
    shown = alignment._byte_of_character()
    side_a = [(i, bytes(shown[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
    side_b = []
    for i in b.encode(text) if text else []:
        piece = b.id_to_piece(i)
        side_b.append((i, bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + (text or "")).encode()
    return (side_a, side_b) if all(b"".join(t for _, t in s) == whole for s in (side_a, side_b)) else ([], [])


def _groups(side_a, side_b):
    """Token by token: the side that is behind goes on; a group ends where both stand at one byte."""
    groups, a, b, x, y, i, j = [], [], [], 0, 0, 0, 0
    while i < len(side_a) or j < len(side_b):
        if x <= y and i < len(side_a):
            a.append(side_a[i][0])
            x, i = x + len(side_a[i][1]), i + 1
        else:
            b.append(side_b[j][0])
            y, j = y + len(side_b[j][1]), j + 1
        if x == y:
            groups.append((a, b))
            a, b = [], []
    return groups


def _plain(libraries, docs):
    grouped = [(i, *_tokens(libraries, text)) for i, text in docs]
    grouped = [(i, a, b, _groups(a, b)) for i, a, b in grouped]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for *_, g in grouped]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (i, a, b, groups), own in zip(grouped, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        n_best = sum(n for pair, n in own.items() if counts[pair] == most[pair[0]])
        total = sum(n * counts[pair] for pair, n in own.items())
        out.append((i, len(a), len(b), len(groups), sum(own.values()), n_best, total, sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def _same(libraries, docs):
    rows = docs.select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in alignment.alignment(docs).collect()], key=str) == _plain(libraries, rows)


def test_odd_rows_against_token_by_token(libraries, odd_docs, no_docs):
    _same(libraries, odd_docs)
    assert alignment.alignment(no_docs).count() == 0


def test_texts_in_several_blocks(spark, libraries):
    rows = [(i, TEXTS[i % len(TEXTS)] + f" row {i % 7}") for i in range(120)] + [(500 + i, t) for i, t in enumerate(TEXTS)]
    _same(libraries, spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_cuts_of_random_ends():
    rng = np.random.default_rng(3)
    for share in (0.01, 0.3, 0.9):
        for _ in range(30):
            sizes = rng.integers(1, 400, rng.integers(1, 9))
            stops = np.cumsum(sizes) * 10
            inner = np.arange(1, stops[-1])
            ends_a = np.union1d(inner[rng.random(len(inner)) < 0.2], stops)
            ends_b = np.union1d(np.union1d(ends_a[rng.random(len(ends_a)) < share], inner[rng.random(len(inner)) < 0.002]), stops)
            hi = np.searchsorted(ends_a, stops) + 1
            found = alignment.shared_cuts(ends_a, ends_b, np.r_[0, hi[:-1]], hi)
            assert (found == np.isin(ends_a, ends_b)).all()


def test_large_groups_count_by_ids(monkeypatch):
    texts = [t.encode() for t in TEXTS]
    plain = alignment.Aligned(texts, alignment.BYTE_LEVEL, alignment.PIECES)
    first = [(p.tolist(), t.tolist()) for p, t in plain.links()]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 0)
    assert [(p.tolist(), t.tolist()) for p, t in plain.links()] == first


def test_fast_ids_are_the_library_s(libraries):
    side = alignment.ByteLevel(alignment.located(alignment.BYTE_LEVEL))
    assert side.fast is not None
    for text in [*TEXTS, "x" * 200_000, "\n" * 60_000, "a" + " " * 1_000_000 + "b", " \n" * 50_000]:
        assert side.ids(" " + text).tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
