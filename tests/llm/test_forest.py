from __future__ import annotations

import random
import re

import numpy as np

from wattloom.llm import forest


def _set(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _plain(rows, percent=85):
    sets = [_set(r["text"]) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    out = []
    for r, own, mine in zip(rows, sets, label, strict=True):
        ids = [s["doc_id"] for s, x in zip(rows, label, strict=True) if x == mine and s["doc_id"] is not None]
        least = min(ids) if ids else None
        out.append((r["doc_id"], len(own), least, r["doc_id"] == least))
    return sorted(out, key=str)


def _same(docs):
    rows = docs.select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in forest.near_duplicates(docs).collect()], key=str) == _plain(rows)


def test_odd_rows(odd_docs, no_docs):
    _same(odd_docs)
    assert forest.near_duplicates(no_docs).count() == 0


def _copies(rnd, n_bases, copies, words, most):
    vocabulary = [f"w{i}" for i in range(4000)]
    for _ in range(n_bases):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, most)):
                text[rnd.randrange(words)] = rnd.choice(vocabulary)
            yield " ".join(text)


def test_near_copies_of_all_distances(spark):
    """Copies from equal to just beyond the limit, few and many; shared passages that must not link."""
    rnd = random.Random(4)
    texts = [*_copies(rnd, 40, 4, 120, 5), *_copies(rnd, 2, 150, 200, 4), *_copies(rnd, 10, 3, 8, 1), *_copies(rnd, 1, 250, 60, 3), *_copies(rnd, 1, 200, 150, 14)]
    passage = " ".join(f"shared{i}" for i in range(80))
    texts += [f"{passage} {t}" for t in _copies(rnd, 200, 1, 60, 0)]
    texts += ["One two", "one  TWO", "one", "one two three", "two one"]
    rnd.shuffle(texts)
    _same(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_every_window_meets_the_next(spark, monkeypatch):
    """Crowded regions: rows of one region meet over the borders of windows, batches and halves."""
    monkeypatch.setattr(forest, "WINDOW", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i, bytes([i // 40] * 4 + [100 + i % 40] * (forest.MINIMA - 4)), 5, b"x") for i in range(120)]
        classes = spark.createDataFrame(rows, "id long, signature binary, n long, sketch binary").coalesce(1)
        met = {}
        for r in forest.windows(classes).where("substring(order, 1, 4) in (X'00000000', X'01010101', X'02020202')").collect():
            met.setdefault(r["window"], []).append(r["id"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(map(len, met.values())) <= 8
    assert all(len({i // 40 for i in ids}) == 1 for ids in met.values() if len(ids) > 1)
    near = {(a, b) for ids in met.values() for a in ids for b in ids}
    apart = [i for i in range(119) if i // 40 == (i + 1) // 40 and (i, i + 1) not in near]
    assert len(apart) <= 8  # at most where a partition ends


def test_rounds_name_every_candidate_in_the_end():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, forest.MINIMA, dtype=np.uint8)
    orders = np.tile(base, (60, 1))
    for row in orders:
        row[rng.integers(0, forest.MINIMA, 12)] = rng.integers(0, 256, 12)
    labels, n, same = np.arange(60), np.full(60, 500), forest.Sketches([bytes(64)] * 60)
    whole = {(i, j) for i in range(60) for j in range(i + 1, 60) if (orders[i] == orders[j]).sum() >= forest.ALIKE}
    few, more = forest.alike(orders, labels, n, same, 1)
    assert more and set(few) <= whole and len(few) <= 60
    every, more = forest.alike(orders, labels, n, same, 64)
    assert not more and set(every) == whole
    assert forest.alike(orders, np.zeros(60), n, same, 1) == ([], False)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size in (3, 200, 300, 3000):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        sets = [np.unique(np.r_[base[k:], rng.integers(0, 1 << 63, 2 * k, dtype=np.uint64)]) for k in range(min(size, 120))]
        sketches = forest.Sketches([forest.odd_sketch(s) for s in sets])
        apart = sketches.apart(0, np.arange(len(sets)))
        truth = np.array([len(np.setxor1d(sets[0], s)) for s in sets])
        assert (apart <= truth).all()
        near = truth <= sketches.sizes[0] * 8 // 16  # few flips fall on one bit
        assert (apart[near] >= 0.8 * truth[near]).all()


def test_long_texts_split_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 700} v{i % 11}" for i in range(5000)).encode()
    whole = forest.shingles(text)
    monkeypatch.setattr(forest, "PIECE", 100)
    assert (forest.shingles(text) == whole).all()
    assert len(whole) == len(_set(text.decode()))
