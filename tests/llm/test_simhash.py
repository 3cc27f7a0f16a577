from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from wattloom.llm import simhash
from wattloom.llm.graph import components


def _plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute(codes):
    near = [[j for j in range(len(codes)) if (codes[i] ^ codes[j]).bit_count() <= 4] for i in range(len(codes))]
    label = list(range(len(codes)))
    while True:
        new = [min(label[j] for j in n) for n in near]
        if new == label:
            return label
        label = new


def _planted(draw, seeds, most):
    codes = set()
    for seed in draw.integers(0, 2**63, seeds):
        for _ in range(draw.integers(1, most)):
            code = int(seed)
            for bit in draw.integers(0, 64, draw.integers(0, 8)):
                code ^= 1 << int(bit)
            codes.add(code)
    codes = np.array(sorted(codes), dtype=np.uint64)
    return codes[np.argsort(simhash.gray_rank(codes), kind="stable")]


def test_gray_rank_orders_neighbours():
    ranks = np.arange(1000, dtype=np.uint64)
    codes = ranks ^ (ranks >> np.uint64(1))
    assert (simhash.gray_rank(codes) == ranks).all()


def test_index_finds_every_component():
    for seed in range(5):
        codes = _planted(np.random.default_rng(seed), 60, 30)
        assert simhash.linked(codes).tolist() == _brute([int(c) for c in codes])


def test_dealing_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 8)
    monkeypatch.setattr(simhash, "LARGEST", 64)
    codes = _planted(np.random.default_rng(9), 12, 150)
    truth = _brute([int(c) for c in codes])
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.edges(frame, len(codes))).collect()}
    names = [found.get(int(c), int(c)) for c in codes.view(np.int64)]
    assert len(set(zip(names, truth, strict=True))) == len(set(names)) == len(set(truth))


def test_fingerprints_and_components(odd_docs, no_docs):
    out = simhash.near_duplicates(odd_docs).collect()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    assert len(out) == odd_docs.count()
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] != 5:
            assert r["fingerprint"] == f"{_plain(texts[r['doc_id']]):016x}"
    by_id = {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None}
    assert by_id[2] == by_id[3] == by_id[4] == 2 and by_id[6] == by_id[7] == 6
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_keeps_rows_as_they_are(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 2, 5, 6, 8, 9, 10]
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["no id at all here"]
    assert {r["fp"] for r in rows} == {7} and {r["row"] for r in rows} == {9}
    assert simhash.one_of_each(no_docs).count() == 0


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 700), (700, 600), (9, 9)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), 500: 500, 600: 500, 700: 500}
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
