from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattloom.llm import mixing


def test_targets_stop_at_the_cap():
    assert mixing.targets([100, 10, 50, 1], [1, 2, 3, 1]) == [32.0, 30.0, 96.0, 3.0]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0.0, 0.0]
    for seed in range(50):
        draw = random.Random(seed)
        sizes = [draw.randint(0, 1000) for _ in range(draw.randint(1, 12))]
        weights = [1 + i % 3 for i in range(len(sizes))]
        found = mixing.targets(sizes, weights)
        assert sum(found) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(found, sizes, strict=True))
        level = [t / w for t, w, s in zip(found, weights, sizes, strict=True) if t < 3 * s - 1e-9]
        assert not level or max(level) == pytest.approx(min(level))


def test_flight_keeps_totals():
    draw = random.Random(1)
    for _ in range(300):
        n = draw.randint(0, 80)
        sizes = [float(draw.choice([0, 1, 5, 5, 900, draw.randint(0, 50)])) for _ in range(n)]
        chances = [draw.random()] * n
        moved = mixing.flight(sizes, chances, draw)
        assert sum(0 < p < 1 for p in moved) <= 2 and all(0 <= p <= 1 for p in moved)
        assert sum(moved) == pytest.approx(sum(chances), abs=1e-5)
        assert sum(p * s for p, s in zip(moved, sizes, strict=True)) == pytest.approx(sum(p * s for p, s in zip(chances, sizes, strict=True)), abs=1e-2)


def test_chances_are_kept_on_average():
    sizes, chances = [5.0, 1.0, 9.0, 3.0, 0.0, 7.0, 7.0], [0.3] * 7
    sums = [0.0] * 7
    for seed in range(6000):
        draw = random.Random(seed)
        settled = mixing.landing(mixing.flight(sizes, chances, draw), draw)
        assert set(settled) <= {0.0, 1.0}
        sums = [a + b for a, b in zip(sums, settled, strict=True)]
    assert [s / 6000 for s in sums] == pytest.approx(chances, abs=0.03)


def test_sources_meet_their_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 64)  # several levels of blocks
    draw = random.Random(2)
    rows = [(i, " ".join(["w"] * min(400, int(draw.paretovariate(1.1) * 5))), None if i % 50 == 0 else "abc"[0 if i % 3 else i % 9 // 3]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in out) == sorted((r["doc_id"], r["copies"]) for r in again)
    assert len(out) == 4000 and max(r["copies"] for r in out) <= 3
    for source in {r["source"] for r in out}:
        mine = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in mine} == {sum(r["size"] for r in mine)}
        taken, target = sum(r["copies"] * r["size"] for r in mine), mine[0]["target"]
        assert abs(taken - target) < 0.02 * target, source
        often = target / mine[0]["source_size"]
        assert abs(sum(r["copies"] for r in mine) - often * len(mine)) <= 2.01, source


def test_repeated_rows(odd_docs, no_docs):
    out = mixing.mixed(odd_docs).collect()
    assert len(out) == odd_docs.count()
    taken = Counter()
    for r in out:
        taken[r["doc_id"]] += r["copies"]
    rows = mixing.repeated(odd_docs)
    assert rows.columns == odd_docs.columns
    got = Counter(r["doc_id"] for r in rows.collect())
    assert got == Counter({k: n for k, n in taken.items() if n})
    assert {r["row"] for r in rows.collect()} == {9}
    assert mixing.mixed(no_docs).count() == 0 and mixing.repeated(no_docs).agg(F.count("*")).first()[0] == 0


def test_equal_rows_are_spread_over_blocks(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'a b c' as text", "'s' as source")
    units = mixing._with(mixing._numbered(mixing.sizes(docs)), {"s": 0.37}, "chance", "double")
    moved = mixing._moved(mixing._with(units, {"s": 12}, "blocks", "long")).collect()
    assert len(moved) == 3000 and len({r["nth"] for r in moved}) == 3000
    assert 2 < sum(0 < r["chance"] < 1 for r in moved) <= 24
