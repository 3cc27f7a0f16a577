from __future__ import annotations

import numpy as np
import pytest

from wattloom.llm import neighbours


def _brute(rows, every=50, k=5):
    sound = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = np.array(v, dtype=np.float32).astype(np.float64)
    out = {}
    for q in sound:
        if q % every == 0:
            near = [(-float((v * sound[q]).sum() / (np.sqrt((v * v).sum()) * np.sqrt((sound[q] ** 2).sum()))), i) for i, v in sound.items() if i != q and len(v) == len(sound[q])]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def _found(frame):
    out: dict = {}
    for r in neighbours.nearest_neighbours(frame).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in out.items()}


def test_recall_over_several_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 9)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + 0.4 * draw.normal(size=24)).tolist()) for i in range(2000)]
    truth, found = _brute(rows), _found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert set(found) == set(truth) and all(len(v) == 5 for v in found.values())
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) for q in truth)
    assert hits / (5 * len(truth)) >= 0.9
    for q, rows in found.items():
        assert [i for i, _ in rows] == [i for i, _ in sorted(rows, key=lambda x: (-x[1], x[0]))]


def test_copies_ties_and_faulty_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400)] + [(i, [1.0, 2.0, -float(i)]) for i in range(400, 420)]
    rows += [(450, None), (500, [0.0, 0.0, 0.0]), (550, [1.0, None, 2.0]), (600, [float("nan"), 1.0, 1.0]), (650, [float("inf"), 1.0, 1.0]), (700, []), (None, [1.0, 1.0, 1.0])]
    rows += [(1000, [1.0, 0.0]), (1001, [1.0, 0.5]), (50, [1.0, 2.0, 3.0])]  # another length; a repeated row
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, truth = _found(frame), _brute(rows)
    assert set(found) == set(truth)
    for q in truth:
        assert [i for i, _ in found[q]] == [i for i, _ in truth[q]], q
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in truth[q]], abs=1e-12)
    assert found[1000] == [(1001, pytest.approx(1 / np.sqrt(1.25)))]


def test_empty_and_lonely(spark):
    assert _found(spark.createDataFrame([], "vec_id long, embedding array<float>, cell int, point string")) == {}
    assert _found(spark.createDataFrame([(0, [1.0, 1.0])], "vec_id long, embedding array<float>")) == {}


def test_quantile():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
