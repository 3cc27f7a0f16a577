from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattloom.llm import interpolated
from wattloom.llm.common import fold


def _tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), " end"]


def _docs(n=160):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    return [(i, " ".join(words[min(int(draw.expovariate(0.15)), 39)].upper() if draw.random() < 0.1 else words[min(int(draw.expovariate(0.15)), 39)] for _ in range(draw.randint(0, 60)))) for i in range(n)]


def _brute(docs, order, trained, deleted):
    """Counts, expectation-maximisation and scores token by token."""

    def counts(rows):
        found = [Counter() for _ in range(order + 1)]
        for _, text in rows:
            tokens = [" open"] * (order - 1) + _tokens(text)
            for i in range(order - 1, len(tokens)):
                for n in range(1, order + 1):
                    found[n][tuple(tokens[i - n + 1 : i + 1])] += 1
        contexts = [Counter() for _ in range(order + 1)]
        for n in range(2, order + 1):
            for gram, c in found[n].items():
                contexts[n][gram[:-1]] += c
        return found, contexts, sum(found[1].values())

    def estimates(text, model):
        found, contexts, total = model
        tokens = [" open"] * (order - 1) + _tokens(text)
        for i in range(order - 1, len(tokens)):
            out = []
            for n in range(order, 1, -1):
                gram = tuple(tokens[i - n + 1 : i + 1])
                out.append(found[n][gram] / max(contexts[n][gram[:-1]], 1))
            out.append(found[1][tokens[i],] / max(total, 1))
            seen = contexts[order][tuple(tokens[i - order + 1 : i])] if order > 1 else total
            yield found[1][tokens[i],], [*out, 1 / (len(found[1]) + 1)], min(int(math.log2(seen + 1)), interpolated.BUCKETS - 1)

    kept = counts([d for d in docs if trained(d[0]) and not deleted(d[0])])
    cases = [x for d in docs if trained(d[0]) and deleted(d[0]) for x in estimates(d[1], kept)]
    weights = [[1 / (order + 1)] * (order + 1) for _ in range(interpolated.BUCKETS)]
    before = None
    for _ in range(interpolated.ROUNDS):
        sums, total = {}, 0.0
        for _, e, b in cases:
            parts = [w * x for w, x in zip(weights[b], e, strict=True)]
            total += math.log(sum(parts))
            sums[b] = [s + p / sum(parts) for s, p in zip(sums.get(b, [0] * (order + 1)), parts, strict=True)]
        for b, s in sums.items():
            share = [max(x / sum(s), interpolated.LEAST_WEIGHT) for x in s]
            weights[b] = [x / sum(share) for x in share]
        if before is not None and total - before < interpolated.SETTLED * abs(before):
            break
        before = total
    held = {b for _, _, b in cases}
    for b in range(interpolated.BUCKETS):
        if held and b not in held:
            weights[b] = weights[min(held, key=lambda s: (abs(s - b), s))]
    model = counts([d for d in docs if trained(d[0])])
    n, v = model[2], len(model[0][1])
    out = {}
    for i, text in docs:
        rows = list(estimates(text, model))
        out[i] = (len(rows), sum(c > 0 for c, _, _ in rows), n, sum(math.log10((c + 1) / (n + v + 1)) for c, _, _ in rows), sum(math.log10(sum(w * x for w, x in zip(weights[b], e, strict=True))) for _, e, b in rows))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_plain_computation(spark, monkeypatch, order):
    monkeypatch.setattr(interpolated, "RANGE_TOKENS", 1 << 9)  # several hash ranges
    rows = _docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("learned", fold(7) != 2)
    share = interpolated.DELETED_SHARE
    deleted = {r[0] for r in docs.where(F.expr(f"pmod(xxhash64(doc_id, 'deleted'), {share}) = 0")).select("doc_id").collect()}
    truth = _brute(rows, order, lambda i: zlib.crc32(str(i).encode()) % 7 != 2, deleted.__contains__)
    for r in interpolated.scores(docs, "learned", order).collect():
        n_tokens, n_known, train, base, score = truth[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("learned", fold(7) != 2)
    rows = interpolated.scores(docs, "learned").collect()
    assert len(rows) == odd_docs.count()
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert len({(r["score"], r["n_known"]) for r in rows if r["doc_id"] == 6}) == 1
    assert interpolated.scores(no_docs.withColumn("learned", F.lit(True)), "learned").count() == 0
    nothing = interpolated.scores(odd_docs.withColumn("learned", F.lit(False)), "learned").collect()
    assert {r["score"] for r in nothing} == {0.0} and {r["train_tokens"] for r in nothing} == {0}


def test_interpolation_beats_the_base_on_held_out_text(spark):
    chain = {f"w{i}": [f"w{(3 * i + k) % 50}" for k in range(3)] for i in range(50)}
    draw, rows = random.Random(4), []
    for i in range(400):
        word, words = "w0", []
        for _ in range(40):
            word = draw.choice(chain[word])
            words.append(word)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learned", fold(7) != 2)
    held = interpolated.scores(docs, "learned", extra=("learned",)).where("not learned").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.6 * held[1]


def test_weights_are_learned_from_few_documents(spark, monkeypatch):
    ids = spark.range(400).where(f"pmod(xxhash64(id, 'deleted'), {interpolated.DELETED_SHARE}) > 0").limit(12)
    docs = ids.selectExpr("id as doc_id", "'the cat sat on the mat and the dog sat on the cat' as text", "true as learned")
    learned, learn = [], interpolated.learn_weights

    def kept(*arguments):
        learned.append(learn(*arguments))
        return learned[-1]

    monkeypatch.setattr(interpolated, "learn_weights", kept)
    assert interpolated.scores(docs, "learned").count() == 12
    assert (learned[0][:, 0] > 0.5).any()
    assert interpolated.scores(docs.limit(1), "learned").count() == 1
