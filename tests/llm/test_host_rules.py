from __future__ import annotations

import random
import re

import duckdb
import pytest

from wattloom.llm import host_rules


def _figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows: dict = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_figures(spark, odd_docs):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("a b c d é # | <x> ***".split()) for _ in range(draw.randint(0, 60))) for _ in range(60)]
    texts += ["\n".join(draw.choice(["same line of text", "another", " ", "", "x"]) for _ in range(12)) for _ in range(20)]
    rows = {r["doc_id"]: r for r in host_rules.measured(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == _figures(text)
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"]}
    for r in host_rules.measured(odd_docs).collect():
        if r["doc_id"]:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == _figures(texts[r["doc_id"]])


def test_verdicts_follow_the_host(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    marked = " ".join(f"word{i}***" for i in range(40))
    rows = [(i, clean, f"good{i % 5}") for i in range(200)] + [(300 + i, marked if i % 2 else clean, "bad") for i in range(40)]
    rows += [(400, marked, "good1"), (401, "too short", "good1")]
    out = {r["doc_id"]: r for r in host_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[i]["kept"] for i in range(200))
    assert [out[300 + i]["kept"] for i in range(40)] == [i % 2 == 0 for i in range(40)]
    assert out[400]["kept"], "one failure does not make a host bad"
    assert out[401]["base_failed"] and not out[401]["kept"]


def test_rates_shrink_towards_the_prior(spark):
    rates = spark.createDataFrame([(f"h{i}", 100, *[i] * 6) for i in range(0, 21, 2)] + [("one", 1, *[1] * 6)], "host string, docs long, " + ", ".join(f"{n} long" for n in [*host_rules.RULES, "any_rule"]))
    mean, strength = host_rules.beta_prior(rates)["short"]
    assert 0.05 < mean < 0.15 and strength > 1
    bad = {r["of_host"]: r["bad_symbols"] for r in host_rules.verdicts(rates).collect()}
    assert not bad["h0"] and bad["h20"]


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_sql_agrees(which, odd_docs, no_docs):
    docs = odd_docs if which == "odd" else no_docs
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    mine = host_rules.judged(docs).select(*names).collect()
    documents = docs.drop("extra").toArrow()  # noqa: F841  read by the query
    theirs = duckdb.sql(f"SELECT {', '.join(names)} FROM ({host_rules.OP3_SQL})").fetchall() if which == "odd" else []
    assert sorted(map(str, map(tuple, mine))) == sorted(map(str, theirs))
