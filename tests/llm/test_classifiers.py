from __future__ import annotations

import itertools
import random
import zlib

import numpy as np

from wattloom.llm import quality, toxicity

GOOD = "The river runs past the old town, and people walk there in the evening."
BAD = "BUY!! NOW!! CHEAP!! *** ### WIN!! BIG!! $$$ %%% GO!!"


def _paths(odds, counts, links):
    at, good, pairs, whole = 0, [], np.zeros((2, 2)), 0.0
    for n in counts:
        total, marginal, linked = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            e = np.exp(sum(odds[at + i] for i in range(n) if y[i]) + sum(links[y[i], y[i + 1]] for i in range(n - 1)))
            total, marginal = total + e, marginal + e * np.array(y)
            for i in range(n - 1):
                linked[y[i], y[i + 1]] += e
        good, pairs, whole, at = [*good, *(marginal / total)], pairs + linked / total, whole + np.log(total), at + n
    return good, pairs, whole


def test_forward_backward_sums_over_all_labellings():
    draw = np.random.default_rng(0)
    for _ in range(20):
        counts, links = draw.integers(1, 7, 5), draw.normal(size=(2, 2))
        odds = draw.normal(size=counts.sum())
        for mine, truth in zip(quality.forward_backward(odds, counts, links), _paths(odds, counts, links), strict=True):
            assert np.allclose(mine, truth)


def test_features_of_lines():
    features, length, counts = quality.line_features([b"One two two.\nAGAIN!!\n\nAGAIN!!", b""])
    assert counts.tolist() == [4, 1] and length.tolist() == [12, 7, 0, 7, 0]
    own = features[:, : quality.OWN]
    assert own[:, 10].tolist() == [0, 0, 0, 1, 0]  # equal to an earlier line
    assert own[:, 11].tolist() == [0, 0, 1, 0, 1]  # empty
    assert (features[1, quality.OWN : 2 * quality.OWN] == own[0]).all() and (features[0, 2 * quality.OWN : 3 * quality.OWN] == own[1]).all()
    assert not features[4, quality.OWN : 3 * quality.OWN].any()


def test_pieces_score_as_the_whole():
    """A text in pieces of any number of lines: the sums over labels, the borders' features and the repeated lines are the whole's."""
    draw = random.Random(5)
    rng = np.random.default_rng(5)
    model = rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2))
    for lines in (1, 2, 3, 40, 701):
        text = "\n".join(draw.choice([GOOD, BAD, "", "x" * draw.randint(0, 30), "same line"]) for _ in range(lines)).encode()
        whole = quality.scored(model, [text])[0]
        for piece in (1, 2, 7, 100, 5000):
            assert abs(quality.long_score(model, text, piece) - whole) < 1e-9


def test_millions_of_lines_take_bounded_memory():
    import subprocess
    import sys

    code = (
        "import numpy as np, resource; from wattloom.llm import quality\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "model = np.random.default_rng(1).normal(size=quality.FEATURES), np.ones((2, 2))\n"
        "blank, short = quality.scored(model, [b'\\n' * 5_000_000, b'ab\\n' * 1_000_000])\n"
        "assert 0 <= blank <= 1 and 0 <= short <= 1\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True)
    assert int(out.stdout) < 400_000  # kB


def test_joined_texts_score_between_their_parts(spark):
    """Lines of both kinds in one text: the score follows the share of good lines."""
    docs, labels = _labelled(spark, lambda good, draw: "\n".join([GOOD if good else BAD] * draw.randint(2, 6)))
    model = quality.train(docs, labels)
    shares = [quality.scored(model, ["\n".join([GOOD] * k + [BAD] * (8 - k)).encode()])[0] for k in (0, 2, 4, 6, 8)]
    assert shares == sorted(shares) and shares[0] < 0.1 < shares[1] < shares[3] < 0.95 < shares[4]


def _labelled(spark, make, n=240):
    rows, labels = [], []
    for i in range(n):
        label = i % 2
        rows.append((i, make(label, random.Random(i)), "en", "s", 0))
        labels.append((i, label, 1 - label))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_lines_are_told_apart(spark):
    docs, labels = _labelled(spark, lambda good, draw: "\n".join([GOOD if good else BAD] * draw.randint(2, 6) + [GOOD] * (not good and draw.random() < 0.3)))
    model = quality.train(docs, labels)
    out = quality.rated(docs, model).collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in out) / len(out) > 0.97
    mixed = quality.scored(model, [f"{GOOD}\n{GOOD}".encode(), f"{GOOD}\n{BAD}".encode(), f"{BAD}\n{BAD}".encode()])
    assert mixed[0] > mixed[2]


def test_quality_of_odd_rows(odd_docs, no_docs, no_labels):
    model = quality.train(odd_docs, no_labels)
    rows = quality.rated(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and {r["score"] for r in rows} == {0.5}
    assert quality.rated(no_docs, model).count() == 0
    fitted = quality.fit([0, 1] * 10, [BAD.encode(), GOOD.encode()] * 10)
    rows = quality.rated(odd_docs, fitted).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    kept = quality.accepted(odd_docs, fitted)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_composed_transducer_scores_clauses():
    grammar = toxicity.Grammar({b"fool": 2.0}, {b"scoun": 1.0})
    weigh = lambda text: grammar.clause_weight(toxicity.lower_words(text.encode()))
    assert weigh("a fool") == 2.0 and weigh("you fool") == 3.0 and weigh("fool you") == 2.5
    assert weigh("not a fool") == 0.5 and weigh("he said you fool") == 0.5 * 3.0
    assert weigh("scoundrels") == 1.0 and weigh("nothing here") == 0.0
    assert weigh("kill") == 0.0 and weigh("kill you") == 1.5 and weigh("never kill you") < weigh("kill you")
    # a clause is weighed on its own: the target of the next one does not count
    assert grammar.matched(b"A fool. You see.")[0] == 2.0
    assert grammar.matched("No clause, ünïcode Ü".encode())[:3] == (0.0, 0, 0.0)


def test_learned_words_carry_over(spark):
    insults = [f"grob{x}" for x in "abcdefgh"] + ["zwick"]
    neutral = [f"word{i}" for i in range(300)]

    def make(clean, draw):
        words = [draw.choice(neutral) for _ in range(draw.randint(30, 90))]
        for _ in range(0 if clean else len(words) // 15):
            words[draw.randrange(len(words))] = draw.choice(insults)
        return " ".join(words)

    docs, labels = _labelled(spark, make, 400)
    out = toxicity.rated(docs, toxicity.train(docs, labels)).collect()
    held = [r for r in out if r["held_out"]]
    assert len(held) > 40 and sum(r["predicted"] == 1 - r["doc_id"] % 2 for r in held) / len(held) > 0.95


def test_toxicity_of_odd_rows(odd_docs, no_docs, no_labels):
    model = toxicity.train(odd_docs, no_labels)
    rows = toxicity.rated(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert toxicity.rated(no_docs, model).count() == 0


def test_samples_take_an_id_once(spark):
    """One id on thousands of rows gives one text, and does not push the others of its label out."""
    from wattloom.llm.common import labelled_sample
    from wattloom.llm.labelled import labelled_texts

    many = spark.range(20_000).selectExpr("1L as doc_id", "concat('text ', id) as text", "'xx' as lang")
    docs = many.unionByName(spark.range(2, 80).selectExpr("id as doc_id", "concat('row ', id) as text", "'xx' as lang"))
    labels = spark.range(1, 80).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    drawn = labelled_texts(docs, labels, "quality", 100)
    assert len(drawn) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 80))
    rows = labelled_sample(docs.selectExpr("doc_id", "cast(text as binary) as text", "lang as label"), 200)
    assert len(rows) == 79 and [bytes(r["text"]) for r in rows if r["doc_id"] == 1] == [b"text 0"]
