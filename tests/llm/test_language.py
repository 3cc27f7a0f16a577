from __future__ import annotations

import random

from wattloom.llm import language

WORDS = {"en": "the and of that with from which water house", "de": "der und nicht auch werden schon haus wasser", "fr": "les des une dans pour avec maison eau", "es": "los que para una como pero casa agua"}


def _text(lang, n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS[lang].split()) for _ in range(n))


def _longest_phrases(sample: bytes, text: bytes) -> int:
    at = count = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


def test_phrases_are_the_longest_matches():
    samples = {k: language.letters_only(_text(k, 400, k).encode()) for k in WORDS}
    model = language.fit(samples)
    texts = [language.letters_only(_text(k, n, n).encode()) for k in WORDS for n in (1, 7, 40, 120)]
    texts = [t for t in texts if len(t) <= language.BLOCK]
    phrases, sizes = language.phrase_counts(model, texts)
    for i, k in enumerate(model.languages):
        built = samples[k][: max(1, min(language.SAMPLE_BYTES, len(samples[k]) * 2 // 3))]
        for j, text in enumerate(texts):
            assert sizes[j] == len(text)
            # greedy parsing; a phrase that starts with an unseen letter is that letter
            assert abs(phrases[i, j] - _longest_phrases(built, text)) <= 1


def test_held_out_languages_are_found(spark):
    rows = [(i, _text(k, 60, i), k) for i, k in enumerate(list(WORDS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(out[i]["lang_pred"] == k for i, _, k in rows)
    assert any(r["held_out"] for r in out.values()) and all(0 <= r["score"] <= 1 for r in out.values())


def test_odd_rows(odd_docs, no_docs):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (2, 3, 4, 8))
    assert by_id[9]["lang_pred"] != "und"
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 6}) == 1
    assert language.identify(no_docs).count() == 0
    kept = language.accepted(odd_docs, least=0.0)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 5, 6, 6, 7, 9, 10]


def test_without_labels_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "more words", None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}


def test_long_labelled_texts_are_sampled(spark):
    from wattloom.llm import common, labelled

    long = "é" * common.SAMPLE_TEXT_BYTES
    rows = [(i, "x" + long, "aa") for i in range(30)] + [(100 + i, f"short {i}", "bb") for i in range(300)] + [(500 + i, "x" + long, "bb") for i in range(5000, 5040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = common.labelled_sample(docs.withColumn("text", docs.text.cast("binary")), 100)
    texts = {k: [r["text"] for r in found if r["label"] == k] for k in ("aa", "bb")}
    assert len(texts["aa"]) == 30 and len(texts["bb"]) >= 50
    assert all(common.SAMPLE_TEXT_BYTES - 2 < len(t) <= common.SAMPLE_TEXT_BYTES and t.decode() for t in texts["aa"])
    labels = spark.createDataFrame([(i, 0) for i in range(30)] + [(100 + i, 1) for i in range(300)] + [(10_000 + i, 1) for i in range(30_000)], "doc_id long, quality int")
    drawn = labelled.labelled_texts(docs, labels, "quality", 50, held_out=-1)
    assert sum(k == 0 for k, _ in drawn) == 30 and 25 <= sum(k == 1 for k, _ in drawn) <= 100
