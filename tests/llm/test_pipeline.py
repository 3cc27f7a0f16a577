from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402


def _text(lang, draw):
    words = {"en": "the and of that with from which water house river", "de": "der und nicht auch werden schon haus wasser fluss"}[lang].split()
    return "\n".join(" ".join(draw.choice(words) for _ in range(draw.randint(8, 14))).capitalize() + "." for _ in range(draw.randint(2, 6)))


def test_stages_decide_and_the_rest_follows(spark, tmp_path):
    rows, labels = [], []
    for i in range(300):
        draw = random.Random(i)
        lang = "de" if i % 3 == 0 else "en"
        bad = i % 5 == 1
        text = "BUY!! ***\n" * draw.randint(3, 9) + "###" if bad else _text(lang, draw)
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(1000 + i, rows[2][1], "en", "s1", 5) for i in range(30)] + [(2000, None, "en", "s1", None), (2001, "12 34 --", None, None, None), (None, rows[3][1] + " and one more end", "en", "s0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = kept.collect()
        if name != "packing":
            assert kept.columns == docs.columns
    ids = {name: [r["doc_id"] for r in found] for name, found in seen.items()}
    assert not {2000, 2001} & set(ids["language_id"]) and len(ids["language_id"]) == len(rows) - 2
    assert {i for i in range(300) if i % 5 != 1} <= set(ids["quality"])
    assert len({i for i in range(300) if i % 5 == 1} & set(ids["quality"])) <= 3
    distinct = ids["near_duplicates"]
    assert len(distinct) == len(set(distinct)) and 2 in distinct and not any((i or 0) >= 1000 for i in distinct)
    assert set(ids["source_mix"]) <= set(distinct)
    assert len({(r["doc_id"], r["piece"]) for r in seen["packing"]}) <= len(seen["packing"])
    assert set(r["doc_id"] for r in seen["packing"]) == set(ids["source_mix"])


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    once, again = (sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf).collect()) for _ in range(2))
    assert once == again and once
