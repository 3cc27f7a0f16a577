from __future__ import annotations

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

from wattloom.llm import manifest


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def _steps(levels, at):
    for level in levels[:-1]:
        first = at - at % 3
        yield level[first:at], level[at + 1 : first + 3]
        at //= 3


def _plain(rows):
    by_source = defaultdict(list)
    for r in rows:
        values = (r["doc_id"], r["source"], r["lang"], r["n_chars"])
        leaf = _leaf(*values, r["text"])
        cut = r["text"] is not None and crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 2 == 0
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, _leaf(*values, r["text"].replace("\n", "")) if cut else leaf))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_levels([leaf for *_, leaf, _ in sorted(by_source[s])]) for s in sources]
    top = _levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, (named, doc_id, leaf, folded) in enumerate(sorted(by_source[s])):
            proof = ""
            for left, right in [*_steps(trees[k], i), *_steps(top, k)]:
                proof += "".join(left + right)
                folded = _h(*left, folded, *right)
            out.append((doc_id if named else None, leaf, trees[k][-1][0], top[-1][0], _h(proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def _same(docs):
    assert sorted([tuple(r) for r in manifest.manifest(docs).collect()], key=str) == _plain(docs.collect())


def test_against_a_plain_tree(odd_docs, no_docs):
    _same(odd_docs)
    assert manifest.manifest(no_docs).count() == 0
    assert manifest.manifest(odd_docs).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_several_tiers_of_blocks(spark):
    rows = [(i * 7 % 5000, f"line {i}\nand {i % 3}", "en", None if i % 11 == 0 else f"s{0 if i % 3 else i % 40}", i) for i in range(2600)]
    rows += [(9, "one\nrow\nover", "de", "s0", 3)] * 300 + [(1, "lone", None, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _same(docs)
    out = manifest.manifest(docs)
    assert out.where("not verified").count() > 0 and out.where("verified").count() > 0


def test_more_sources_than_a_block(spark):
    docs = spark.range(900).selectExpr("id as doc_id", "'a\nb' as text", "'en' as lang", "concat('s', id % 800) as source", "id as n_chars")
    _same(docs)
