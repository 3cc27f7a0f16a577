"""Merkle manifest of a dataset: a root per source, a root of roots, and a proof per document.

Nested-struct rollup. A leaf's rank in its source, written in digits to the base 3, is its way down the
tree. Leaves are dealt by blocks of 3 ** 6 consecutive ranks; inside a block the digit columns are
grouped away one after another, each grouping nesting its children as structs, until a block is one row
that holds its whole tree. The tops of blocks are the leaves of the next tier, blocked alike, until a
source is one block; the sources' tops form a last tree. On the way back a block row takes over the path
of its top (one row to one row) and a transform and an explode emit the paths of all its leaves, so
proofs need no join. No task holds more than a block, whatever the size of a source.

Ranks come from a range partitioning: rows are numbered inside their part and counted by part.

Defined cases: a null column hashes as ``-``; documents without a doc_id stand first in their source, and
count as tampered with (the crc32 of no text is even); repeated rows are leaves of their own, next to each
other, and rows of one doc_id go by their leaf; a null source is a source, the first; an empty table gives
no rows; a lone leaf is its subroot, a lone subroot the root, and an empty proof hashes the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import fold, table
from wattloom.session import written

#: Children of a node, and digits that are grouped away in a block.
FAN, DIGITS = 3, 6
BLOCK = FAN**DIGITS
_STEP = "struct<l: string, r: string>"


def _field(value: str) -> str:
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def _leaf(text: str) -> str:
    plain = [f"cast(`{c}` as string)" for c in ("doc_id", "source", "lang", "n_chars")]
    return f"sha2(concat({', '.join(_field(v) for v in [*plain, text])}), 256)"


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, and the leaf after tampering; ``salt`` parts rows that are equal throughout."""
    text = "cast(`text` as string)"
    tampered = F.when(fold(2) == 0, F.expr(_leaf(f"replace({text}, '\\n', '')"))).otherwise(F.expr(_leaf(text)))
    return docs.select(
        F.col("`source`").cast("string").alias("source"), F.col("`doc_id`").alias("doc_id"),
        F.expr(_leaf(text)).alias("leaf"), tampered.alias("tampered"), F.monotonically_increasing_id().alias("salt"),
    )


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` (already written) with ``rank`` from 0 in ``order`` inside each ``key``, and ``n``, the rows of the key."""
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    parted = rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id())
    nth = F.row_number().over(Window.partitionBy("part", key).orderBy(*by)) - 1
    numbered = written(parted.withColumn("nth", nth), "numbered")
    whole = Window.partitionBy("of")
    sizes = numbered.groupBy(F.col(key).alias("of"), F.col("part").alias("of_part")).agg(F.count("*").alias("own"))  # a row a part, and one a key
    before = F.sum("own").over(whole.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("of", "of_part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("own").over(whole).alias("n"))
    placed = numbered.join(sizes, F.col(key).eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
    return placed.select(*rows.columns, (F.col("before") + F.col("nth")).alias("rank"), "n")


def _tier(nodes: DataFrame) -> DataFrame:
    """key, n (nodes of the key), block, hash of the block's top and its tree, from ``nodes``: key, n, rank, hash, body."""
    digits = [f"d{j}" for j in range(DIGITS)]
    rows = nodes.selectExpr("key", "n", f"rank div {BLOCK}L as block", *[f"cast(rank div {FAN**j}L % {FAN} as int) as d{j}" for j in range(DIGITS)], "hash", "body")
    rows = rows.repartition("key", "block")
    for j in range(DIGITS):
        child = F.struct(F.col(f"d{j}").alias("digit"), "hash", "body")
        rows = rows.groupBy("key", "n", "block", *digits[j + 1 :]).agg(F.sort_array(F.collect_list(child)).alias("body"))
        joined = "sha2(array_join(transform(body, c -> c.hash), ''), 256)"
        rows = rows.withColumn("hash", F.expr(f"if(n > {FAN**j}L, {joined}, body[0].hash)"))  # one node alone is the top already
    return written(rows, "tier")


def rollup(nodes: DataFrame) -> list[DataFrame]:
    """The tiers from the leaves up; in the last one each key is one block."""
    tiers = [_tier(nodes)]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        tops = tiers[-1].selectExpr("key", f"(n + {BLOCK - 1}L) div {BLOCK}L as n", "block as rank", "hash", "block as body")
        tiers.append(_tier(tops))
    return tiers


def _leaf_paths() -> Column:
    """Of a block row with the path above it: an array of its leaves' bodies and paths, nearest siblings first."""
    found = "array(named_struct('body', body, 'path', path))"
    for j in reversed(range(DIGITS)):
        left = "array_join(transform(slice(p.body, 1, i), k -> k.hash), '')"
        right = f"array_join(transform(slice(p.body, i + 2, {FAN}), k -> k.hash), '')"
        step = f"if(n > {FAN**j}L, array(named_struct('l', {left}, 'r', {right})), cast(array() as array<{_STEP}>))"
        found = f"flatten(transform({found}, p -> transform(p.body, (c, i) -> named_struct('body', c.body, 'path', concat({step}, p.path)))))"
    return F.expr(f"inline({found})")


def paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """key, body and path of every leaf. ``above`` has a row a key: key, path, and columns handed down."""
    handed = [c for c in above.columns if c not in ("key", "path")]
    rows = above.withColumn("body", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        top = rows.select(F.col("key").alias("of"), F.col("body").alias("of_block"), "path", *handed)
        meet = tier.join(top, F.col("key").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")))  # a row to a row
        rows = meet.select("key", *handed, _leaf_paths())
    return rows


def manifest(docs: DataFrame) -> DataFrame:
    """A row a document: its leaf, its source's subroot, the root, its proof, and what the tampered leaf folds to."""
    own = ranked(written(leaves(docs), "leaves"), "source", ["doc_id", "leaf", "salt"])
    body = F.struct("doc_id", "leaf", "tampered").alias("body")
    tiers = rollup(own.select(F.col("source").alias("key"), "n", "rank", F.col("leaf").alias("hash"), body))
    subroots = written(tiers[-1].select(F.lit(0).alias("all"), F.col("key").alias("source"), F.col("hash").alias("subroot")), "subroots")
    tops = ranked(subroots, "all", ["source"])
    roots = rollup(tops.select(F.col("all").alias("key"), "n", "rank", F.col("subroot").alias("hash"), F.struct("source", "subroot").alias("body")))
    root = roots[-1].select("key", F.col("hash").alias("root"), F.expr(f"cast(array() as array<{_STEP}>) as path"))
    above = paths(roots, root).select(F.col("body.source").alias("key"), "path", F.col("body.subroot").alias("subroot"), "root")
    return paths(tiers, above).select(
        "body.doc_id", "body.leaf", "subroot", "root",
        F.expr("sha2(array_join(transform(path, s -> s.l || s.r), ''), 256) as proof_sha256"),
        F.expr("aggregate(path, body.tampered, (h, s) -> sha2(s.l || h || s.r, 256)) as folded_root"),
    ).withColumn("verified", F.expr("folded_root = root"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _sql_leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


#: Trees by recursion over levels; the walk takes a tampered leaf's hash up along the siblings.
OP12_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') AS id, {_sql_leaf("text")} AS leaf, {_sql_leaf("replace(text, chr(10), '')")} AS changed
  FROM documents
), odd AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(id) + 1), lambda i: ascii(substr(id, i, 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM hashed
), leaves AS (
  SELECT row_number() OVER () AS row, doc_id, source, leaf, CASE WHEN crc % 2 = 0 THEN changed ELSE leaf END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM odd
), tree AS (
  SELECT source, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY source, lvl, idx // 3, n
), subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1
), high AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 3, n
), near AS (
  SELECT a.source, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.source, a.lvl, a.idx
), near_high AS (
  SELECT a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.lvl, a.idx
), walk AS (
  SELECT row, doc_id, source, leaf, 0 AS lvl, idx, n, tampered AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT w.row, w.doc_id, w.source, w.leaf, w.lvl + 1, w.idx // 3, (w.n + 2) // 3, sha256(s.l || w.h || s.r), w.proof || s.l || s.r
  FROM walk w JOIN near s ON w.source IS NOT DISTINCT FROM s.source AND w.lvl = s.lvl AND w.idx = s.idx WHERE w.n > 1
), walk_high AS (
  SELECT w.row, w.doc_id, w.leaf, s.subroot, 0 AS lvl, s.idx, s.n, w.h, w.proof FROM walk w JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source WHERE w.n = 1
  UNION ALL
  SELECT w.row, w.doc_id, w.leaf, w.subroot, w.lvl + 1, w.idx // 3, (w.n + 2) // 3, sha256(s.l || w.h || s.r), w.proof || s.l || s.r
  FROM walk_high w JOIN near_high s ON w.lvl = s.lvl AND w.idx = s.idx WHERE w.n > 1
)
SELECT w.doc_id, w.leaf, w.subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
FROM walk_high w, (SELECT h FROM high WHERE n = 1) t WHERE w.n = 1
"""
