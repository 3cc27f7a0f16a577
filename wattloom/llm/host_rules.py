"""Quality rules judged by host.

A document fails a rule by its own figures. Failures are counted by host (here: source), each host's
rate is shrunk towards an empirical beta prior fitted to all hosts by moments, and the host's verdict
on each rule joins back to its documents: a document goes if it fails a rule that its host is bad at,
or if the host as a whole is. Base failures go at any host.

DataFrame functions only. Defined cases: a null text has no words and fails the length rule; rows
without a source are one host; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import SPACES, table
from wattloom.session import written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: A document's own failures, over the columns of ``measured``. The first two are the base rules.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "same_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
BASE = ("short", "repeats")
#: Shrunk rates from which a host is bad at a rule, and bad as a whole.
BAD_RATE, LOST_RATE = 0.05, 0.9
#: Bounds of the prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1_000_000.0


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the figures the rules use, of every row."""
    rows = docs.select("doc_id", F.col(f"`{host}`").alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id",
        "host",
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        F.array_remove(F.split("text", SPACES + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    figures = ["doc_id", "host", "word_chars", "n_symbols"]
    # Each array below is used more than once by the next step, so Spark keeps the steps apart and
    # makes it once a row.
    rows = rows.selectExpr(
        *figures,
        "size(words) as n_words",
        "size(lines) as n_lines",
        "size(lines) - size(array_distinct(lines)) as n_dup_lines",
        f"case when size(words) >= {WINDOW} then transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) else array() end as windows",
    )
    figures += ["n_words", "n_lines", "n_dup_lines"]
    rows = rows.selectExpr(*figures, "case when size(array_distinct(windows)) < size(windows) then sort_array(transform(windows, (w, i) -> struct(w, i))) else array() end as ordered")
    rows = rows.selectExpr(*figures, "sort_array(transform(filter(ordered, (x, k) -> coalesce(x.w = get(ordered, k - 1).w, false) or coalesce(x.w = get(ordered, k + 1).w, false)), x -> x.i)) as places")
    covered = f"aggregate(zip_with(slice(places, 2, size(places)), slice(places, 1, size(places) - 1), (b, a) -> least({WINDOW}, b - a)), {WINDOW}, (x, y) -> x + y)"
    rows = rows.selectExpr(*figures, f"case when size(places) > 0 then {covered} else 0 end as n_repeat_words")
    return rows.select("doc_id", "host", *[F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])


def host_rates(figures: DataFrame) -> DataFrame:
    """Documents and failures of each host, by rule and of any rule."""
    failed = {name: F.expr(rule) for name, rule in RULES.items()}
    whole = failed["short"]
    for rule in list(failed.values())[1:]:
        whole = whole | rule
    return figures.groupBy("host").agg(F.count("*").alias("docs"), *[F.sum(rule.cast("long")).alias(name) for name, rule in {**failed, "any_rule": whole}.items()])


def beta_prior(rates: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and strength (in documents) of each rule's prior over hosts, by moments. One row reaches the driver."""
    names = [*RULES, "any_rule"]
    sums = [F.sum(n).alias(f"{n}_f") for n in names] + [F.sum(F.expr(f"{n} * ({n} / docs)")).alias(f"{n}_q") for n in names]
    row = rates.agg(F.sum("docs").alias("docs"), F.count("*").alias("hosts"), *sums).first()
    prior = {}
    for name in names:
        if not row["docs"]:
            prior[name] = (0.0, WEAKEST)
            continue
        mean = row[f"{name}_f"] / row["docs"]
        spread = row[f"{name}_q"] / row["docs"] - mean * mean
        between = spread - mean * (1 - mean) * row["hosts"] / row["docs"]  # less what sampling alone makes
        strength = mean * (1 - mean) / between - 1 if between > 0 else STRONGEST
        prior[name] = (mean, min(max(strength, WEAKEST), STRONGEST))
    return prior


def verdicts(rates: DataFrame) -> DataFrame:
    """host, and whether it is bad at each rule, and lost as a whole."""
    prior = beta_prior(rates)
    shrunk = {name: f"({name} + {mean!r}D * {strength!r}D) / (docs + {strength!r}D)" for name, (mean, strength) in prior.items()}
    bad = [F.expr(f"{shrunk[name]} > {BAD_RATE}D").alias(f"bad_{name}") for name in RULES]
    return rates.select(F.col("host").alias("of_host"), *bad, F.expr(f"{shrunk['any_rule']} > {LOST_RATE}D").alias("lost"))


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures, base_failed and kept of every row."""
    figures = written(measured(docs, host), "figures")
    hosts = verdicts(host_rates(figures))
    base = " or ".join(f"({RULES[name]})" for name in BASE)
    by_host = " or ".join(f"(bad_{name} and ({rule}))" for name, rule in RULES.items())
    joined = figures.join(hosts, figures["host"].eqNullSafe(hosts["of_host"]), "left")
    return joined.withColumn("base_failed", F.expr(base)).withColumn("kept", F.expr(f"not (base_failed or lost or {by_host})"))


def op3_host_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP3_SQL = r"""
WITH numbered AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT rid, doc_id, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM numbered
), tokens AS (
  SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split
), windows AS (
  SELECT rid, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o, lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS shown
  FROM tokens WINDOW o AS (PARTITION BY rid ORDER BY i) QUALIFY lead(w, 7) OVER o IS NOT NULL
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, shown) AS times FROM windows) WHERE times > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY rid
), figures AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)
), failures AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats, 10 * n_symbols > n_words AS symbols,
    100 * n_dup_lines > 30 * n_lines AS same_lines, word_chars < 2 * n_words OR word_chars > 15 * n_words AS word_length
  FROM figures
), tall AS (
  SELECT source, unnest(['short', 'repeats', 'symbols', 'same_lines', 'word_length', 'any_rule']) AS rule,
    unnest([short, repeats, symbols, same_lines, word_length, short OR repeats OR symbols OR same_lines OR word_length]) AS failed
  FROM failures
), hosts AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f FROM tall GROUP BY ALL
), moments AS (
  SELECT rule, sum(f) / sum(n) AS m, sum(f * (f / n)) / sum(n) - (sum(f) / sum(n)) ^ 2 AS spread, count(*) / sum(n) AS per FROM hosts GROUP BY rule
), prior AS (
  SELECT rule, m, least(greatest(CASE WHEN spread - m * (1 - m) * per > 0 THEN m * (1 - m) / (spread - m * (1 - m) * per) - 1 ELSE 1e6 END, 1), 1e6) AS s FROM moments
), bad AS (
  SELECT source, rule, (f + m * s) / (n + s) > CASE rule WHEN 'any_rule' THEN 0.9 ELSE 0.05 END AS is_bad FROM hosts JOIN prior USING (rule)
), verdict AS (
  SELECT source, bool_or(is_bad AND rule = 'short') AS b1, bool_or(is_bad AND rule = 'repeats') AS b2, bool_or(is_bad AND rule = 'symbols') AS b3,
    bool_or(is_bad AND rule = 'same_lines') AS b4, bool_or(is_bad AND rule = 'word_length') AS b5, bool_or(is_bad AND rule = 'any_rule') AS b6
  FROM bad GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats OR b6 OR (b1 AND short) OR (b2 AND repeats) OR (b3 AND symbols) OR (b4 AND same_lines) OR (b5 AND word_length)) AS kept
FROM failures JOIN verdict ON failures.source IS NOT DISTINCT FROM verdict.source
"""
