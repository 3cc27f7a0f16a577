"""A bounded training sample of labelled texts, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import fold, sampled_bytes, unbroken
from wattloom.session import written


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, per_label: int, held_out: int = 0, modulus: int = 5) -> list[tuple[int, bytes]]:
    """(label, text) of about ``per_label`` documents of each label, outside the held-out fold.

    Ids are drawn among those that have a text, by a hash, at most twice ``per_label`` of each; their
    texts are then fetched, of a long one the first SAMPLE_TEXT_BYTES, of an id on several rows the
    smallest of these. So at most twice ``per_label`` texts of each label reach the driver.
    Repeated label rows of an id count once; an id with both labels is left out.
    """
    known = labels.where(f"`{column}` in (0, 1) and doc_id is not null").where(fold(modulus) != held_out)
    known = known.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("other")).where("label = other")
    known = written(known.join(docs.where("text is not null").select("doc_id"), "doc_id", "left_semi"), "labelled")
    known = known.withColumn("rank", F.expr("pmod(xxhash64(doc_id, 'sample'), 1000000007L) / 1000000007D"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    if not counts:
        return []
    wanted = " or ".join(f"(label = {label} and rank < {per_label / n!r}D)" for label, n in counts.items())
    drawn: dict[int, list] = {}
    for row in sorted(known.where(wanted).select("rank", "doc_id", "label").collect()):
        drawn.setdefault(row["label"], []).append(row)
    ids = [(row["doc_id"], row["label"]) for rows in drawn.values() for row in rows[: 2 * per_label]]
    chosen = docs.sparkSession.createDataFrame(ids, f"_id {labels.schema['doc_id'].dataType.simpleString()}, _label int")
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "_label").agg(F.min(sampled_bytes()).alias("text")).collect()
    return [(r["_label"], unbroken(bytes(r["text"]))) for r in sorted(found, key=lambda r: (r["doc_id"], bytes(r["text"])))]
