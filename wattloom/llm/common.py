"""What the operators share: folds, words, bounded labelled samples, slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that parts words; ``bytes.split()`` parts at exactly these.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: So many bytes of a text, from its start, are taken for a classifier's training sample. Scoring has no such bound.
SAMPLE_TEXT_BYTES = 65_536


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``. A null id counts as the empty text (remainder 0)."""
    return F.expr(f"cast(crc32(cast(coalesce(cast(`{column}` as string), '') as binary)) % {modulus} as int)")


def lowered(data: bytes) -> bytes:
    """Lower-cases A-Z and nothing else."""
    return data.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrowed(df: DataFrame, *columns: str, text: str | None = "text") -> DataFrame:
    """The named columns only, so that extra columns never reach Python; the text as its UTF-8 bytes."""
    return df.select(*[F.col(f"`{c}`") for c in columns], *([F.col(f"`{text}`").cast("binary").alias("text")] if text else []))


def whole_rows(df: DataFrame) -> DataFrame:
    """``whole`` (the row as it is), ``id`` and ``row`` (a hash of the row): own columns can't clash with the input's."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), F.col("doc_id").alias("id"), F.xxhash64(*hashed).alias("row"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that a slice holds about ``limit`` bytes of one column; a longer value is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit or i - start >= 4096:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def sampled_bytes(text: str = "text") -> Column:
    """The start of a binary text, as a training sample takes it."""
    return F.substring(text, 1, SAMPLE_TEXT_BYTES)


def unbroken(data: bytes) -> bytes:
    """A sampled text without the character that its end may have cut."""
    return data if len(data) < SAMPLE_TEXT_BYTES else data.decode("utf-8", "ignore").encode()


def labelled_sample(rows: DataFrame, per_label: int) -> list:
    """About ``per_label`` rows of each label (at most twice as many), chosen by a hash of the id.

    ``rows`` has doc_id, text (binary) and label. Rows without id, text or label are neither counted nor
    sampled; of a long text the first SAMPLE_TEXT_BYTES are. Ids are counted and drawn, not rows: an id
    on several rows gives a label one text, the smallest. The bounds make the collected size
    independent of the table.
    """
    usable = rows.where("text is not null and label is not null and doc_id is not null")
    counts = usable.select("label", "doc_id").distinct().groupBy("label").count()
    chosen = (
        usable.withColumn("rank", F.expr("pmod(xxhash64(doc_id, 'sample'), 1000000007L) / 1000000007D"))
        .join(F.broadcast(counts.withColumnRenamed("label", "of")), F.col("label") == F.col("of"))  # a row a label; more rows than that are collected
        .where(F.col("rank") < per_label / F.col("count"))
        .groupBy("rank", "doc_id", "label")
        .agg(F.min(sampled_bytes()).alias("text"))
    )
    found: dict = {}
    cut = [Row(**(r.asDict() | {"text": unbroken(bytes(r["text"]))})) for r in chosen.collect()]
    for row in sorted(cut, key=lambda r: (r["rank"], r["doc_id"], r["text"])):
        found.setdefault(row["label"], []).append(row)
    return [row for label in sorted(found) for row in found[label][: 2 * per_label]]
