"""A corpus pipeline: toxic documents go, near duplicates go, repeated passages and benchmark
passages are cut, and what remains is packed into token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, near_dedup, packing, repeats, toxicity
from strata.llm.common import column, scratch, table
from strata.llm.queries import vocabulary_file

ORACLE_SQL = None  # the classifier can't be written in SQL; tests/llm hold the stages against brute force


def with_text(docs: DataFrame, changed: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` from ``changed``, with ``text`` as the text and its length as ``n_chars``; a null text stays null."""
    new = F.when(column(changed, "text").isNotNull(), text)
    values = {"text": new, "n_chars": F.length(new).cast("long")}
    return changed.select(*[values[c].alias(c) if c in values else column(changed, c) for c in docs.columns])


def own_names(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """Names for new columns that no column of ``docs`` has."""
    return tuple(n + "_" * (1 + max(map(len, docs.columns))) for n in names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (score 0.5 or more)."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    (score,) = own_names(docs, "score")
    scored = toxicity.score(docs, model, docs.columns, score_name=score)
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (all rows, if several have it).

    A row without an id is a document of its own, after all that have one.
    """
    (row,) = own_names(docs, "row")
    doc_id = column(docs, "doc_id")
    without = scratch(docs.where(doc_id.isNull()).withColumn(row, F.lit(1 << 62) + F.monotonically_increasing_id()), "no-id")
    numbered = docs.where(doc_id.isNotNull()).withColumn(row, doc_id).unionAll(without)
    gone = near_dedup.near_duplicates(numbered, id_col=row).where(~F.col("kept")).select(row).distinct()
    return numbered.join(gone, row, "left_anti").select(*[column(docs, c) for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 50 and more that an earlier document has are cut; what is left of a character cut in two goes."""
    *_, kept = names = own_names(docs, "bytes", "removed", "spans", "kept")
    left = repeats.remove_repeats(docs, keep=docs.columns, names=names)
    whole = F.try_validate_utf8(F.col(kept).cast("string"))
    return with_text(docs, left, F.coalesce(whole, F.regexp_replace(F.make_valid_utf8(F.col(kept).cast("string")), "\ufffd", "")))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that match a benchmark window are cut out of the texts."""
    *_, cleaned = names = own_names(docs, "words", "spans", "items", "cleaned")
    clean = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"), cut=True, keep=docs.columns, names=names)
    return with_text(docs, clean, F.col(cleaned))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the remaining texts."""
    return packing.pack(docs, vocabulary_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", cut_benchmark),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
