"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage reads the documents that the one before kept, and its result is
written as Parquet to the shared folder before the next one starts. Stages 1 to 4
return the columns of ``documents``, whatever further columns there are and however
they are called; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twingraph.llm import packing, quality, simhash, substring_dedup, toxicity
from twingraph.llm.common import materialise, share_package, table
from twingraph.llm.queries import WORD_BPE, quality_held_out, toxic_held_out


def _plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses itself, ``doc_id`` and ``text`` apart, and what each column is called."""
    names = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _own_names(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(new).alias(old) for old, new in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model does not predict as toxic; null texts stay."""
    share_package(spark)
    rows, names = _plain_names(docs)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"), toxic_held_out)
    return _own_names(model.score(rows, rows.columns).where("predicted = 0"), names)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    share_package(spark)
    rows, names = _plain_names(docs)
    model = quality.fit(rows, table(spark, sf_dir, "labels"), quality_held_out)
    return _own_names(model.score(rows, rows.columns).where("predicted = 1"), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row: the one with the smallest id, null ids last.

    A row is known by its id and a hash of all its columns, so rows that share an id, or have
    none, but not a text are documents of their own; rows that are equal throughout are one.
    """
    share_package(spark)
    rows, names = _plain_names(docs)
    content = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
    rows = rows.withColumn("_row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", content.alias("content")))
    groups = simhash.near_duplicates(rows, "_row", shingle=3, radius=3)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.content").alias("_kept")).distinct()
    rows = rows.withColumn("_content", F.col("_row.content")).drop("_row").join(kept, F.col("_content") == kept["_kept"], "left_semi")
    return _own_names(rows.dropDuplicates(["_content"]), names)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated 35-word windows; documents without any keep their text as it is."""
    share_package(spark)
    rows, names = _plain_names(docs)
    out = substring_dedup.remove_repeats(rows, window=35, keep=rows.columns)
    out = out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in names:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn(names["n_chars"], F.when(F.col("n_removed") > 0, size).otherwise(F.col(names["n_chars"])))
    return _own_names(out, names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents, in sequences of at most 2048 tokens."""
    share_package(spark)
    cut = packing.pieces(docs.select("doc_id", "text"), WORD_BPE, length=packing.LENGTH)
    packed = packing.pack_documents(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), packing.LENGTH)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack_sequences),
]

#: The learned stages and the packing have no SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
