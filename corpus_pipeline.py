"""The corpus pipeline: five operators of the training-data subpackage, one after the other over the documents table.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs.
The first four return the columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bwt_dedup, mixing, near_dedup, packing, quality
from ledgerloom.llm.common import cut, partitions, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns and key, one value per row: doc_id where that is unique and never null, else a row number."""
    own = docs.select(*COLUMNS)
    most, nulls = own.groupBy("doc_id").count().agg(F.max("count"), F.max(F.col("doc_id").isNull())).first()
    if (most or 0) > 1 or nulls:
        return cut(own).withColumn("key", F.monotonically_increasing_id())
    return own.withColumn("key", F.col("doc_id").cast("long"))


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; rejected ones go.

    Rows are judged by their text alone, so null and repeated ids and repeated rows don't matter; a null or empty text has nothing
    against it and stays; without labels nothing is rejected.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).filter("accepted").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies (five-word shingles, similarity 0.8 or more).

    Every row is a document of its own, whatever its id; a null id sorts last, and of equal ids the first row stays. Texts without
    a word are near nothing and stay; an empty table gives none.
    """
    rows = _keyed(docs)
    found = near_dedup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"), width=5).select(F.col("doc_id").alias("key"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    groups = found.join(rows.select("key", "doc_id"), "key")
    best = groups.groupBy("component_id").agg(F.min_by("key", order).alias("best"), F.count("*").alias("n")).filter("n > 1")
    copies = groups.join(best, "component_id").filter("key <> best").select(F.col("key").alias("copy"))
    return rows.join(copies, F.col("key") == F.col("copy"), "left_anti").select(*COLUMNS)


def remove_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a document with a smaller id has; n_chars follows the new text.

    Where a cut leaves part of a character, that part goes too. A document of which nothing is left goes; a null or empty text stays.
    A null id sorts last, and rows of one id spare each other; an empty table gives none.
    """
    rows = docs.select(*COLUMNS).withColumn("was_null", F.col("text").isNull())
    out = bwt_dedup.remove_repeats(rows, with_text=True, carry=("lang", "source", "n_chars", "was_null"))
    changed = F.col("n_removed") > 0
    out = out.filter(~changed | (F.length("kept") > 0)).withColumn("text", F.when(~F.col("was_null"), F.col("kept")))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its slots.

    A document stands once for every time that its words come up in the blocks of its source, at the slot in which it begins. The
    one at which a source ends is cut there (its first words, joined by one space). Every row has its own place, whatever its
    doc_id; a null source is one source, documents without words go, an empty table gives none.
    """
    rows = _keyed(docs)
    documents, slots = mixing.mix(rows.withColumn("doc_id", F.col("key")))
    found = mixing.occurrences(documents, slots).withColumnRenamed("doc_id", "of")
    out = rows.withColumn("size", mixing.word_count()).filter("size > 0").join(found, F.col("key") == F.col("of"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    begins = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("part") < F.col("size"), begins).otherwise(F.col("text"))).withColumn("n_chars", F.length("text").cast("long"))
    stretch = max(1, slots.count() // partitions(spark))
    return out.withColumn("stretch", F.floor(F.col("slot") / stretch)).repartition("stretch").sortWithinPartitions("slot", "key").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens, with their token ids.

    row_key names a row of docs, as doc_id may repeat or be null; (row_key, piece) is unique. Null and empty texts are the end
    token alone, repeated rows are packed once each, an empty table gives no rows.
    """
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_key"))  # the pieces are written at once, with these keys
    return packing.pack(numbered, key="row_key", with_ids=True)


STAGES = [
    ("quality", select_quality),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", remove_repeated_bytes),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a fitted classifier and a tokenizer cannot be written in SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
