"""From raw documents to packed token sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is
written as Parquet and read again as the next one's docs. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import minhash, packing, pii
from tallyloom.llm import quality as weak_labels
from tallyloom.llm.registry import fresh
from tallyloom.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go, null, empty and blank texts among them.

    Repeated rows share their fate; an empty table stays empty. Other columns play no part, whatever their names.
    """
    return weak_labels.classify(docs, keep_all=True).filter("good").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five words, 80 %) the row with the smallest id stays.

    Rows are told apart by their place in the stored table, not by their id: a repeated row stays
    once, a second text of an id goes only if it has a smaller near-copy of its own, and rows without an id,
    which come after all others, take part. Of rows that share the smallest id the first stays. Null and
    empty texts link with nothing and stay; an empty table stays empty.
    """
    row, = fresh(docs.columns, "row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    found = materialise(minhash.near_duplicates(rows, shingle=5, percent=80, id_col=row).select(row, "component_id"), "found")
    named = found.join(rows.select(row, F.col("doc_id").alias("id")), row)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", row))[row]
    stay = named.groupBy("component_id").agg(first.alias(row)).select(row)
    gone = materialise(found.select(row).join(stay, row, "left_anti"), "gone")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets; n_chars follows the text, and is missing where that is.

    Rows stay one to one, repeated ones and those without an id as well; an empty text stays empty.
    """
    clean = pii.find(docs, redact=True)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place.

    A null or empty text is a piece of one end token. Repeated rows are packed each, an empty table gives
    no piece; rows of equal length take places in any order.
    """
    import public_tokenizers

    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

# The trained models and the tokenizer can't be said in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
