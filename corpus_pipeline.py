"""A corpus pipeline: quality rules, near duplicates, repeated passages, a mix of sources, packed sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, and works on all that
the one before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunweave.llm import jaccard, mix, packing, quality, substring
from sunweave.sources.shared import one_of_repeated, row_key, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy for prose doesn't reject.

    A null or empty text has too few words and goes; ids don't matter, so that null and equal ones stay; of repeated rows
    each stays or goes; texts of any length are measured whole; an empty table stays empty.
    """
    book = quality.ledger(docs, attach=True)
    return book.where(~quality.rejected(quality.PROSE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by five-word shingles (similarity 0.8 or more) the one with the smallest id.

    Rows are told apart by all their columns: a null id comes after all others, so that a row without an id stays where no
    row with one is like it; of repeated rows one stays, of other rows of one id those that are the first of their groups.
    Texts without words are like nothing and stay; an empty table stays empty. Columns travel in a struct, so that their
    names can't clash.
    """
    rows = docs.select(row_key(docs).alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    groups = jaccard.similar_groups(rows.select("row", F.col("doc.text").alias("text")), n=5, percent=80, key="row")
    groups = written(groups.select("row", "component_id"), "groups")
    ids = rows.select("row", F.col("doc.doc_id").alias("doc_id")).distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = groups.distinct().join(ids, "row").groupBy("component_id").agg(F.min(order)["row"].alias("row"))
    kept = rows.join(first.select("row"), "row", "left_semi")
    return one_of_repeated(kept, groups, "row").select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words and more that an earlier place has too.

    Null ids come last, and rows of equal ids are one document to each other; null and empty texts stay as they are; a text
    of which nothing is left goes; an empty table stays empty.
    """
    return substring.dedup_texts(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and in part, as the mix of sources takes them.

    Rows without words are taken nothing of and go; null sources are one source; null and equal ids are taken like others;
    an empty table stays empty.
    """
    return mix.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 4096 tokens, each row's own; an empty table gives none."""
    return packing.pack(docs, "word_bpe_49k.json")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed", packed),
]

#: Tokenisation and packing aren't SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
