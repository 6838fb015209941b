"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from candlewick.llm.common import broadcast_if_small, stage, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language; those whose text is empty or in none go."""
    found = language_id.identify(language_id.document_evidence(docs), language_id.fit(docs))
    return found.where("kept").select("doc.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document of which nothing is left goes."""
    out = line_dedup.dedup_lines(docs).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def _row_key(docs: DataFrame):
    return F.xxhash64(F.col("doc_id").cast("long"), F.length("text"), F.col("text"))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``node``: the doc_id, or a number of its own (2^62 or more, by a hash of id and text) for a row without
    an id and for each further text under an id that has several."""
    key = _row_key(docs).alias("key")
    several = docs.where("doc_id is not null").select("doc_id", key).groupBy("doc_id").agg(
        F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last").select("doc_id", "first")
    several = broadcast_if_small(stage(several, "several"))
    own = F.col("key").bitwiseAND((1 << 62) - 1).bitwiseOR(F.lit(1 << 62))
    node = F.when(F.col("key") != F.col("first"), own).otherwise(F.col("doc_id").cast("long"))
    ided = docs.where("doc_id is not null").withColumn("key", key).join(several, "doc_id", "left").withColumn("node", node)
    rest = docs.where("doc_id is null").withColumn("key", key).withColumn("node", own)
    return ided.select(*docs.columns, "node").union(rest.select(*docs.columns, "node"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; null and empty texts are groups of their own.

    Documents are told apart by id and text: different texts under one id, and texts without an id, are documents each,
    and come after all ids. Rows equal in id and text are one document, of which the row stays whose other columns have
    the smallest hash.
    """
    named = _named(docs)
    kept = near_dedup.near_duplicates(named, id_col="node").where("kept").select(F.col("doc_id").alias("node")).distinct()
    others = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind]
    row = F.struct(*[F.col(c) for c in docs.columns])
    once = named.join(kept, "node", "left_semi").groupBy("node").agg(F.min_by(row, F.xxhash64(*others, F.lit(0))).alias("row"))
    return once.select("row.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select("row_key")
    return docs.withColumn("row_key", _row_key(docs)).join(found, "row_key", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents copied to equal source weights, in shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
]

#: SQL cannot express the first three stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
