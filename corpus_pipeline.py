"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs`` with the columns of ``documents``;
the last returns the places of all pieces in training sequences. ``run`` writes every stage's result to the
shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_broadcast, read_table, unused
from tallyloom.llm.decontaminate import without_matches
from tallyloom.llm.fuzzy_lines import ALL_LINES, row_key, without_duplicate_lines
from tallyloom.llm.minhash import NearDuplicates, near_duplicates
from tallyloom.llm.packing import Packing, pack
from tallyloom.llm.queries import vocabulary
from tallyloom.llm.toxicity import harmless, train
from tallyloom.plans.durable import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by the model fitted on the labels; those without text stay."""
    return harmless(docs, train(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that another line duplicates; one that loses all its text goes, others stay.

    ``n_chars`` follows the text where that changed.
    """
    lines, cut = unused(docs, "lines"), unused(docs, "cut")
    less = without_duplicate_lines(docs, ALL_LINES, lines, cut)
    left = less.where((F.col(cut) == 0) | (F.trim(F.regexp_replace("text", "\\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col(cut) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; without words or doc_id all stay.

    A document is a doc_id with a text: another text under a doc_id is another one, of repeated rows one stays.
    """
    key, other = unused(docs, "key"), unused(docs, "other")
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), row_key(docs)))
    rows = keyed.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.col("doc_id").cast("long")).alias("first"), F.count(F.lit(1)).alias("rows"))
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), NearDuplicates(words=5, percent=80)).where("n_shingles > 0")
    named = found.where("doc_id IS NOT NULL").select(F.col("doc_id").alias(key), F.col("component_id").alias("group")).distinct()
    named = written(named.join(rows, key), "near-groups")
    stays = named.groupBy("group").agg(F.min(F.struct("first", key)).alias("stays"))
    judged = written(named.join(stays, "group").select(F.col(key).alias(other), (F.col(f"stays.{key}") == F.col(key)).alias("kept"), "rows"), "near-judged")
    same = F.col(key) == F.col(other)
    gone = written(judged.where("NOT kept").select(other), "near-duplicates")
    left = keyed.join(bounded_broadcast(gone), same, "left_anti")
    repeated = written(judged.where("kept AND rows > 1").select(other), "repeated-rows")
    single = left.join(bounded_broadcast(repeated), same, "left_anti")
    return single.union(left.join(bounded_broadcast(repeated), same, "left_semi").dropDuplicates([key])).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also under other numbers and names."""
    return without_matches(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    return pack(docs, Packing(vocabulary(), end_id=2, capacity=4096))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# A trained classifier and merges of a tokenizer cannot be written in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
