"""Corpus pipeline: toxicity -> language -> near-duplicates -> source mix -> packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result below the shared checkpoint folder and reads it back as the next one's input.

Rows with nulls, empty and very long texts, repeated rows and empty tables are fine in every stage: a null or empty text
is not toxic, but has no language and leaves in stage 2; rows equal in id and text are one document from stage 3 on, and
rows that repeat an id with another text or source are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.language_id import UNDETERMINED, fold, language, learn_languages
from ledgerline.llm.near_dedup import near_duplicates
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.queries import END_ID, MIX_EPOCHS, MIX_SHARDS, MIX_WEIGHTS, WINDOW, tokenizer_path
from ledgerline.llm.source_mix import mixed_documents
from ledgerline.llm.toxicity import learn_toxicity, toxicity

#: A text whose n-grams are to less than this share known in any learned language is in none of them.
LEAST_HIT_RATE = 0.2
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine calls toxic go. It learns from the labels that op5 learns from."""
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(True)))
    return docs.where(toxicity(model)(F.col("text")) < 0.5)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learned languages, go."""
    model = learn_languages(docs, F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(True)))
    found = language(model)(F.col("text"))
    judged = docs.withColumn("found__", found)
    known = (F.col("found__.lang_pred") != UNDETERMINED) & (F.col("found__.hit_rate") >= LEAST_HIT_RATE)
    return judged.where(known).drop("found__")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id; null ids all stay.

    Each text of a repeated id is a document of its own. Rows equal in id and text are one document; of those that differ
    in another column, the smallest (nulls first, columns in their order) stays.
    """
    tag = F.xxhash64("text")
    groups = near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT, tag=tag)
    stays = groups.where("kept and doc_id is not null").select("doc_id", F.col("tag").alias("tag__")).distinct()
    tagged = docs.withColumn("tag__", tag)
    one = F.min(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")], "text")).alias("row__")
    # the ids have no size bound: the same shuffle join at every size
    unique = tagged.join(stays.hint("merge"), ["doc_id", "tag__"], "left_semi").groupBy("doc_id", "tag__").agg(one)
    return unique.select("doc_id", "row__.*").select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target draws it: left out, once, or up to three times."""
    return mixed_documents(docs, MIX_WEIGHTS, MIX_EPOCHS, MIX_SHARDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with their token ids."""
    return pack_documents(docs, tokenizer_path(), END_ID, WINDOW)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_to_targets),
    ("packing", pack),
]

#: Learned models, sketches and tokenizers can't be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
