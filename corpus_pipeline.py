"""Corpus cleaning as a chain of stages, each written as Parquet and reread by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that
the one before kept; all but the last return the columns of ``documents``.
Each takes these columns by exact name (others, also such that differ in case
alone, are left behind), keeps null and repeated ids apart as stated, handles
texts of any length whole, and turns an empty table into an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.llm import ngram_join, packing, pii, toxicity
from ventana.llm.common import pick, table
from ventana.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Repeated rows of one document are added up by so many tasks at most, then by one.
SALTS = 64


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go. The model learns
    from the labelled rows outside the held-out fold. Null and empty texts
    hold no word and stay; repeated rows and rows without an id are judged by
    their text like any others."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold() != 2)
    model = toxicity.train(spark, docs, labels)
    scored = toxicity.score(spark, docs, model, keep=tuple(COLUMNS[1:]))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc_id", *[F.col(f"keep_{c}").alias(c) for c in COLUMNS[1:]])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (5-word shingles, Jaccard similarity
    0.8 or more, linked on) one row stays: the smallest doc_id (null last), of
    its texts the one of smallest hash, of its repeated rows the least. Rows
    without a class are groups by doc_id and text."""
    keys = ngram_join.join(spark, docs).groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    keys, _ = materialise(spark, keys, "near-keys")
    grouped = keys.where("root is not null")
    # a hot group is a minimum, which is added up before the shuffle
    first = grouped.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_key", "n")).alias("first"))
    first = first.select("first.doc_id", "first.text_key", "first.n").unionByName(keys.where("root is null").select("doc_id", "text_key", "n"))
    first, _ = materialise(spark, first, "near-first")
    same = lambda t: F.col("doc_id").eqNullSafe(F.col(f"{t}_id")) & (F.col("text_key") == F.col(f"{t}_key"))
    named = lambda df, t: df.select(F.col("doc_id").alias(f"{t}_id"), F.col("text_key").alias(f"{t}_key"))
    gone = keys.select("doc_id", "text_key").join(named(first.where("n = 1"), "one"), same("one"), "left_anti")
    docs = pick(docs, **{c: c for c in COLUMNS}).withColumn("text_key", F.xxhash64("text"))
    # what goes grows with the table: the same merge join at every size
    kept = docs.join(named(gone, "gone").hint("merge"), same("gone"), "left_anti").select(*COLUMNS)
    repeated = first.where("n > 1")
    if repeated.isEmpty():
        return kept
    # dealt by the task that read a row: the rows of one key are equal, so nothing in them tells them apart
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("row_salt")
    dealt = docs.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    dealt = dealt.join(named(repeated, "many").select("*", salts), same("many") & (F.col("salt") == F.col("row_salt")), "left_semi")
    least = F.min(F.struct("lang", "source", "n_chars", "text"))
    one = dealt.groupBy("doc_id", "text_key", "salt").agg(least.alias("row"))
    one = one.groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
    return kept.unionByName(one.select("doc_id", "row.*").select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; ``n_chars``
    follows where a text changed. Null texts stay null; rows without an id and
    repeated rows are masked like any others; no row goes."""
    found = pii.recognise(spark, docs, pii.train(spark, docs), keep=("lang", "source", "n_chars"), mask=True)
    changed = F.size("base") + F.size("added") > 0
    return found.select("doc_id", F.col("masked").alias("text"), F.col("keep_lang").alias("lang"), F.col("keep_source").alias("source"),
                        F.when(changed, F.length("masked").cast("long")).otherwise(F.col("keep_n_chars")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 2048. Null and empty texts
    are their end id alone; every row is packed, repeated ones too."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"), window=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", one_of_each_group),
    ("personal data", mask_personal_data),
    ("packing", pack),
]
#: The stages run learned models and a similarity join: no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to
    the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
