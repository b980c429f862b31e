"""A cleaning pipeline over ``documents``: what stays is encoded for training.

Every stage is written as Parquet and read again by the next one; a table that
the next one has read is removed. Empty tables pass every stage.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.bpe import Bpe, encode
from tickbars.llm.decontaminate import without_contaminated
from tickbars.llm.language import identify, train
from tickbars.llm.line_dedup import dedup_lines
from tickbars.llm.near_dedup import near_components
from tickbars.sources.paths import delete_path, scratch_dir

#: Line edits, shingles and tokens have no sensible form in SQL: the tests hold run() against brute force.
ORACLE_SQL = None


BASE = ("doc_id", "text", "lang", "source", "n_chars")


def guarded(stage):
    """A stage that may use any names beside the columns of documents: further columns of the input pass it renamed."""

    @wraps(stage)
    def renamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = {c: f"extra_{i}_of_input" for i, c in enumerate(c for c in docs.columns if c not in BASE)}
        made = stage(spark, docs.select(*BASE, *(F.col(f"`{c}`").alias(n) for c, n in extra.items())), sf_dir)
        return made.select(*(F.col(extra.get(c, c)).alias(c) for c in docs.columns))

    return renamed


@guarded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages. Without any label, all that have letters.

    A null or empty text, or one without a letter, goes. Every row is judged by itself.
    """
    if docs.where("lang IS NOT NULL AND text IS NOT NULL").isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return identify(docs, train(docs), tuple(docs.columns)).where("NOT rejected").select(*docs.columns)


@guarded
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones have; a document that has no word left by that goes.

    Rows equal in doc_id and text lose the same lines; a null text has none.
    """
    rest = tuple(c for c in docs.columns if c != "text")
    made = dedup_lines(docs, carry=rest).withColumn("text", F.col("kept").cast("string"))
    made = made.where("n_removed = 0 OR text RLIKE '[^ \\t-\\r]'")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return made.withColumn("n_chars", n_chars).select(*docs.columns)


@guarded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Rows are decided one by one: of rows that share a doc_id only those go
    that are copies or near copies. Rows without an id stay, and so does one
    row of each text without a word.
    """
    found = near_components(docs, details=True).where("kept AND is_head")
    same = F.coalesce("key", F.col("text_hash").cast("string").cast("binary"))
    stay = found.groupBy("doc_id", same.alias("key")).agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    named = hashed.join(stay, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


@guarded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; a null text contains none."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text; a null text has none."""
    bpe = Bpe.from_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = encode(docs, bpe, decoded="decoded")
    intact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", intact.alias("intact"))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        made, path = stage(spark, docs, sf_dir), scratch_dir(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
