"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import lm_score
from tickbars.llm.bpe import Bpe, encode
from tickbars.llm.decontaminate import contaminated
from tickbars.llm.fingerprint import fingerprints
from tickbars.llm.html_text import extract
from tickbars.llm.language import identify, train
from tickbars.llm.lexical_search import search
from tickbars.llm.line_dedup import dedup_lines
from tickbars.llm.near_dedup import NearDedup, near_components
from tickbars.llm.oracle import ORACLE
from tickbars.llm.prefix_trie import prefix_trie
from tickbars.llm.repeats import remove_repeats
from tickbars.llm.token_counts import prefix_counts
from tickbars.llm.warc import read_archives, write_archives
from tickbars.sources.paths import scratch_dir

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_components(_documents(spark, sf), NearDedup(shingle=4))


@query
def op2_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf}/pages.parquet"))


@query
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf}/pages.parquet"), folder)
    records, gaps = read_archives(spark, folder)
    if not gaps.isEmpty():
        raise RuntimeError(f"unreadable bytes in the archives just written: {gaps.first()}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def _held_out(divisor: int) -> Column:
    """Whether crc32 of the id as text leaves 1; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor)) == 1, F.lit(False))


@query
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = train(docs.where(~_held_out(3)))
    found = identify(docs, model)
    return found.select("doc_id", _held_out(3).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query
def op6_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = lm_score.train(docs.where(~_held_out(5)))
    return lm_score.score(docs, model).withColumn("held_out", _held_out(5))


@query
def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    bpe = Bpe.from_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = encode(_documents(spark, sf).select("doc_id", "text"), bpe, decoded="decoded")
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    made = dedup_lines(_documents(spark, sf))
    return made.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(_documents(spark, sf))


@query
def op10_repeats(spark: SparkSession, sf: str) -> DataFrame:
    kept = remove_repeats(_documents(spark, sf))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return search(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query
def op12_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        content = file.read()
    counted = prefix_counts(_documents(spark, sf), content, public_tokenizers.PATTERN, budget=512, steps=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "n_chars", "fitting_chars")


@query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
