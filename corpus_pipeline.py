"""From raw documents to token ids: quality rules, near duplicates, benchmark decontamination, personal
data, byte-level BPE. Each stage takes what the one before it wrote.

Columns of documents other than doc_id, text and n_chars pass through. A null or empty text is rejected by the
first stage; later stages also take such rows: they have no duplicates, spans or tokens."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logsieve.llm.base import columns, read, written  # noqa: E402
from logsieve.llm.bpe import encode  # noqa: E402
from logsieve.llm.decontam import find_contamination, without_spans  # noqa: E402
from logsieve.llm.hyperminhash import drop_near_duplicates  # noqa: E402
from logsieve.llm.pii import find_pii, redacted  # noqa: E402
from logsieve.llm.quality_rules import quality_rules  # noqa: E402
from logsieve.llm.queries import vocabulary  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_text(docs: DataFrame, text: Column, names: list[str]) -> DataFrame:
    """The columns ``names`` of ``docs`` with a new text and its length."""
    docs = docs.withColumn("__new_text", text)
    new = {"text": F.col("__new_text"), "n_chars": F.length("__new_text").cast("long")}
    return docs.select(*(new[n].alias(n) if n in new else columns(docs, [n])[0] for n in names))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are taken out; documents that fail the rules or lose too much go."""
    return with_text(quality_rules(docs).where("kept"), F.col("clean_text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more stays, that of the smallest id."""
    return drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are taken out; a document that is nothing else goes."""
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    left = found.where("n_hit = 0 OR n_hit < n_words")
    text = F.when(F.col("n_hit") == 0, F.col("text")).otherwise(without_spans("text", "spans"))
    return with_text(left, text, docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets."""
    return with_text(find_pii(docs), redacted("text"), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding them gives the text back."""
    ranks, pattern = vocabulary()
    decoded = encode(docs, ranks, pattern, decoded=True)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", token_ids),
]

# Stages 2 to 5 are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
