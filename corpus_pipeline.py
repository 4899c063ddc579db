"""Corpus preparation as five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import row_key, written
from stationlake.llm.decontaminate import contamination
from stationlake.llm.near_dup import drop_near_duplicates
from stationlake.llm.pack import pack
from stationlake.llm.quality_rules import keep_good
from stationlake.llm.substring_dedup import remove_repeats

TOKENIZER = "word_bpe_49k.json"
#: Keys (8 bytes each) of contaminated documents up to which they are broadcast.
BROADCAST_KEYS = 1_000_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a rule learned from the labels go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word shingle similarity 0.8 stays."""
    return drop_near_duplicates(docs, width=5, num=8, den=10)


def _whole(docs: DataFrame) -> Column:
    """A row of docs as one column, so that its columns cannot meet the names an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 35 words or more that occur elsewhere go; n_chars follows the text."""
    cut = remove_repeats(docs.select(_whole(docs), "text"), width=35)
    changed = F.col("repeat n_removed") > 0
    new = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    keyed = docs.select(row_key("doc_id", "text").alias("key"), _whole(docs))
    judged = contamination(docs.select(row_key("doc_id", "text").alias("key"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    bad = written(judged.where("contaminated").select("key").distinct(), "contaminated")
    if bad.count() <= BROADCAST_KEYS:  # else both sides are shuffled by key
        bad = F.broadcast(bad)
    return keyed.join(bad, "key", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dup", near_dup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: The stages need iteration, learned rules and a tokenizer, which SQL cannot state; tests compare each with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
