"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.llm.common import in_training, staged, table, with_row_keys
from quayline.llm.language import keep_identified, train_language
from quayline.llm.minmax import near_duplicates
from quayline.llm.mixing import mix_sources
from quayline.llm.pieces import encode_rows, read_model
from quayline.llm.secretscan import redact_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go, as do null texts and texts without letters;
    the others stay as they are."""
    return keep_identified(docs, train_language(docs, in_training()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, four fifths in common) one row stays, the
    one with the least id; null ids come last.  Rows are told apart by keys of their own, so that
    repeated and null ids are rows like others."""
    rows = with_row_keys(docs)
    keyed = rows.select(F.col("_row").alias("doc_id"), "text")
    found = near_duplicates(keyed, words=5, percent=80, key="doc_id")
    copies = staged(found.filter("not kept").select("component_id", "doc_id"), "copies")
    # The least key of a group is a row of it, too.
    least = copies.select("component_id", F.col("component_id").alias("doc_id")).distinct()
    grouped = copies.unionByName(least).select("component_id", F.col("doc_id").alias("_own"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    stays = (
        grouped.join(rows.select("_row", "doc_id"), F.col("_own") == F.col("_row"))
        .groupBy("component_id")
        .agg(first.alias("first"))
        .select(F.col("first._row").alias("_own"))
    )
    dropped = grouped.join(stays, "_own", "left_anti").select(F.col("_own").alias("_row"))
    dropped = staged(dropped, "dropped")
    return rows.join(dropped, "_row", "left_anti").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: rows that it leaves out go, others stand
    once or twice.  Rows are taken each by itself, whatever ids they share."""
    rows = with_row_keys(docs)
    taken = mix_sources(rows, key="_row").filter("copies > 0")
    taken = taken.select("_row", F.col("copies").alias("_copies"))
    return (
        rows.join(taken, "_row")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*docs.columns)
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text in place of the text, and whether decoding them gives it back."""
    return encode_rows(docs, read_model(public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mixing", mix),
    ("pieces", encode),
]

# A trained model and a token table are beyond SQL; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
