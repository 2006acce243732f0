"""The corpus pipeline: five stages, each one operator of tessera.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.

In every stage an empty table gives an empty one, null ids and repeated rows
are rows like any other, very long texts are used whole, and further columns
(whatever their names) are carried by all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, langid, packing, secret_scan, simhash
from tessera.llm.common import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: no text, no letter, a score
    below the operator's floor, or n-grams foreign to every learned language."""
    return langid.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id stays;
    a null text is empty; of rows that repeat id and text one stays; a null id
    stays only when no equal text has an id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays.  Texts
    without words form one group; rows without an id are in none and stay."""
    return simhash.one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, as pieces of documents."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near), ("secret scans", secrets), ("packing", packing_stage)]

# Language scores, shingle hashes, trained chains and tokenizer ids have no SQL
# form; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.lower().replace(" ", "-"))
    return docs
