"""Registered queries of the training-data operators, with SQL where SQL can
express them.  Each query applies its operator to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (ann, chat, exact_dedup, hard_negatives, langid, lexical, line_dedup, packing, pieces, secret_scan, simhash, suffix_dedup,
                         url_rules)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark, d):
    return pieces.digests(read(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2(spark, d):
    return packing.pack(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op3(spark, d):
    return secret_scan.digests(read(spark, d, "documents"))


def op4(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)], rows.schema)
    return chat.digests(rows.unionByName(probe))


def op5(spark, d):
    return suffix_dedup.digests(read(spark, d, "documents"))


def op6(spark, d):
    return ann.nearest(read(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op7(spark, d):
    return simhash.near_duplicates(read(spark, d, "documents"))


def op8(spark, d):
    return url_rules.judge(read(spark, d, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9(spark, d):
    return langid.languages(read(spark, d, "documents"))


def op10(spark, d):
    return exact_dedup.duplicates(read(spark, d, "documents"))


def op11(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12(spark, d):
    return lexical.rank(read(spark, d, "benchmark"), read(spark, d, "documents"))


def op13(spark, d):
    return line_dedup.digests(read(spark, d, "documents"))


QUERIES = {"op1_sentence_pieces": op1, "op2_concatenate_cut": op2, "op3_secret_scan": op3, "op4_chat_format": op4, "op5_suffix_dedup": op5, "op6_stable_projection": op6,
           "op7_simhash_cover": op7, "op8_url_rules": op8,
           "op9_language_id": op9, "op10_exact_dedup": op10,
           "op11_hard_negatives": op11, "op12_lexical_search": op12, "op13_line_dedup": op13}
ORACLE = {"op4_chat_format": chat.SQL, "op8_url_rules": url_rules.SQL, "op10_exact_dedup": exact_dedup.SQL,
          "op11_hard_negatives": hard_negatives.SQL, "op12_lexical_search": lexical.SQL, "op13_line_dedup": line_dedup.SQL}
