"""Exact duplicates by digest, with a heavy-hitter split (DataFrame/SQL only).

A Misra-Gries summary over the digests names the few texts that may hold a
large share of all rows.  Their winners are found by an exact map-side
aggregate and broadcast, so rows of a hot text are settled in place and never
meet in one task; all other digests take the ordinary shuffle.

Defined results: a null text counts as empty (and equals every other empty
text); a null ``doc_id`` ranks below every number, so it stays only when no
copy has an id; rows that repeat both id and text share one verdict in
``duplicates`` and leave one row in ``drop_duplicates``; a very long text travels as its digest
(``drop_duplicates`` moves each text once); an empty table gives an empty result; other columns are ignored by ``duplicates`` and carried
unchanged by ``drop_duplicates``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, materialize, pick, positional

# Counters of the summary.  A digest with more than about 2 x 3.5 / COUNTERS
# of all rows (0.1 %) is certain to be named; missing one costs speed only.
COUNTERS = 8192
# Named digests, hence rows of the broadcast table: at most 1,000 x ~90 bytes.
HEAVY_LIMIT = 1000
# Summaries are merged in this many groups first, then together.
MERGE_GROUPS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text with A-Z lower-cased, null as empty."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256)


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Candidate heavy hitters by a Misra-Gries summary per task, merged in
    two steps (so no single task receives a summary of every input task)."""
    local = digests.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {COUNTERS})").alias("s"))
    # grouped by a constant: an ungrouped merge fails on empty partitions
    merged = local.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {COUNTERS})").alias("s"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(s, {HEAVY_LIMIT})")).alias("e"))
    return top.select(F.col("e.item").alias("text_sha256"))


def _winners(digests: DataFrame) -> DataFrame:
    return digests.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def split_winners(digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heavy, ordinary) winner tables (text_sha256, keep_id, group_size).
    ``digests`` has to be cheap to read again (a written table)."""
    named = F.broadcast(frequent_digests(digests))
    heavy = materialize(_winners(digests.join(named, "text_sha256", "left_semi")), "heavy-digests")
    rest = digests.join(F.broadcast(heavy), "text_sha256", "left_anti")
    return heavy, _winners(rest)


def duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    ids = pick(docs, "doc_id", "text")
    digests = materialize(ids.select("doc_id", text_digest(F.col("text")).alias("text_sha256")), "digests")
    heavy, ordinary = split_winners(digests)
    hot = digests.join(F.broadcast(heavy), "text_sha256")
    rest = digests.join(F.broadcast(heavy), "text_sha256", "left_anti").join(ordinary, "text_sha256")
    cols = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    return hot.select(*cols).unionByName(rest.select(*cols))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged, one per text."""
    cols, rows = docs.columns, positional(docs)
    own_id, own_text = (F.col(f"_c{cols.index(n)}") for n in ("doc_id", "text"))
    rows = rows.withColumn("_digest", text_digest(own_text)).withColumn("_id", own_id)
    digests = materialize(rows.select(F.col("_id").alias("doc_id"), F.col("_digest").alias("text_sha256")), "digests")
    heavy, ordinary = split_winners(digests)

    def winners_of(part: DataFrame, winners: DataFrame) -> DataFrame:
        # keep_id is the largest id of its digest.  It is compared, not joined:
        # rows then meet by the digest alone, and those that repeat id and text
        # are dropped where they are, without a second shuffle of texts
        w = winners.select("text_sha256", "keep_id")
        largest = (F.col("_id") >= F.col("keep_id")) | (F.col("_id").isNull() & F.col("keep_id").isNull())
        kept = part.join(w, (F.col("_digest") == F.col("text_sha256")) & largest, "left_semi").dropDuplicates(["_digest"])
        return kept.select(*[f"_c{i}" for i in range(len(cols))])

    hot = winners_of(rows, F.broadcast(heavy))
    rest = winners_of(rows.join(F.broadcast(heavy.select(F.col("text_sha256").alias("_digest"))), "_digest", "left_anti"), ordinary)
    return hot.unionByName(rest).toDF(*cols)


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
