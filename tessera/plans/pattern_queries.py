"""Registered queries of the authority join with regular-expression counties,
of replies with keys nobody listed, of the splitter as a table function, and
of the hooks: another embedder, another score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tables
from ..functions import vectors as V
from ..functions.text import PLACE_FIELDS
from ..operators import authority as auth_ops
from ..session import table
from . import open_replies, views
from . import reconcile as rec
from . import retrieve as retr
from .catalog import CLEANED_SQL, COUNT_SQL, EMBED_DIM, NEAREST_SQL, PAIRS_SQL, RETRIEVE_CTES, SCORE_SQL, STATUS_SQL, TOP_K, _cut_fixed, _docs, _questions, _searched, query
from .job_queries import FACTS_SQL, _chunk_facts
from .views import with_views


def _patterned(spark, sf):
    """Probes whose counties are patterns of the kinds people write: plain
    digits, an end anchor, a group (as in a name with ``(Zone)``), alternatives,
    classes and repeats, and one that requires nothing."""
    n, k = views.normalized(spark, sf), F.col("irn")
    digits, wide = F.lpad((k % 100).cast("string"), 2, "0"), F.lpad(k.cast("string"), 9, "0")
    pattern = (F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.concat(digits, F.lit("$"))).when(k % 8 == 2, F.concat(F.lit("Customer#("), wide, F.lit(")")))
               .when(k % 8 == 3, F.concat(F.lit("#0+("), digits, F.lit("|1"), digits, F.lit(")$"))).when(k % 8 == 4, F.concat(F.lit("[0-4]"), digits, F.lit("[5-9]")))
               .when(k % 8 == 5, F.lit("^Customer.*[02468]$")).when(k % 8 == 6, F.concat(F.lit("(Zone)"), digits)).otherwise(F.lit(".?")))
    return n.withColumn("county", pattern)


PATTERNED_SQL = """norm AS MATERIALIZED (SELECT irn, continent, country, state_province, CASE irn % 8
  WHEN 0 THEN '' WHEN 1 THEN d || '$' WHEN 2 THEN 'Customer#(' || lpad(CAST(irn AS VARCHAR), 9, '0') || ')' WHEN 3 THEN '#0+(' || d || '|1' || d || ')$'
  WHEN 4 THEN '[0-4]' || d || '[5-9]' WHEN 5 THEN '^Customer.*[02468]$' WHEN 6 THEN '(Zone)' || d ELSE '.?' END AS county
  FROM (SELECT *, lpad(CAST(irn % 100 AS VARCHAR), 2, '0') AS d FROM plain))"""
NORM_AS_PLAIN = views.NORM_SQL.replace("norm AS", "plain AS", 1)


def _regex(sql: str) -> str:
    return sql.replace("contains(a.county, t.county)", "regexp_matches(a.county, t.county)")


@query("regex_match_count", with_views("SELECT * FROM counts", "auth", "trans", ctes=[NORM_AS_PLAIN, PATTERNED_SQL, _regex(COUNT_SQL)]))
def q_regex_match_count(spark, sf):
    return auth_ops.match_counts(_patterned(spark, sf), views.authority(spark, sf), county="regex")


@query("regex_lookup", with_views("SELECT irn, count(*) AS n, min(a_irn_eluts) AS first_irn, max(a_irn_eluts) AS last_irn, sum(a_irn_eluts)::BIGINT AS total FROM pairs GROUP BY irn",
                                  "auth", "trans", ctes=[NORM_AS_PLAIN, PATTERNED_SQL, _regex(PAIRS_SQL)]))
def q_regex_lookup(spark, sf):
    """The authority rows of every probe, summed up per probe."""
    pairs = auth_ops.authority_candidates(_patterned(spark, sf), views.authority(spark, sf), county="regex")
    return pairs.groupBy("irn").agg(F.count("*").alias("n"), F.min("a_irn_eluts").alias("first_irn"), F.max("a_irn_eluts").alias("last_irn"), F.sum("a_irn_eluts").alias("total"))


@query("regex_reconcile", with_views(f"SELECT c.irn::VARCHAR AS irn, c.num_authority_matches, coalesce(n.a_irn_eluts::VARCHAR, 'none') AS irn_eluts, "
                                     "CASE WHEN c.num_authority_matches > 0 THEN 'OK' ELSE 'NO_ANSWER' END AS error, "
                                     + ", ".join(f"coalesce(n.a_{f}, c.{f}) AS {f}" for f in PLACE_FIELDS) +
                                     " FROM counts c LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY irn ORDER BY score DESC, a_irn_eluts) AS rk FROM pairs) s "
                                     "WHERE rk = 1) n ON n.irn = c.irn", "auth", "trans", ctes=[NORM_AS_PLAIN, PATTERNED_SQL, _regex(PAIRS_SQL), _regex(COUNT_SQL)]))
def q_regex_reconcile(spark, sf):
    out = rec.reconcile(_patterned(spark, sf), views.authority(spark, sf), county="regex")
    return out.select("irn", "num_authority_matches", "irn_eluts", "error", *PLACE_FIELDS)


def _open_replies(spark, sf):
    """Replies whose keys differ from row to row, some of them damaged."""
    e, k = table(spark, sf, "events").select("event_id", "props"), F.col("event_id")
    n = F.get_json_object("props", "$.k")
    reply = (F.when(k % 6 == 0, F.col("props")).when(k % 6 == 1, F.concat(F.lit('{"note": "n'), (k % 10).cast("string"), F.lit('", "k": '), n, F.lit("}")))
             .when(k % 6 == 2, F.concat(F.lit('Here: {"k": '), n, F.lit(', "score": '), n, F.lit(".5}")))
             .when(k % 6 == 3, F.concat(F.lit('{"score": '), n, F.lit(', "tags": ["a", '), n, F.lit("]}"))).when(k % 6 == 4, F.concat(F.lit('{"k": null, "ok": true, "note": "'), n, F.lit('"}')))
             .otherwise(F.lit('{"k": 1, "lost": ')))
    return e.select(F.col("event_id").alias("reply_id"), reply.alias("reply"))


OPEN_SQL = """replies AS (SELECT event_id AS reply_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '{"note": "n' || (event_id % 10) || '", "k": ' || n || '}'
  WHEN 2 THEN 'Here: {"k": ' || n || ', "score": ' || n || '.5}' WHEN 3 THEN '{"score": ' || n || ', "tags": ["a", ' || n || ']}'
  WHEN 4 THEN '{"k": null, "ok": true, "note": "' || n || '"}' ELSE '{"k": 1, "lost": ' END AS reply FROM (SELECT *, json_extract_string(props, '$.k') AS n FROM events))"""


@query("reply_extra", with_views(
    "SELECT reply_id, error, CASE WHEN error = 'OK' THEN coalesce(json_extract_string(cleaned, '$.k'), 'none') END AS k, "
    "CASE WHEN error = 'OK' THEN array_to_string(list_sort([x || '=' || coalesce(json_extract_string(cleaned, '$.' || x), 'none') FOR x IN json_keys(cleaned) IF x <> 'k']), ';') END AS extra "
    "FROM status", ctes=[OPEN_SQL, CLEANED_SQL, STATUS_SQL]))
def q_reply_extra(spark, sf):
    """The listed field and, as sorted text, every other key of a reply."""
    out = open_replies.with_extra(_open_replies(spark, sf), ("k",))
    pairs = F.transform(F.map_entries("extra"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("reply_id", "error", "k", F.when(F.col("extra").isNotNull(), F.array_join(F.array_sort(pairs), ";")).alias("extra"))


@query("reply_dynamic", with_views(
    "SELECT reply_id, error, CASE WHEN error = 'OK' THEN 'NA' ELSE cleaned END AS error_output, CASE WHEN error = 'OK' THEN json_extract_string(cleaned, '$.k')::BIGINT END AS k, "
    "CASE WHEN error = 'OK' THEN json_extract_string(cleaned, '$.note') END AS note, CASE WHEN error = 'OK' THEN json_extract_string(cleaned, '$.score')::DOUBLE END AS score, "
    "CASE WHEN error = 'OK' THEN json_extract(cleaned, '$.tags')::VARCHAR END AS tags, CASE WHEN error = 'OK' THEN json_extract_string(cleaned, '$.ok')::BOOLEAN END AS ok "
    "FROM status", ctes=[OPEN_SQL, CLEANED_SQL, STATUS_SQL]))
def q_reply_dynamic(spark, sf):
    """One typed column for every key that occurs in the replies."""
    return open_replies.dynamic_rows(_open_replies(spark, sf)).drop("extra")


@query("chunk_udtf_facts", FACTS_SQL)
def q_chunk_udtf_facts(spark, sf):
    """The recursive splitter called from SQL, checked like
    ``chunk_recursive_facts``."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    tables.register(spark)
    chunks = spark.sql("SELECT d.doc_id, c.* FROM {docs} d, LATERAL split_text(d.text, 300, 0) c", docs=docs)
    return _chunk_facts(docs, chunks, F.length("chunk") > 300)


@query("retrieve_embedder", with_views("SELECT query_id, rk, chunk_id, source, round(distance, 6) AS distance FROM hits",
                                       ctes=[c.replace("lower(chunk)", "chunk").replace("lower(text)", "text") for c in RETRIEVE_CTES]))
def q_retrieve_embedder(spark, sf):
    """Retrieval with another embedder on both sides: token counts that tell
    upper from lower case."""
    def embed(df, text_col, out_col, dim):
        return V.with_hashed_counts(df, text_col, out_col, dim, lower=False)

    embed.in_task = lambda text, dim: (V.hashed_text(text, lower=False), V.text_counts(dim))
    hits = retr.hits_for(_questions(spark, sf), _searched(spark, sf), TOP_K, EMBED_DIM, embed=embed, cut=(_docs(spark, sf), _cut_fixed))
    return hits.select("query_id", "rk", "chunk_id", "source", F.round("distance", 6).alias("distance"))


RULE_SQL = "3.0 * CAST(a.state_province = t.state_province AS DOUBLE) + CAST(a.continent = t.continent AS DOUBLE) + (a.irn_eluts % 7) / 10.0"


@query("nearest_rule", with_views("SELECT irn, a_irn_eluts AS irn_eluts, round(score, 6) AS score FROM nearest", "auth", "norm", ctes=[PAIRS_SQL.replace(SCORE_SQL, RULE_SQL), NEAREST_SQL]))
def q_nearest_rule(spark, sf):
    """The nearest candidate under another rule than the default score."""
    def agree(field):
        return (F.col("a_" + field) == F.col(field)).cast("double")

    rule = F.lit(3.0) * agree("state_province") + agree("continent") + (F.col("a_irn_eluts") % 7) / F.lit(10.0)
    out = auth_ops.nearest_candidates(views.normalized(spark, sf), views.authority(spark, sf), score=rule)
    return out.select("irn", "irn_eluts", F.round("score", 6).alias("score"))
