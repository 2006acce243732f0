"""Registered queries of the composed jobs, of the splitters' facts and of
file sources (see ``catalog`` for the contract of a query)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies as R
from ..functions.text import PLACE_FIELDS, PLACE_TEMPLATE, RECONCILE_TEMPLATE, RETRIEVE_INSTRUCTION
from ..functions.text import image_reference, instruction_text
from ..operators import chunking, textcheck
from ..session import new_scratch_path, spread, table
from ..sinks import files as sinks
from ..sources import files as sources
from . import jobs, match_eval, retrieve, views
from .catalog import (COUNT_SQL, EMBED_DIM, EVAL_PROBES_SQL, INSTRUCTION_SQL, NEAREST_SQL, PAIRS_SQL, PLACES_SQL, PREDICATE_TEXT_SQL, QUESTION_SQL,
                      REQUEST_MODEL, REQUEST_PROMPT, RETRIEVE_CTES, SEP_SQL, TOP_K, _bucket_rows_sql, _docs, _hits, _status_sql, _trim_sql,
                      query, template_sql, with_views)

CAP = 60


def _inputs(spark, sf):
    return views.normalized(spark, sf), views.authority(spark, sf)


# ---- reconcile with a table of replies ------------------------------------

def _reply_table(spark, sf):
    """Replies to the reconcile prompts, some damaged: fenced, refused, empty,
    cut off, missing, with a repeated key."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("irn"), "s_name")
    m = F.col("irn") % 6
    body = F.concat(F.lit('"irn_eluts":"'), F.col("irn").cast("string"), F.lit('","continent":"X","county":"'), F.col("s_name"), F.lit('"'))
    reply = (F.when(m == 0, F.concat(F.lit("```json {"), body, F.lit("} ```"))).when(m == 1, F.lit("no match found")).when(m == 2, F.lit("{}"))
             .when(m == 3, F.concat(F.lit("{"), body)).when(m == 4, F.concat(F.lit("{"), body, F.lit(',"continent":"Y"}'))))
    return s.select("irn", reply.alias("reply")).filter("reply IS NOT NULL")


REPLY_BODY = """'"irn_eluts":"' || s_suppkey || '","continent":"X","county":"' || s_name || '"'"""
REPLY_TABLE_SQL = f"""given AS (
  SELECT * FROM (SELECT CAST(s_suppkey AS BIGINT) AS irn, CASE s_suppkey % 6
    WHEN 0 THEN '```json {{' || {REPLY_BODY} || '}} ```' WHEN 1 THEN 'no match found' WHEN 2 THEN '{{}}'
    WHEN 3 THEN '{{' || {REPLY_BODY} WHEN 4 THEN '{{' || {REPLY_BODY} || ',"continent":"Y"}}' END AS reply FROM supplier) s
  WHERE reply IS NOT NULL)"""


def _reply_field(f):
    # of a repeated key the last value counts
    value = f"CASE WHEN cleaned LIKE '%,\"continent\":\"Y\"}}' THEN 'Y' ELSE json_extract_string(cleaned, '$.{f}') END" if f == "continent" else f"json_extract_string(cleaned, '$.{f}')"
    return f"coalesce({value}, 'none')"


@query("reconcile_replies", with_views("SELECT CASE WHEN error = 'OK' THEN " + _reply_field("irn_eluts") + " ELSE 'none' END AS irn_eluts, "
       + ", ".join(f"CASE WHEN error = 'OK' THEN {_reply_field(f)} ELSE {f} END AS {f}" for f in PLACE_FIELDS)
       + f""", num_authority_matches, CAST(irn AS VARCHAR) AS irn, error, {PREDICATE_TEXT_SQL.format(p='')} AS query_string,
  CASE WHEN error = 'OK' THEN 'NA' ELSE cleaned END AS error_output
FROM (SELECT *, {_status_sql('cleaned')} AS error FROM trimmed) s""", "auth", "norm", ctes=[COUNT_SQL, REPLY_TABLE_SQL, f"""trimmed AS (
  SELECT c.*, CASE WHEN num_authority_matches = 0 THEN '{{}}' ELSE {_trim_sql("coalesce(g.reply, '')")} END AS cleaned
  FROM counts c LEFT JOIN given g ON g.irn = c.irn)"""]))
def q_reconcile_replies(spark, sf):
    return jobs.reconcile_replies(*_inputs(spark, sf), _reply_table(spark, sf))


@query("reconcile_prompt", with_views(f"""SELECT c.irn, c.num_authority_matches,
  CASE WHEN num_authority_matches > 0 THEN {template_sql(RECONCILE_TEMPLATE, context='l.candidates', question=INSTRUCTION_SQL)} END AS prompt
FROM counts c LEFT JOIN lists l ON c.irn = l.irn""", "auth", "norm", ctes=[PAIRS_SQL, COUNT_SQL, """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY irn ORDER BY round(score, 6) DESC, a_irn_eluts) AS rk FROM pairs)""", f"""lists AS (
  SELECT irn, CAST(to_json(list({{'irn_eluts': CAST(a_irn_eluts AS VARCHAR), 'continent': a_continent, 'country': a_country,
    'state_province': a_state_province, 'county': a_county}} ORDER BY rk)) AS VARCHAR) AS candidates
  FROM ranked WHERE rk <= {CAP} GROUP BY irn)"""]))
def q_reconcile_prompt(spark, sf):
    """The prompt's limit of 60 candidates is its feature; ``candidate_pages``
    holds all of them."""
    return jobs.reconcile_prompts(*_inputs(spark, sf), CAP)


@query("retrieve_instruction", with_views(f"SELECT irn, {template_sql(RETRIEVE_INSTRUCTION, **PLACES_SQL)} AS instruction FROM norm", "norm"))
def q_retrieve_instruction(spark, sf):
    return views.normalized(spark, sf).select("irn", instruction_text(*PLACE_FIELDS, template=RETRIEVE_INSTRUCTION).alias("instruction"))


# ---- retrieval over the rows of the authority ------------------------------

def _place_ctes(questions: str, k: int = TOP_K) -> list[str]:
    """Nearest row documents of ``questions`` (query_id, text).  Every row
    document is shorter than a chunk, so it is one."""
    return [
        """rowdocs AS MATERIALIZED (SELECT irn_eluts AS chunk_id, 'irn_eluts: ' || irn_eluts || chr(10) || 'continent: ' || coalesce(continent, '') || chr(10)
  || 'country: ' || coalesce(country, '') || chr(10) || 'state_province: ' || coalesce(state_province, '') || chr(10) || 'county: ' || coalesce(county, '') AS chunk FROM auth)""",
        f"asked AS MATERIALIZED ({questions})",
        _bucket_rows_sql("cvec", "chunk_id", "chunk", "rowdocs"), _bucket_rows_sql("qvec", "query_id", "text", "asked"),
        "cnorm AS (SELECT chunk_id, sum(cnt * cnt) AS n2 FROM cvec GROUP BY 1)", "qnorm AS (SELECT query_id, sum(cnt * cnt) AS n2 FROM qvec GROUP BY 1)",
        "dots AS (SELECT q.query_id, c.chunk_id, sum(q.cnt * c.cnt) AS dot FROM qvec q JOIN cvec c ON q.b = c.b GROUP BY 1, 2)",
        """scored AS (SELECT d.query_id, d.chunk_id, CAST(2.0 AS DOUBLE) - CAST(2.0 AS DOUBLE) * CAST(d.dot AS DOUBLE) / sqrt(CAST(qn.n2 * cn.n2 AS DOUBLE)) AS distance
  FROM dots d JOIN qnorm qn ON qn.query_id = d.query_id JOIN cnorm cn ON cn.chunk_id = d.chunk_id)""",
        f"""hits AS (SELECT h.*, 1 - h.distance / sqrt(2) AS relevance, r.chunk FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rk FROM scored) h
  JOIN rowdocs r ON r.chunk_id = h.chunk_id WHERE rk <= {k})""",
    ]


PLACE_CTES = _place_ctes(f"SELECT irn AS query_id, {QUESTION_SQL} AS text FROM norm")


def _place_hits(spark, sf):
    probes, authority = _inputs(spark, sf)
    return probes, authority, jobs.place_hits(probes, jobs.row_chunks(spread(authority)), TOP_K, EMBED_DIM)


@query("place_prompts", with_views(f"""SELECT n.irn, coalesce(n_hits, 0) AS n_hits, round(best, 6) AS best_relevance, coalesce(best < 0.5, true) AS low_confidence,
  {template_sql(PLACE_TEMPLATE, context="coalesce(context, '')", question=template_sql(RETRIEVE_INSTRUCTION, **PLACES_SQL))} AS prompt
FROM norm n LEFT JOIN (SELECT query_id, count(*) AS n_hits, max(relevance) AS best, string_agg(chunk, {SEP_SQL} ORDER BY rk) AS context
  FROM hits GROUP BY 1) c ON c.query_id = n.irn""", "auth", "norm", ctes=PLACE_CTES))
def q_place_prompts(spark, sf):
    probes, _, hits = _place_hits(spark, sf)
    return jobs.place_prompts(probes, hits).withColumn("best_relevance", F.round("best_relevance", 6))


@query("retrieve_places", with_views("SELECT CAST(n.irn AS VARCHAR) AS irn, CASE WHEN a.irn_eluts IS NULL THEN 'INVALID_JSON' ELSE 'OK' END AS error, "
       "coalesce(CAST(a.irn_eluts AS VARCHAR), 'none') AS irn_eluts, " + ", ".join(f"CASE WHEN a.irn_eluts IS NULL THEN 'none' ELSE coalesce(a.{f}, '') END AS {f}" for f in PLACE_FIELDS)
       + ", CASE WHEN a.irn_eluts IS NULL THEN '' ELSE 'NA' END AS error_output FROM norm n LEFT JOIN hits h ON h.query_id = n.irn AND h.rk = 1 "
       "LEFT JOIN auth a ON a.irn_eluts = h.chunk_id", "auth", "norm", ctes=PLACE_CTES))
def q_retrieve_places(spark, sf):
    probes, authority, hits = _place_hits(spark, sf)
    return jobs.answered_rows(probes, jobs.nearest_replies(hits, authority))


@query("source_records", with_views("SELECT query_id, CAST(to_json(list({'source': source, 'start_index': start_index} ORDER BY rk)) AS VARCHAR) AS sources "
       "FROM (SELECT h.query_id, h.rk, c.source, c.start_index FROM hits h JOIN chunks c ON c.chunk_id = h.chunk_id) s GROUP BY 1", ctes=RETRIEVE_CTES))
def q_source_records(spark, sf):
    return retrieve.source_records(_hits(spark, sf)).withColumn("sources", F.to_json("sources"))


# ---- evaluation: hit@1 and hit@k -------------------------------------------

@query("match_eval_topk", with_views(f"""SELECT p.variant, count(*) AS n_probes, count(CASE WHEN r.rk = 1 THEN 1 END) AS n_hit1, count(r.rk) AS n_hitk
FROM probes p LEFT JOIN (SELECT irn, a_irn_eluts, row_number() OVER (PARTITION BY irn ORDER BY round(score, 6) DESC, a_irn_eluts) AS rk FROM pairs) r
  ON r.irn = p.irn AND r.a_irn_eluts = p.expected AND r.rk <= {TOP_K} GROUP BY p.variant""",
    "auth", ctes=[EVAL_PROBES_SQL, PAIRS_SQL.replace("FROM norm t", "FROM probes t")]))
def q_match_eval_topk(spark, sf):
    return match_eval.match_eval_topk(views.authority(spark, sf), TOP_K)


@query("retrieve_eval", with_views("""SELECT p.variant, count(*) AS n_probes, count(CASE WHEN h.rk = 1 THEN 1 END) AS n_hit1, count(h.rk) AS n_hitk
FROM cases p LEFT JOIN hits h ON h.query_id = p.irn AND h.chunk_id = p.expected GROUP BY p.variant""", "auth", ctes=[
    EVAL_PROBES_SQL, "cases AS MATERIALIZED (SELECT * FROM probes WHERE expected % 4 = variant)",
    *_place_ctes(f"SELECT irn AS query_id, {QUESTION_SQL} AS text FROM cases")]))
def q_retrieve_eval(spark, sf):
    return match_eval.retrieve_eval(views.authority(spark, sf), TOP_K, EMBED_DIM)


@query("retrieve_eval_all")
def q_retrieve_eval_all(spark, sf):
    """Every authority row in every variant (a pytest compares brute force)."""
    return match_eval.retrieve_eval_all(views.authority(spark, sf), TOP_K, EMBED_DIM)


# ---- splitters: facts per document -------------------------------------------

def _chunk_facts(docs, chunks, too_long):
    """Every document: its chunks' non-blank characters, and how many chunks
    break the size or do not stand where their offset says."""
    free = F.length(F.regexp_replace("chunk", r"[\s\p{Zs}\x1c-\x1f\x85]", ""))
    placed = chunks.join(docs.select("doc_id", "text"), "doc_id").withColumn(
        "bad", too_long | (F.expr("substring(text, start_index + 1, length(chunk))") != F.col("chunk")))
    facts = placed.groupBy("doc_id").agg(F.sum(free).alias("n_free"), F.count(F.when(F.col("bad"), 1)).alias("violations"))
    return docs.select("doc_id").join(facts, "doc_id", "left").select("doc_id", F.coalesce("n_free", F.lit(0)).alias("n_free"), F.coalesce("violations", F.lit(0)).alias("violations"))


FACTS_SQL = r"SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[\s\p{Zs}\x1c-\x1f\x{85}]', '', 'g')) AS n_free, 0 AS violations FROM documents"


@query("chunk_recursive_facts", FACTS_SQL)
def q_chunk_recursive_facts(spark, sf):
    docs = _docs(spark, sf)
    return _chunk_facts(docs, chunking.recursive_chunks(docs, 300, 0), F.length("chunk") > 300)


@query("chunk_token_facts", FACTS_SQL)
def q_chunk_token_facts(spark, sf):
    """The recursive splitter measured in tokens instead of characters."""
    docs = _docs(spark, sf)
    return _chunk_facts(docs, chunking.recursive_chunks(docs, 60, 0, length=chunking.token_length), F.size(F.split(F.trim("chunk"), r"\s+")) > 60)


# ---- files -----------------------------------------------------------------------

@query("csv_newline_cells", "SELECT conv_id, turn, role, text FROM (SELECT conv_id, turn, role, role || ' says:' || chr(10) || ' ' || text || ' ' AS text FROM conversations) s")
def q_csv_newline_cells(spark, sf):
    """Cells with newlines and blanks at their ends, written and read back."""
    path = new_scratch_path(spark, "conversations-csv")
    text = F.concat("role", F.lit(" says:\n "), "text", F.lit(" "))
    sinks.write_csv(table(spark, sf, "conversations").select("conv_id", "turn", "role", text.alias("text")), path)
    return sources.read_csv_table(spark, path, "conv_id bigint, turn bigint, role string, text string", multiline=True, null_tokens=(), keep_empty=True)


@query("image_requests", f"""SELECT file, length(content) AS n_bytes, 'data:image/jpeg;base64,' || to_base64(encode(content)) AS image_ref,
  '{{"model":' || to_json('{REQUEST_MODEL}'::VARCHAR) || ',"logprobs":false,"messages":[{{"role":"user","content":[{{"type":"text","temperature":"0.0","text":'
  || to_json('{REQUEST_PROMPT}'::VARCHAR) || '}},{{"type":"image_url","image_url":{{"url":"data:image/jpeg;base64,' || to_base64(encode(content)) || '"}}}}]}}],"max_tokens":4096}}' AS request
FROM (SELECT s_suppkey % 16 AS file, string_agg(s_name || chr(10), '' ORDER BY s_suppkey) AS content FROM supplier GROUP BY 1) s""")
def q_image_requests(spark, sf):
    """Files read as bytes -> data URL -> request."""
    path = new_scratch_path(spark, "images")
    rows = table(spark, sf, "supplier").select((F.col("s_suppkey") % 16).alias("file"), "s_suppkey", "s_name").repartition(16, "file").sortWithinPartitions("file", "s_suppkey")
    rows.select("file", "s_name").write.partitionBy("file").text(path)
    files = sources.read_binary_files(spark, path + "/file=*", "*.txt")
    ref = image_reference(F.lit("file"), F.col("path"), F.col("content"))
    return files.select(F.regexp_extract("path", r"file=(\d+)", 1).cast("bigint").alias("file"), F.col("length").alias("n_bytes"), ref.alias("image_ref"),
                        R.request_payload(F.lit(REQUEST_MODEL), F.lit(REQUEST_PROMPT), ref, F.lit(4096)).alias("request"))


@query("markup_by_host")
def q_markup_by_host(spark, sf):
    """Pages whose markup is not well-formed, counted by host and message."""
    pages = spread(table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1).alias("host"), "html"))
    return textcheck.quality_by_source(textcheck.xml_quality(pages, "page_id", "html", carry=("host",)), "host")
