"""Inputs derived from the driver tables, as DataFrames and as SQL.

* ``authority``  - geopolitical authority rows (irn_eluts + four place fields)
* ``transcribed`` - probe rows with blanks, 'none' and 'nan' in them
* ``normalized`` - probes with every blank spelling unified to ''
* ``replies``    - damaged model replies derived from ``events.props``

The SQL strings are the same derivations for the DuckDB oracle; they are
plain SQL with CTE names ``auth``, ``trans``, ``norm``, ``replies``.  ``auth``
and ``norm`` are ``MATERIALIZED``: same rows, and it keeps DuckDB's parquet
dictionary cache out of the nested-loop joins (an internal error at sf0.1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_blank
from ..session import table


def authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are dimension tables: the planner
    # broadcasts them by its size statistics, the large customer side streams.
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").cast("bigint").alias("irn_eluts"),
                    F.col("r_name").alias("continent"), F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("state_province"), F.col("c_name").alias("county")))


def transcribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(
                k.cast("bigint").alias("irn"),
                F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, "none").otherwise(F.col("r_name")).alias("dar_continent"),
                F.when(k % 3 == 0, F.lit(None)).when(k % 11 == 0, "nan").otherwise(F.col("n_name")).alias("dar_country"),
                F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "MACHINERY").when(k % 4 == 2, "BUILDING")
                 .otherwise("FURNITURE").alias("dar_state_province"),
                F.when(k % 2 == 0, F.lit(None)).otherwise(F.lpad((k % 100).cast("string"), 2, "0")).alias("dar_county"),
            ))


def normalize(df: DataFrame, prefix: str = "dar_", none_is_blank: bool = True) -> DataFrame:
    """Project the four place fields (renamed) and unify blanks to ''."""
    return df.select(
        "irn",
        *[normalize_blank(F.col(prefix + f), none_is_blank).alias(f)
          for f in ("continent", "country", "state_province", "county")])


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(transcribed(spark, sf_dir))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "props")
    p = F.col("props")
    m = F.col("event_id") % 8
    reply = (F.when(m == 0, p)
             .when(m == 1, F.concat(F.lit("```json "), p, F.lit(" ```")))
             .when(m == 2, F.concat(F.lit("["), p, F.lit("]")))
             .when(m == 3, F.lit('{"k": null}'))
             .when(m == 4, F.expr("substring(props, 1, length(props) - 1)"))
             .when(m == 5, F.lit("{}"))
             .when(m == 6, F.lit("no match found"))
             .otherwise(F.concat(F.lit("["), p, F.lit(", "), p, F.lit("]"))))
    return e.select(F.col("event_id").alias("reply_id"), reply.alias("reply"))


AUTH_SQL = """auth AS MATERIALIZED (
  SELECT CAST(c_custkey AS BIGINT) AS irn_eluts, r_name AS continent, n_name AS country,
         c_mktsegment AS state_province, c_name AS county
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

TRANS_SQL = """trans AS (
  SELECT CAST(s_suppkey AS BIGINT) AS irn,
    CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN 'none' ELSE r_name END AS dar_continent,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN 'nan' ELSE n_name END AS dar_country,
    CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'MACHINERY' WHEN 2 THEN 'BUILDING' ELSE 'FURNITURE' END AS dar_state_province,
    CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') END AS dar_county
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

NORM_SQL = """norm AS MATERIALIZED (
  SELECT irn,
    coalesce(nullif(nullif(dar_continent,'nan'),'none'),'') AS continent,
    coalesce(nullif(nullif(dar_country,'nan'),'none'),'') AS country,
    coalesce(nullif(nullif(dar_state_province,'nan'),'none'),'') AS state_province,
    coalesce(nullif(nullif(dar_county,'nan'),'none'),'') AS county
  FROM trans)"""

REPLIES_SQL = """replies AS (
  SELECT event_id AS reply_id, CASE event_id % 8
    WHEN 0 THEN props WHEN 1 THEN concat('```json ', props, ' ```') WHEN 2 THEN concat('[', props, ']')
    WHEN 3 THEN '{"k": null}' WHEN 4 THEN substring(props, 1, length(props) - 1) WHEN 5 THEN '{}'
    WHEN 6 THEN 'no match found' ELSE concat('[', props, ', ', props, ']') END AS reply
  FROM events)"""


def with_views(body: str, *views: str, ctes=()) -> str:
    """``WITH`` the named derived views (``auth``, ``trans``, ``norm``,
    ``replies``; ``norm`` pulls in ``trans``) and any extra ``name AS (...)``
    CTE strings, then ``body``."""
    names = list(views)
    if "norm" in names and "trans" not in names:
        names.insert(names.index("norm"), "trans")
    parts = {"auth": AUTH_SQL, "trans": TRANS_SQL, "norm": NORM_SQL, "replies": REPLIES_SQL}
    blocks = [parts[n] for n in names] + [c.strip() for c in ctes]
    if not blocks:
        return body
    return "WITH " + ",\n".join(blocks) + "\n" + body
