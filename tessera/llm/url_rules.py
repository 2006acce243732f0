"""URL rules by host-suffix / path-prefix expressions.

Every URL is expanded into the expressions ``host suffix + path prefix`` of
the shapes that occur in the rule table (label count, path length), each
expression is hashed, a short hash prefix is equi-joined with the rules, the
full digest confirms the match, and the longest fitting rule decides.

Defined results: the host is what follows the first ``://`` up to ``/``,
``?``, ``#`` or the end with A-Z lower-cased, the path what follows up to
``?``, ``#`` or the end; a null URL or one without ``://`` has an empty host
and path and takes the default verdict.  Of several fitting rules the longest
``host + path`` wins, then the longer host, then ``block``.  Repeated pages
are judged row by row, a null page_id like any other; a very long URL has no
more expressions than the rule table has shapes; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, pick
from tessera.session import fits

# Rule rows (host, path, verdict): the fixed list of the contract.
DEFAULT_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
                 ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT_VERDICT = "allow"
PREFIX_HEX = 8  # hex digits of the short hash prefix (32 bits)
BROADCAST_RULES = 100_000  # rows; a row is two digests and a rule, below 1 kB for rules below 700 characters
RULE_CHARS = 700


def rule_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(after, r"^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def hashed_rules(rules: DataFrame) -> DataFrame:
    r = rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
    r = r.groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))  # block wins over allow for one rule given twice
    full = F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256)
    return r.select("*", full.alias("r_full"), F.substring(full, 1, PREFIX_HEX).alias("r_prefix"),
                    _labels(F.col("r_host")).alias("labels"), F.length("r_path").alias("path_chars"))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """array<struct<full, prefix>> of the URL's expressions of the given
    shapes; their number is bounded by the shapes of the rule table, not by
    the length of the URL."""
    def one(labels: int, chars: int) -> Column:
        full = F.sha2(F.concat_ws("\n", F.substring_index(host, ".", -labels), F.substring(path, 1, chars)), 256)
        fits_shape = (_labels(host) >= labels) & (F.length(path) >= chars) & (F.length(host) > 0)
        return F.when(fits_shape, F.struct(full.alias("full"), F.substring(full, 1, PREFIX_HEX).alias("prefix")))
    if not shapes:
        return F.array().cast("array<struct<full:string,prefix:string>>")
    return F.filter(F.array(*[one(a, b) for a, b in shapes]), lambda x: x.isNotNull())


def judge(pages: DataFrame, rules: DataFrame | None = None, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, url, host, path, rule, verdict: one row per input row."""
    rules = rules if rules is not None else rule_table(pages.sparkSession)
    table = hashed_rules(rules)
    # distinct (labels, path length) pairs of the rule table: bounded by the
    # longest host and path that a rule has
    shapes = sorted((r.labels, r.path_chars) for r in table.select("labels", "path_chars").distinct().collect())
    host, path = host_and_path(F.col("url"))
    # the row id only ties a row's own expressions together again
    rows = pick(pages, "page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("rid"))
    looked_up = rows.select("*", F.explode_outer(expressions(F.col("host"), F.col("path"), shapes)).alias("x"))
    known = table.select("r_host", "r_path", "r_verdict", "r_full", "r_prefix")
    small = fits(known, BROADCAST_RULES) and known.filter(F.length("r_host") + F.length("r_path") > RULE_CHARS).isEmpty()
    hit = looked_up.join(F.broadcast(known) if small else known, F.col("x.prefix") == F.col("r_prefix"), "left")
    confirmed = F.when(F.col("x.full") == F.col("r_full"), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("chars"), F.length("r_host").alias("host_chars"),
        F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule")))
    best = hit.groupBy("rid").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.first("host").alias("host"),
                                  F.first("path").alias("path"), F.max(confirmed).alias("best"))
    return best.select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


SQL = """
WITH s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
     p AS (SELECT page_id, translate(coalesce(regexp_extract(r, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM s),
     f AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                          WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                          WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                          WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM f
"""
