"""Match evaluation: degrade every authority row in fixed ways, reconcile
the degraded probes, and count how often the nearest candidate is the row
the probe came from (hit@1) and how many probes found any candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLACE_FIELDS, question_text
from ..operators.authority import probe_stats, top_candidates
from ..session import spread
from .jobs import row_chunks
from .retrieve import hits_for

# The degradations, as (variant, blank fields, county rule).
#   0 exact; 1 country blank; 2 state blank + county tail after '#';
#   3 country and state blank + county tail.
VARIANTS = (
    (0, (), "full"),
    (1, ("country",), "full"),
    (2, ("state_province",), "tail"),
    (3, ("country", "state_province"), "tail"),
)


def degraded_probes(authority: DataFrame) -> DataFrame:
    """Every authority row in every variant, from one pass over the table."""
    def case(v, blanks, county):
        c = F.col("county") if county == "full" else F.substring_index(F.col("county"), "#", -1)
        return F.struct(
            (F.col("irn_eluts") * 10 + v).alias("irn"), F.lit(v).alias("variant"), F.col("irn_eluts").alias("expected"),
            *[(F.lit("") if f in blanks else F.coalesce(F.col(f), F.lit(""))).alias(f) for f in ("continent", "country", "state_province")],
            F.coalesce(c, F.lit("")).alias("county"))
    return authority.select(F.inline(F.array(*[case(*v) for v in VARIANTS])))


def match_eval(authority: DataFrame, **kw) -> DataFrame:
    j = probe_stats(degraded_probes(authority), authority, carry=("variant", "expected"), **kw)
    return j.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_probes"),
        F.count(F.when(F.col("best.irn_eluts") == F.col("expected"), 1)).alias("n_hit1"),
        F.count(F.when(F.col("num_authority_matches") > 0, 1)).alias("n_matched"),
        F.sum("num_authority_matches").alias("sum_candidates"))


def match_eval_topk(authority: DataFrame, k: int = 3, **kw) -> DataFrame:
    """hit@1 and hit@k of the reconcile job: is the row that a probe came from
    among its k best candidates?"""
    probes = degraded_probes(authority)
    top = top_candidates(probes, authority, k, **kw)
    found = probes.join(top.select(*PLACE_FIELDS, F.col("a_irn_eluts").alias("expected"), "rk"), [*PLACE_FIELDS, "expected"], "left")
    return _hits_at(found, k)


def retrieve_eval(authority: DataFrame, k: int = 3, dim: int = 64, **kw) -> DataFrame:
    """hit@1 and hit@k of the retrieval job over a quarter of the cases: every
    authority row gives one, degraded by its id modulo the number of variants
    (``retrieve_eval_all`` asks them all)."""
    authority = spread(authority)
    cases = degraded_probes(authority).filter(F.pmod("expected", F.lit(len(VARIANTS))) == F.col("variant"))
    return _retrieved(cases, authority, k, dim, **kw)


def retrieve_eval_all(authority: DataFrame, k: int = 3, dim: int = 64, **kw) -> DataFrame:
    """hit@1 and hit@k of the retrieval job, every authority row asked in every
    variant: the cases of ``match_eval_topk``."""
    authority = spread(authority)
    return _retrieved(degraded_probes(authority), authority, k, dim, **kw)


def _retrieved(cases: DataFrame, authority: DataFrame, k: int, dim: int, **kw) -> DataFrame:
    questions = cases.select(F.col("irn").alias("query_id"), question_text(*PLACE_FIELDS).alias("text"))
    hits = hits_for(questions, row_chunks(authority), k, dim, **kw).select(F.col("query_id").alias("irn"), F.col("doc_id").alias("expected"), "rk")
    return _hits_at(cases.join(hits, ["irn", "expected"], "left"), k)


def _hits_at(found: DataFrame, k: int) -> DataFrame:
    return found.groupBy("variant").agg(F.count("*").alias("n_probes"), F.count(F.when(F.col("rk") == 1, 1)).alias("n_hit1"),
                                        F.count(F.when(F.col("rk") <= k, 1)).alias("n_hitk"))
