"""Wildcard authority lookup (left outer join where a blank probe field
matches anything), candidate counts, nearest candidate and rendered
candidate lists.

Probe rows carry ``irn`` and the four place fields with blanks already
unified to ''.  Continent, country and state/province match by equality,
county by literal containment (``contains``) or, with ``county='regex'``, as a
regular expression searched in the authority's county (``patterns``).

Plan shape.  One OR-ed join condition would plan as a nested loop, so the
probes are split by their blank mask (which of the four fields are
present).  Each mask becomes an equi-join on the fields it has:

* no county      -> equi-join on the present equality fields;
* county, short  -> the probe county itself is a character n-gram of every
                    matching authority county, so the join key is that gram;
* county, long   -> join on one n-gram of the probe, of 8 characters where
                    the county has them (the rarest one in the authority, so hot grams such as a common prefix do not
                    blow up), then verify ``contains``.

Counts and the default nearest-candidate rule are computed by
pre-aggregating the authority on the join key wherever the key fixes the
answer, so a probe that matches a third of the authority never turns into a
third of the authority in pairs.  Only long-county probes build pairs, and
those feed partial (map-side) aggregates.

Broadcasts.  One small aggregate job (``shapes``) counts the distinct probe
keys of every shape before the plan is built.  Those counts, not planner
estimates, decide which side is broadcast: probe keys into the expanded
authority (so the authority streams in its scan partitions and is never
shuffled) and the per-key stats back to the probes (so a key held by a
third of the probes never lands in one reducer).  Above the limits the
joins shuffle and AQE splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import PLACE_FIELDS
from ..session import checked_broadcast, new_scratch_path, spread
from . import patterns

# Distinct probe keys up to this count are broadcast into the expanded /
# gram-exploded authority; more keys shuffle instead.
KEY_BROADCAST_ROWS = 2_000_000
# The per-key stats table (count + nearest candidate, ~100 bytes a row) is
# broadcast back to the probes up to this many distinct keys.
STATS_BROADCAST_ROWS = 1_000_000
# Probe counties of at least so many characters meet the authority by grams of
# that length: the rarest of them is no more frequent than any gram it holds, so
# the pairs to verify do not grow with the square of the rows.
LONG_GRAM = 8
# Authority rows of a task that returns pairs: each becomes as many rows as
# probes match it, so the tasks follow the rows and not the small table's bytes.
PAIR_TASK_ROWS = 8_192

EQ_FIELDS = ("continent", "country", "state_province")
BITS = {"continent": 1, "country": 2, "state_province": 4, "county": 8}
AUTH_COLS = ("irn_eluts",) + PLACE_FIELDS
PROBE_COLS = ("irn",) + PLACE_FIELDS


def mask_of(prefix: str = "") -> Column:
    """Bit mask of the present (non-blank) place fields."""
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(prefix + f) != "", F.lit(BITS[f])).otherwise(F.lit(0)) for f in PLACE_FIELDS])


def grams(col: Column, n) -> Column:
    """Distinct character n-grams of ``col``; ``n`` may be a Column.  Strings
    shorter than n give none."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_distinct(F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.length(col) - n + 1, F.lit(1))),
                 lambda i: F.length(col) >= n),
        lambda i: col.substr(i, n)))


def _auth(authority: DataFrame, tasks: int | None = None) -> DataFrame:
    """Authority columns prefixed ``a_``.  The authority is the streamed
    side of the broadcast joins below and is multiplied by shapes and grams,
    so a single-split input is spread over the cores first (inputs with
    enough scan splits are left as they are)."""
    return spread(authority.select(*[F.col(c).alias("a_" + c) for c in AUTH_COLS]), tasks)


def _with_kind(df: DataFrame, gram: int) -> DataFrame:
    """``_m``: blank mask; ``_L``: county length capped at ``gram`` (0 = no county)."""
    return df.withColumn("_m", mask_of()).withColumn("_L", F.least(F.length("county"), F.lit(gram)))


class Shapes(NamedTuple):
    """What the probes look like, from one small aggregate job.

    ``keys``: distinct probe keys with ``_m``/``_L``; ``keyed``: the
    (mask, L) shapes answered by the keyed authority; ``has_long``: some
    probe county is at least ``gram`` long; ``n_keyed`` / ``n_long``:
    distinct probe keys of each kind; ``n_long_grams``: upper bound of the
    distinct grams of the long probe counties; ``long_grams``: the gram
    lengths (``gram``, LONG_GRAM) that long probe counties are joined by."""
    keys: DataFrame
    keyed: list
    has_long: bool
    n_keyed: int
    n_long: int
    n_long_grams: int
    long_grams: tuple[int, ...] = ()

    @property
    def has_county(self) -> bool:
        return self.has_long or any(length for _, length in self.keyed)

    def without_county(self) -> Shapes:
        """The shapes that have no county clause (the key counts stay upper bounds)."""
        return self._replace(keys=self.keys.filter(F.col("_L") == 0), keyed=[k for k in self.keyed if not k[1]], has_long=False)


def shapes(probes: DataFrame, gram: int = 3) -> Shapes:
    """Distinct (mask, capped county length) shapes with their key counts:
    at most 15 * gram tiny rows, so collecting them is bounded.  All-blank
    probes (mask 0) match nothing and form no shape."""
    keys = _with_kind(probes.select(*PLACE_FIELDS).distinct(), gram)
    rows = (keys.groupBy("_m", "_L")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.when(F.col("_L") == gram, F.length("county") - gram + 1)).alias("g"),
                 F.count(F.when(F.length("county") >= LONG_GRAM, 1)).alias("far"))
            .collect())
    rows = [r for r in rows if r["_m"]]
    short = [r for r in rows if r["_L"] < gram]
    long_ = [r for r in rows if r["_L"] == gram]
    return Shapes(keys, sorted((r["_m"], r["_L"]) for r in short), bool(long_),
                  sum(r["n"] for r in short), sum(r["n"] for r in long_), sum(r["g"] or 0 for r in long_),
                  _long_grams(sum(r["n"] for r in long_), sum(r["far"] for r in long_), gram))


def _long_grams(n: int, n_far: int, gram: int) -> tuple[int, ...]:
    """Gram lengths for ``n`` long probe keys, ``n_far`` of them with a county of LONG_GRAM characters."""
    if gram >= LONG_GRAM:
        return (gram,) if n else ()
    return (gram,) * (n > n_far) + (LONG_GRAM,) * (n_far > 0)


def _bcast(df: DataFrame, n: int, limit: int) -> DataFrame:
    """Broadcast hint for a side whose row count ``n`` is known (from
    ``shapes``) to be within ``limit``; otherwise leave it to the planner."""
    return F.broadcast(df) if n <= limit else df


def _eq_scores(prefix_probe: str, prefix_auth: str) -> list[Column]:
    return [F.when(F.col(prefix_probe + f) != "",
                   (F.col(prefix_auth + f) == F.col(prefix_probe + f)).cast("double")).otherwise(F.lit(0.0))
            for f in EQ_FIELDS]


def county_score(prefix_probe: str = "", prefix_auth: str = "a_") -> Column:
    """The county's part of ``similarity_score``."""
    p, a = F.lower(F.col(prefix_probe + "county")), F.lower(F.col(prefix_auth + "county"))
    county = F.when(F.col(prefix_probe + "county") != "",
                    F.lit(1.0) - F.levenshtein(p, a) / F.greatest(F.length(p), F.length(a)))
    return F.coalesce(county, F.lit(0.0))


def similarity_score(prefix_probe: str = "", prefix_auth: str = "a_", county: Column | None = None) -> Column:
    """Default nearest-candidate score: one point per present equality field
    that agrees, plus 1 - levenshtein/longer length on lower-cased county
    when the probe has a county.  Blank probe fields score 0.  ``county``: the
    county's part where it is known already."""
    county = county_score(prefix_probe, prefix_auth) if county is None else county
    return reduce(lambda x, y: x + y, [*_eq_scores(prefix_probe, prefix_auth), county])


def _keyed_authority(authority: DataFrame, kinds, tasks: int | None = None) -> DataFrame:
    """Authority rows keyed the way each probe shape sees them.

    For every present shape (mask, L) with L < gram a row is emitted with the
    mask's absent fields set to '' and, for L > 0, one row per distinct
    county L-gram.  A probe of that shape then equi-joins exactly the rows
    it matches: equality on the present fields, and a short county is
    contained in an authority county iff it is one of its L-grams.  This is
    the same Expand a CUBE does, restricted to the shapes in use."""
    a = _auth(authority, tasks)
    shapes_ = [F.struct(F.lit(m).alias("_m"), F.lit(L).alias("_L"),
                        *[(F.col("a_" + f) if m & BITS[f] else F.lit("")).alias(f) for f in EQ_FIELDS])
               for m, L in kinds]
    x = a.withColumn("_k", F.explode(F.array(*shapes_))).select(*a.columns, "_k.*")
    county = F.when(F.col("_L") == 0, F.array(F.lit(""))).otherwise(grams(F.col("a_county"), F.col("_L")))
    return x.withColumn("county", F.explode(county))


def _auth_grams(authority: DataFrame, n: int, tasks: int | None = None) -> DataFrame:
    return _auth(authority, tasks).withColumn("gram", F.explode(grams(F.col("a_county"), n)))


def _long_pairs(sh: Shapes, authority: DataFrame, gram: int, rarest: bool, limit: int, tasks: int | None = None) -> DataFrame:
    """Pairs for probes whose county is at least ``gram`` long: those of at
    least LONG_GRAM characters by grams of that length, the others by
    ``gram``-grams."""
    long_keys = sh.keys.filter(F.col("_L") == gram).drop("_m", "_L")
    far = F.length("county") >= LONG_GRAM
    parts = []
    for n in sh.long_grams:
        keys = long_keys if len(sh.long_grams) == 1 else long_keys.filter(far if n == LONG_GRAM else ~far)
        parts.append(_gram_pairs(keys, sh, authority, n, rarest, limit, tasks))
    return reduce(DataFrame.unionByName, parts)


def _gram_pairs(long_keys: DataFrame, sh: Shapes, authority: DataFrame, gram: int, rarest: bool, limit: int, tasks: int | None = None) -> DataFrame:
    """Pairs of the keys whose county is at least ``gram`` long: join on one
    gram of the probe county (the rarest in the authority, so a gram shared
    by most rows is only used when every gram of the probe is that common),
    with the wildcard equality tests and ``contains`` as join filters.

    Within ``limit`` the long probe keys are broadcast into the
    gram-exploded authority, which then streams through a hash join in its
    scan partitions: no authority shuffle, and a hot gram costs pairs but
    no skewed reducer.  Gram frequencies are only counted for grams some
    probe holds (semi-join before the partial aggregate)."""
    ag = _auth_grams(authority, gram, tasks)
    if rarest:
        pcg = (long_keys.select("county").distinct()
               .withColumn("gram", F.explode(grams(F.col("county"), gram))))
        wanted = _bcast(pcg.select("gram").distinct(), sh.n_long_grams, limit)
        freq = (ag.select("gram").join(wanted, "gram", "left_semi")
                .groupBy("gram").agg(F.count(F.lit(1)).alias("gram_n")))
        pg = (pcg.join(_bcast(freq, sh.n_long_grams, limit), "gram", "left")
              .groupBy("county")
              .agg(F.min_by("gram", F.struct(F.coalesce("gram_n", F.lit(0)), F.col("gram"))).alias("gram")))
        pk = long_keys.join(pg, "county")
    else:
        pk = long_keys.withColumn("gram", F.substring("county", 1, gram))
    ag = ag.withColumnRenamed("gram", "a_gram")
    pk = _bcast(pk, sh.n_long, limit)
    cond = [pk.gram == ag.a_gram, F.contains(ag.a_county, pk.county)] + [
        (pk[f] == "") | (ag["a_" + f] == pk[f]) for f in EQ_FIELDS]
    return ag.join(pk, reduce(lambda x, y: x & y, cond)).drop("gram", "a_gram")


def _regex_pairs(sh: Shapes, authority: DataFrame, limit: int, tasks: int | None = None) -> DataFrame:
    """Pairs for probes whose county is a regular expression: every distinct
    pattern becomes a cover of grams (``patterns.cover``, by the authority's
    own gram counts), keys meet authority rows on these grams, and ``rlike``
    verifies.  A row that holds several grams of a cover is paired at the
    first.  A pattern that requires nothing meets the rows that agree on the
    key's equality fields instead, so every join has a key."""
    keys = sh.keys.filter(F.col("county") != "").drop("_L")
    read = patterns.read_patterns(keys.select(F.col("county").alias("pattern")).distinct())
    path = new_scratch_path(authority.sparkSession, "patterns")
    read.write.parquet(path)  # read three times below
    read = authority.sparkSession.read.schema(read.schema).parquet(path)
    wanted = read.select(F.explode("grams").alias("gram")).distinct()
    a = _auth(authority, tasks)
    lengths = [r[0] for r in wanted.select(F.length("gram")).distinct().collect()]  # at most patterns.GRAM values
    own = F.flatten(F.array(*[grams(F.col("a_county"), n) for n in lengths])) if lengths else F.array().cast("array<string>")
    ag = a.withColumn("a_gram", F.explode(own))
    n_keys = sh.n_keyed + sh.n_long
    freq = (ag.select(F.col("a_gram").alias("gram")).join(checked_broadcast(wanted, limit), "gram", "left_semi")
            .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    held = (read.select("pattern", F.explode("grams").alias("gram")).join(freq, "gram")
            .groupBy("pattern").agg(F.collect_list(F.struct("gram", "n")).alias("held")))  # at most a pattern's own grams
    covers = (read.join(held, "pattern", "left").select(F.col("pattern").alias("county"), "java", patterns.chosen()("tree", "held").alias("cover")))
    pk = keys.join(covers, "county")
    eq = [(F.col(f) == "") | (F.col("a_" + f) == F.col(f)) for f in EQ_FIELDS]
    cols = list(PLACE_FIELDS) + ["a_" + c for c in AUTH_COLS]
    by_gram = pk.select("*", F.posexplode("cover").alias("nth", "gram"))
    first = ~F.exists(F.slice("cover", F.lit(1), F.col("nth")), lambda g: F.contains(F.col("a_county"), g))
    found = (ag.join(_bcast(by_gram, n_keys, limit), F.col("gram") == F.col("a_gram"))
             .filter(reduce(lambda x, y: x & y, [*eq, first, F.expr("rlike(a_county, java)")])).select(*cols))
    free = pk.filter(F.size("cover") == 0).withColumn("_e", F.col("_m") - BITS["county"])
    masks = [r[0] for r in free.select("_e").distinct().collect()]  # at most 8
    if not masks:
        return found
    shape = [F.struct(F.lit(m).alias("_e"), *[(F.col("a_" + f) if m & BITS[f] else F.lit("")).alias(f) for f in EQ_FIELDS]) for m in masks]
    keyed = a.withColumn("_k", F.explode(F.array(*shape))).select(*a.columns, "_k.*")
    rest = keyed.join(_bcast(free, n_keys, limit), ["_e", *EQ_FIELDS]).filter(F.expr("rlike(a_county, java)")).select(*cols)
    return found.unionByName(rest)


def _key_pairs(sh: Shapes, authority: DataFrame, gram: int, rarest: bool, limit: int, county: str = "literal", tasks: int | None = None) -> DataFrame | None:
    """(distinct probe key, matching authority row) pairs: the probe's place
    fields plus ``a_*`` columns.  A key shared by many probes appears once."""
    cols = list(PLACE_FIELDS) + ["a_" + c for c in AUTH_COLS]
    parts = []
    if county == "regex":
        if sh.has_county:
            parts.append(_regex_pairs(sh, authority, limit, tasks))
        sh = sh.without_county()
    if sh.keyed:
        kk = sh.keys.filter(F.col("_L") < gram)
        parts.append(_keyed_authority(authority, sh.keyed, tasks)
                     .join(_bcast(kk, sh.n_keyed, limit), ["_m", "_L", *PLACE_FIELDS]).select(*cols))
    if sh.has_long:
        parts.append(_long_pairs(sh, authority, gram, rarest, limit, tasks).select(*cols))
    return reduce(DataFrame.unionByName, parts) if parts else None


def authority_candidates(probes: DataFrame, authority: DataFrame, gram: int = 3, rarest_gram: bool = True,
                         key_broadcast_rows: int = KEY_BROADCAST_ROWS, county: str = "literal", **_) -> DataFrame:
    """Every (probe, matching authority row) pair.

    The ids of the probes of each key are broadcast to the streamed pairs of
    keys where the probes fit, by their counted size: planner estimates would
    shuffle and sort all pairs from some hundred thousand probes on.

    Output: the probe columns plus ``a_irn_eluts, a_continent, a_country,
    a_state_province, a_county``.  Probes with no match or with every field
    blank give no pair (``match_counts`` is the left-outer view)."""
    probes = probes.select(*PROBE_COLS)
    tasks = max(authority.sparkSession.sparkContext.defaultParallelism, -(-authority.count() // PAIR_TASK_ROWS))
    pairs = _key_pairs(shapes(probes, gram), authority, gram, rarest_gram, key_broadcast_rows, county, tasks)
    if pairs is None:
        # no probe has a present field: an empty result with the pair schema
        a = authority.schema
        return probes.select(*PROBE_COLS, *[F.lit(None).cast(a[c].dataType).alias("a_" + c)
                                            for c in AUTH_COLS]).limit(0)
    out = [*PROBE_COLS, *["a_" + c for c in AUTH_COLS]]
    if checked_broadcast(probes, key_broadcast_rows) is probes:
        return probes.join(pairs, list(PLACE_FIELDS)).select(*out)
    # structs, as a list of bare ids would leave null ones out
    irns = probes.groupBy(*PLACE_FIELDS).agg(F.collect_list(F.struct("irn")).alias("_irns"))
    pairs = pairs.join(F.broadcast(irns), list(PLACE_FIELDS)).withColumn("_one", F.explode("_irns"))
    return pairs.withColumn("irn", F.col("_one.irn")).select(*out)


def _best_struct(score: Column) -> Column:
    cand = F.struct(*[F.col("a_" + c).alias(c) for c in AUTH_COLS], score.alias("score"))
    return F.max_by(cand, F.struct(score, -F.col("a_irn_eluts")))


def _key_stats(sh: Shapes, authority: DataFrame, gram: int, rarest_gram: bool, limit: int, score: Column | None = None,
               county: str = "literal") -> tuple[DataFrame | None, int]:
    """Per distinct probe key: candidate count ``n`` and the best candidate
    ``best`` (max ``score``, ties to the smallest irn_eluts); and the number
    of distinct probe keys, which bounds the rows of that table.

    ``score`` is the nearest-match rule: any Column over the probe's place
    fields and the ``a_*`` authority columns (default ``similarity_score``).
    On the keyed path the key columns are the probe's own fields (blank
    fields are '', a short county is the gram it joined on), so a rule sees
    the same values on both paths.

    Keyed shapes aggregate the authority on the join key before the join
    (the probe's place fields are the key, so the score is known there);
    long-county shapes aggregate their pairs, map-side first."""
    score = similarity_score() if score is None else score
    parts = []
    if county == "regex":
        if sh.has_county:
            parts.append(_regex_pairs(sh, authority, limit).groupBy(*PLACE_FIELDS)
                         .agg(F.count(F.lit(1)).alias("n"), _best_struct(score).alias("best")))
        sh = sh.without_county()
    if sh.keyed:
        # keep only authority keys some probe carries before aggregating:
        # the expanded authority is mostly keys nobody asks for
        kk = sh.keys.filter(F.col("_L") < gram).select("_m", "_L", *PLACE_FIELDS)
        agg = (_keyed_authority(authority, sh.keyed)
               .join(_bcast(kk, sh.n_keyed, limit), ["_m", "_L", *PLACE_FIELDS], "left_semi")
               .groupBy("_m", "_L", *PLACE_FIELDS)
               .agg(F.count(F.lit(1)).alias("n"), _best_struct(score).alias("best")))
        parts.append(agg.select(*PLACE_FIELDS, "n", "best"))
    if sh.has_long:
        pairs = _long_pairs(sh, authority, gram, rarest_gram, limit)
        parts.append(pairs.groupBy(*PLACE_FIELDS)
                     .agg(F.count(F.lit(1)).alias("n"), _best_struct(score).alias("best")))
    return (reduce(DataFrame.unionByName, parts) if parts else None), sh.n_keyed + sh.n_long


def _joined(probes: DataFrame, authority: DataFrame, how: str, kw: dict, cols=("n", "best")):
    """Probes joined to their key stats (``how``), and the stats table (None
    when no probe has a present field).  Within ``stats_broadcast_rows``
    distinct keys the stats are broadcast, so the probe side keeps its
    partitions; beyond it the join shuffles with AQE skew splitting.
    ``carry`` (in ``kw``) names extra probe columns kept through the join;
    ``score`` (in ``kw``) replaces the nearest-match rule and
    ``county='regex'`` reads the probes' counties as patterns."""
    probes = probes.select(*PROBE_COLS, *kw.get("carry", ()))
    gram = kw.get("gram", 3)
    stats, n_keys = _key_stats(shapes(probes, gram), authority, gram, kw.get("rarest_gram", True),
                               kw.get("key_broadcast_rows", KEY_BROADCAST_ROWS), kw.get("score"), kw.get("county", "literal"))
    if stats is None:
        return probes, None
    side = _bcast(stats.select(*PLACE_FIELDS, *cols), n_keys, kw.get("stats_broadcast_rows", STATS_BROADCAST_ROWS))
    return probes.join(side, list(PLACE_FIELDS), how), stats


def match_counts(probes: DataFrame, authority: DataFrame, **kw) -> DataFrame:
    """One row per probe with ``num_authority_matches`` (0, never null)."""
    j, stats = _joined(probes, authority, "left", kw, cols=("n",))
    if stats is None:
        return j.withColumn("num_authority_matches", F.lit(0).cast("bigint"))
    return j.select(*PROBE_COLS, F.coalesce("n", F.lit(0)).cast("bigint").alias("num_authority_matches"))


def matched(probes: DataFrame, authority: DataFrame, **kw) -> DataFrame:
    """Probes with at least one authority match (left semi form)."""
    j, stats = _joined(probes, authority, "left_semi", kw, cols=())
    return j if stats is not None else j.limit(0)


def unmatched(probes: DataFrame, authority: DataFrame, **kw) -> DataFrame:
    """Probes with no authority match, all-blank probes included (left anti form)."""
    return _joined(probes, authority, "left_anti", kw, cols=())[0]


def probe_stats(probes: DataFrame, authority: DataFrame, **kw) -> DataFrame:
    """Left-outer view per probe: ``num_authority_matches`` and ``best``
    (struct of the nearest candidate, null when there is none), from one
    pass over the authority.  ``carry=(...)`` keeps extra probe columns."""
    j, stats = _joined(probes, authority, "left", kw)
    keep = [*PROBE_COLS, *kw.get("carry", ())]
    if stats is None:
        return j.select(*keep, F.lit(0).cast("bigint").alias("num_authority_matches"), F.lit(None).alias("best"))
    return j.select(*keep, F.coalesce("n", F.lit(0)).cast("bigint").alias("num_authority_matches"), "best")


def nearest_candidates(probes: DataFrame, authority: DataFrame, with_count: bool = False, **kw) -> DataFrame:
    """The nearest authority row of each matched probe under
    ``similarity_score``; probes without a match are left out.

    Output: probe columns + ``irn_eluts, a_continent, a_country,
    a_state_province, a_county, score`` (+ ``num_authority_matches``)."""
    out, stats = _joined(probes, authority, "inner", kw)
    if stats is None:
        return out.limit(0)
    extra = [F.col("n").alias("num_authority_matches")] if with_count else []
    return out.select(*PROBE_COLS, F.col("best.irn_eluts").alias("irn_eluts"),
                      *[F.col("best." + f).alias("a_" + f) for f in PLACE_FIELDS],
                      F.col("best.score").alias("score"), *extra)


# Rendered lists are broadcast up to this many bytes, at this many per candidate
# (the place names of the authority are far shorter); beyond it they shuffle.
LIST_BROADCAST_BYTES, CANDIDATE_BYTES = 128 << 20, 400


def candidate_lists(probes: DataFrame, authority: DataFrame, cap: int, gram: int = 3,
                    rarest_gram: bool = True, key_broadcast_rows: int = KEY_BROADCAST_ROWS,
                    stats_broadcast_rows: int = STATS_BROADCAST_ROWS, score: Column | None = None) -> DataFrame:
    """Rendered prompt context per probe: the best ``cap`` candidates by score
    (then irn_eluts) as a JSON array, the exact total and a flag.  The limit is
    the caller's choice; ``candidate_pages`` gives every candidate.

    The list depends only on the probe's place fields, so it is ranked and
    rendered once per distinct probe key: the per-key limit runs as a window
    group limit that is also applied before the shuffle, so a key matching a
    third of the authority ships at most ``cap`` rows per map partition, and
    probes sharing a key are never multiplied by its candidates.  Counts come
    from the pre-aggregated key stats (exact); only the rendered list is
    bounded (it is prompt text).  The per-key table (one row per distinct key)
    is joined back to the probes, broadcast within ``stats_broadcast_rows``."""
    probes = probes.select(*PROBE_COLS)
    sh = shapes(probes, gram)
    out_cols = [*PROBE_COLS, "num_authority_matches", "candidates", "candidates_truncated"]
    pairs = _key_pairs(sh, authority, gram, rarest_gram, key_broadcast_rows)
    if pairs is None:
        return probes.select(*PROBE_COLS, F.lit(0).cast("bigint").alias("num_authority_matches"),
                             F.lit("[]").alias("candidates"), F.lit(False).alias("candidates_truncated"))
    lists = _ranked(pairs, cap, score).groupBy(*PLACE_FIELDS).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(
            "rk", F.struct(F.col("a_irn_eluts").cast("string").alias("irn_eluts"),
                           *[F.col("a_" + f).alias(f) for f in PLACE_FIELDS])
            .alias("c")))), lambda x: x["c"])).alias("candidates"))
    stats, n_keys = _key_stats(sh, authority, gram, rarest_gram, key_broadcast_rows, score)
    per_key = stats.select(*PLACE_FIELDS, "n").join(lists, list(PLACE_FIELDS), "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return (probes.join(_bcast(per_key, n_keys, min(stats_broadcast_rows, LIST_BROADCAST_BYTES // (cap * CANDIDATE_BYTES))), list(PLACE_FIELDS), "left")
            .select(*PROBE_COLS, n.alias("num_authority_matches"),
                    F.coalesce("candidates", F.lit("[]")).alias("candidates"),
                    (n > cap).alias("candidates_truncated"))
            .select(*out_cols))


def _ranked(pairs: DataFrame, k: int, score: Column | None) -> DataFrame:
    """The k best candidates of each distinct probe key, with rank ``rk``; the
    window group limit also runs before the shuffle."""
    pairs = pairs.withColumn("score", F.round(similarity_score() if score is None else score, 6))
    w = Window.partitionBy(*PLACE_FIELDS).orderBy(F.col("score").desc(), F.col("a_irn_eluts"))
    return pairs.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)


def top_candidates(probes: DataFrame, authority: DataFrame, k: int, gram: int = 3, rarest_gram: bool = True,
                   key_broadcast_rows: int = KEY_BROADCAST_ROWS, score: Column | None = None) -> DataFrame:
    """Place fields, a_irn_eluts, score, rk (1 to k) per distinct probe key."""
    pairs = _key_pairs(shapes(probes.select(*PROBE_COLS), gram), authority, gram, rarest_gram, key_broadcast_rows)
    if pairs is None:
        empty = "a_irn_eluts bigint, score double, rk int"
        return probes.sparkSession.createDataFrame([], ", ".join(f"{f} string" for f in PLACE_FIELDS) + ", " + empty)
    return _ranked(pairs, k, score).select(*PLACE_FIELDS, "a_irn_eluts", "score", "rk")


def candidate_pages(probes: DataFrame, authority: DataFrame, page_size: int = 60, gram: int = 3,
                    rarest_gram: bool = True, key_broadcast_rows: int = KEY_BROADCAST_ROWS) -> DataFrame:
    """Every candidate of every distinct probe key, in pages: place fields,
    page, pages, candidates (sorted by irn_eluts).  A key with n candidates
    has ceil(n / page_size) pages and a candidate's page is its id modulo that
    number, so no key collects into one row and none needs a global rank.
    Probes link to their pages by the place fields."""
    sh = shapes(probes.select(*PROBE_COLS), gram)
    pairs = _key_pairs(sh, authority, gram, rarest_gram, key_broadcast_rows)
    if pairs is None:
        empty = "page bigint, pages bigint, candidates array<bigint>"
        return probes.sparkSession.createDataFrame([], ", ".join(f"{f} string" for f in PLACE_FIELDS) + ", " + empty)
    stats, _ = _key_stats(sh, authority, gram, rarest_gram, key_broadcast_rows, None)
    sizes = stats.select(*PLACE_FIELDS, F.ceil(F.col("n") / page_size).cast("bigint").alias("pages"))
    paged = pairs.select(*PLACE_FIELDS, "a_irn_eluts").join(sizes, list(PLACE_FIELDS))
    paged = paged.withColumn("page", F.pmod(F.col("a_irn_eluts"), F.col("pages")))
    return paged.groupBy(*PLACE_FIELDS, "page", "pages").agg(F.sort_array(F.collect_list("a_irn_eluts")).alias("candidates"))
