"""A prepared authority: everything the wildcard join derives from the
authority alone, written once, versioned, and read by every later batch.

* ``keyed``: the authority expanded to every shape a probe without a long
  county can have (each set of equality fields, each county of fewer than GRAM
  characters) and aggregated per key to the count and the nearest candidate;
* ``grams``: its rows by the GRAM-grams of their counties;
* ``counts``: rows per gram.

The tables are bucketed and sorted by their key.  A batch then costs its own
keys: with at most PRUNE_KEYS distinct keys only their buckets are read and the
keys are broadcast; with more, both sides meet bucket by bucket and the tables
are not shuffled.  Nothing of the authority is expanded, exploded or counted
again.  ``probe_stats`` gives the rows of ``authority.probe_stats`` with the
default score.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PLACE_FIELDS
from ..sinks.pointers import commit, current
from . import authority as A

GRAM = 3
BUCKET_ROWS, MAX_BUCKETS = 250_000, 4_096
PRUNE_KEYS = 2_000
KEY = ("_m", "_L", *PLACE_FIELDS)


def probe_key() -> Column:
    """The key columns as one string (each field behind its length, so no two
    keys look alike): one column to bucket, prune and join by."""
    return F.concat_ws("|", "_m", "_L", *[F.concat(F.length(f).cast("string"), F.lit(":"), F.col(f)) for f in PLACE_FIELDS])


class Prepared(NamedTuple):
    version: int
    keyed: DataFrame
    grams: DataFrame
    counts: DataFrame


def _keyed(authority: DataFrame) -> DataFrame:
    """Per key that a probe without a long county can have: its rows and the
    nearest candidate.

    A row is expanded to its counties (none, and its grams below GRAM) only, and
    rows that agree on the equality fields, county and county score become one
    with their count and smallest irn.  All that is summed is a number, so this
    is a hash aggregate before the shuffle and nothing expanded is sorted.  Blank
    masks multiply these few groups, and the candidate's county is read back
    from the authority, once per key."""
    a, eq = A._auth(authority), ["a_" + f for f in A.EQ_FIELDS]

    def held_grams(n: int) -> Column:
        return F.transform(A.grams(F.col("a_county"), n), lambda g: F.struct(F.lit(n).alias("_L"), g.alias("county")))

    counties = [F.array(F.struct(F.lit(0).alias("_L"), F.lit("").alias("county"))), *[held_grams(n) for n in range(1, GRAM)]]
    x = a.withColumn("_c", F.explode(F.concat(*counties))).select(*a.columns, "_c.*")
    same = (x.withColumn("_s", A.county_score()).groupBy(*eq, "_L", "county", "_s")
            .agg(F.count(F.lit(1)).alias("n"), F.min("a_irn_eluts").alias("a_irn_eluts")))

    def masks(some) -> Column:
        return F.array(*[F.struct(F.lit(m).alias("_m"), *[(F.col("a_" + f) if m & A.BITS[f] else F.lit("")).alias(f) for f in A.EQ_FIELDS]) for m in some])

    county = A.BITS["county"]
    keys = same.withColumn("_k", F.explode(F.when(F.col("_L") == 0, masks(range(1, county))).otherwise(masks(range(county, 2 * county)))))
    score = A.similarity_score(county=F.col("_s"))
    top = F.struct("a_irn_eluts", *eq, "_s", score.alias("score"))
    stats = (keys.select(*same.columns, "_k.*").groupBy(*KEY)
             .agg(F.sum("n").alias("n"), F.max_by(top, F.struct(score, -F.col("a_irn_eluts"))).alias("top")))
    rows = authority.select(F.col("county").alias("a_county"), *[F.col(f).alias("r_" + f) for f in ("irn_eluts", *A.EQ_FIELDS)])
    held = (F.col("_L") == 0) | (F.contains(F.col("a_county"), F.col("county")) & (A.county_score() == F.col("top._s")))
    found = stats.join(rows, reduce(lambda p, q: p & q, [F.col("top.a_" + f).eqNullSafe(F.col("r_" + f)) for f in ("irn_eluts", *A.EQ_FIELDS)])).filter(held)
    best = F.struct(*[F.col("top.a_" + f).alias(f) for f in ("irn_eluts", *A.EQ_FIELDS)], F.col("a_county").alias("county"), F.col("top.score").alias("score"))
    return (found.groupBy(*KEY, "n", "top").agg(F.min("a_county").alias("a_county"))  # rows may share an irn
            .select(probe_key().alias("k"), "n", best.alias("best")))


def _write(df: DataFrame, path: str, name: str, key: str, buckets: int) -> dict:
    """Tasks take ranges of (bucket, row), so a gram that every county holds
    is written by several tasks, as several files of its bucket."""
    dealt = df.repartitionByRange(buckets, F.pmod(F.hash(key), F.lit(buckets)), F.xxhash64(*df.columns))
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return {"name": name, "path": path, "key": key, "buckets": buckets, "schema": df._jdf.schema().toDDL()}


def _open(spark: SparkSession, t: dict) -> DataFrame:
    """The table of a version; a session that did not write it registers it."""
    if not spark.catalog.tableExists(t["name"]):
        path = t["path"].replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {t['name']} ({t['schema']}) USING parquet CLUSTERED BY ({t['key']}) SORTED BY ({t['key']}) "
                  f"INTO {t['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(t["name"])


def prepare(authority: DataFrame, root: str, buckets: int | None = None) -> int:
    """Write a new version under ``root`` and make it current; its number."""
    spark = authority.sparkSession
    mark = uuid.uuid4().hex[:12]
    folder = os.path.join(root, f"v-{mark}")
    rows = authority.count()
    n = buckets or min(MAX_BUCKETS, max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS)))
    keyed = _keyed(authority)
    grams = A._auth_grams(authority, GRAM)
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("gram_n"))
    tables = {kind: _write(df, os.path.join(folder, kind), f"tessera_{kind}_{mark}", key, n)
              for kind, df, key in (("keyed", keyed, "k"), ("grams", grams, "gram"), ("counts", counts, "gram"))}
    return commit(spark, root, "PREPARED", json.dumps(tables))


def open_prepared(spark: SparkSession, root: str) -> Prepared:
    """The current version: a batch that opens it sees a new one at once."""
    version, tables = current(spark, root, "PREPARED")
    if not version:
        raise ValueError(f"no prepared authority at {root}")
    return Prepared(version, *(_open(spark, tables[kind]) for kind in ("keyed", "grams", "counts")))


def _only(table: DataFrame, column: str, wanted: DataFrame, few: bool) -> DataFrame:
    """The buckets of the wanted keys, when they are few enough to name."""
    if not few:
        return table
    return table.filter(F.col(column).isin([r[0] for r in wanted.select(column).distinct().collect()]))  # at most a few PRUNE_KEYS values


def key_stats(sh: A.Shapes, prepared: Prepared, prune_keys: int = PRUNE_KEYS) -> DataFrame:
    """Per distinct probe key its count ``n`` and nearest candidate ``best``."""
    def side(df: DataFrame, few: bool) -> DataFrame:
        return F.broadcast(df) if few else df

    few = sh.n_keyed <= prune_keys
    short = sh.keys.filter((F.col("_m") > 0) & (F.col("_L") < GRAM)).select(probe_key().alias("k"), *PLACE_FIELDS)
    keyed = _only(prepared.keyed, "k", short, few)
    parts = [keyed.join(side(short, few), "k").select(*PLACE_FIELDS, "n", "best")]
    if sh.has_long:
        few = sh.n_long_grams <= prune_keys
        long = sh.keys.filter(F.col("_L") == GRAM).drop("_m", "_L")
        own = long.select("county").distinct().withColumn("gram", F.explode(A.grams(F.col("county"), GRAM)))
        counted = side(own, few).join(_only(prepared.counts, "gram", own, few), "gram", "left") if not few else \
            own.join(F.broadcast(_only(prepared.counts, "gram", own, few)), "gram", "left")
        rarest = counted.groupBy("county").agg(F.min_by("gram", F.struct(F.coalesce("gram_n", F.lit(0)), F.col("gram"))).alias("gram"))
        pk = long.join(rarest, "county")
        rows = _only(prepared.grams, "gram", pk, few)
        found = rows.join(side(pk, few), "gram").filter(reduce(lambda x, y: x & y, [
            F.contains(F.col("a_county"), F.col("county")), *[(F.col(f) == "") | (F.col("a_" + f) == F.col(f)) for f in A.EQ_FIELDS]]))
        parts.append(found.groupBy(*PLACE_FIELDS).agg(F.count(F.lit(1)).alias("n"), A._best_struct(A.similarity_score()).alias("best")))
    return reduce(DataFrame.unionByName, parts)


def probe_stats(probes: DataFrame, prepared: Prepared, prune_keys: int = PRUNE_KEYS, stats_broadcast_rows: int = A.STATS_BROADCAST_ROWS) -> DataFrame:
    """Per probe ``num_authority_matches`` and ``best``, as
    ``authority.probe_stats`` gives them."""
    probes = probes.select(*A.PROBE_COLS)
    sh = A.shapes(probes, GRAM)
    stats = A._bcast(key_stats(sh, prepared, prune_keys), sh.n_keyed + sh.n_long, stats_broadcast_rows)
    joined = probes.join(stats, list(PLACE_FIELDS), "left")
    return joined.select(*A.PROBE_COLS, F.coalesce("n", F.lit(0)).cast("bigint").alias("num_authority_matches"), "best")
