"""Session, table loading and size-checked helpers shared by every module."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Largest row count we ever hand to F.broadcast() on our own; Spark's
# autoBroadcastJoinThreshold still applies to everything else.
DEFAULT_BROADCAST_ROWS = 1_000_000


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    On a cluster pass ``master=None`` and let spark-submit decide; AQE is
    always on so shuffle partition counts and skewed joins are re-planned
    at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.ansi.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; only when it is unset and the
    master is local (one machine, as in tests) a fresh folder is registered.
    On a cluster without the setting this raises: a folder of one machine
    would lose data there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
        d = os.path.join(local, f"tessera-scratch-{uuid.uuid4().hex[:12]}")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A never-reused sub path of the shared scratch folder."""
    path = os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if (made := _scope.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the scratch tables that were made inside it, by this
    thread, also when it fails.  For a job that writes its result: a DataFrame
    that reads such a table cannot be used afterwards.  An inner scope removes
    its own tables only.

        with scratch_scope(spark):
            corpus_pipeline.run(spark, tables).write.parquet(out)
    """
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy DataFrame, listed anew on every call: a table
    that was rewritten in the same session is read as it is now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``limit(max_rows + 1)`` stops the scan early, so the check costs at most
    max_rows + 1 rows no matter how large the input is.
    """
    return df.limit(max_rows + 1).count() <= max_rows


MAX_BROADCAST_BYTES = 256 << 20


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a check of rows and of their size as text;
    otherwise leave the join to the planner (sort-merge / shuffled hash with
    AQE skew handling)."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])))
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).first()
    return F.broadcast(df) if seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes else df


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (never a
    local checkpoint: executors can be lost)."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


SPREAD_BYTES = 16 << 20  # planned bytes per core below which an input is dealt out


def scan_bytes(df: DataFrame) -> int:
    """Planned size of the largest relation that ``df`` reads.  The estimate of
    a whole plan multiplies the sizes of joined tables; the partitions of a
    chain of broadcast joins are those of its largest scan."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)


def spread(df: DataFrame, target: int | None = None) -> DataFrame:
    """Round-robin repartition before CPU-heavy narrow work, but only where
    the largest relation read is small (below SPREAD_BYTES per core): one file
    of that size is a single scan split, and so is a view of joins over it.
    Larger inputs have enough splits and are never shuffled here, however many
    files they are stored in.  The sizes are those of the catalog, so the check
    runs no job and lists nothing."""
    target = target or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if scan_bytes(df) < target * SPREAD_BYTES else df


def dealt(df: DataFrame) -> DataFrame:
    """Round-robin into one task per SPREAD_BYTES of the largest relation read,
    one per core at least, however the input is stored: a file of one row group
    is read by one task whatever its size.  For work that costs far more than a
    shuffle of its rows."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-scan_bytes(df) // SPREAD_BYTES)))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package whatever the working directory
    is.  On a cluster whose machines do not have the folder, submit the
    package with ``--py-files`` as well (README, Running)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])
