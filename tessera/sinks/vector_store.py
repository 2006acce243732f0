"""An updatable vector table: snapshots over immutable parts.

A *part* holds the chunks and vectors of the documents embedded in one run; a
*document table* names, for every live document, its content digest and the
part that holds it; a *snapshot* (a numbered pointer) names the document table,
the parts and the embedder.  ``update`` compares the digests of the documents
with those of the current snapshot and embeds only new and changed ones; a
document that is gone, or was embedded again, leaves its old rows behind as
dead rows, which readers drop by a semi-join with the document table (parts
without dead rows are read as they are).  ``compact`` copies the live rows of
parts that are small or mostly dead into one new part; vectors are moved,
never computed again.  Earlier snapshots stay readable by number; ``unused``
lists the folders that the last snapshots no longer need, for the owner to
delete.

Rows that share a doc_id are one document: its digest covers all of them,
copies and order apart.  A null doc_id is a document of its own.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pointers import commit, current, pointers

NAME = "SNAPSHOT"


def document_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) per document: sums of two halves of each row's SHA-256
    and the number of rows, so the order of rows does not matter and equal rows
    do not cancel."""
    content = F.sha2(F.to_json(F.struct("source", "text"), {"ignoreNullFields": "false"}), 256)
    half = [F.conv(F.substring(content, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
    sums = docs.select("doc_id", *[h.alias(f"h{i}") for i, h in enumerate(half)]).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))
    return sums.select("doc_id", F.concat_ws("-", "n", "h0", "h1").alias("digest"))


def _folder(root: str, kind: str) -> str:
    return os.path.join(root, f"{kind}-{uuid.uuid4().hex[:12]}")


def _snapshot(spark: SparkSession, root: str, embedder: str, number: int | None = None) -> tuple[int, dict]:
    if number is None:
        number, snap = current(spark, root, NAME)
    else:
        snap = json.loads(dict(pointers(spark, root, NAME)).get(number, "{}"))
    if snap and snap["embedder"] != embedder:
        raise ValueError(f"vector table at {root} was built with {snap['embedder']}, not {embedder}")
    return number, snap


def _save_documents(table: DataFrame, root: str) -> tuple[str, dict]:
    """Write the document table; its path and the live documents per part."""
    path = _folder(root, "documents")
    table.write.mode("error").parquet(path)
    return path, {r.part: r["count"] for r in table.sparkSession.read.parquet(path).groupBy("part").count().collect()}  # one row a part


def _commit(spark: SparkSession, root: str, number: int, embedder: str, documents: str, live: dict, built: dict) -> int:
    parts = {p: {"live": n, "built": built[p]} for p, n in live.items()}
    return commit(spark, root, NAME, json.dumps({"embedder": embedder, "documents": documents, "parts": parts}), number + 1)


def update(docs: DataFrame, root: str, chunk: Callable[[DataFrame], DataFrame], embed: Callable[[DataFrame], DataFrame], embedder: str) -> dict:
    """Bring the table under ``root`` to the state of ``docs`` (doc_id, source,
    text).  ``chunk`` turns documents into chunk rows that keep doc_id,
    ``embed`` adds the vectors.  Returns the snapshot's number and how many
    documents were embedded, kept and dropped.  Another update of the same
    snapshot that committed first makes this one fail."""
    spark = docs.sparkSession
    number, snap = _snapshot(spark, root, embedder)
    docs = docs.select("doc_id", "source", "text")
    now, part = document_digests(docs), os.path.basename(_folder(root, "part"))
    if snap:
        old = spark.read.parquet(snap["documents"]).toDF("_id", "_digest", "_part")
        joined = now.join(old, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
        now = joined.select("doc_id", "digest", F.coalesce("_part", F.lit(part)).alias("part"))
    else:
        now = now.withColumn("part", F.lit(part))
    documents, live = _save_documents(now, root)
    before = sum(p["live"] for p in snap["parts"].values()) if snap else 0
    built = {p: v["built"] for p, v in snap["parts"].items()} if snap else {}
    fresh = live.get(part, 0)
    if fresh:
        wanted = spark.read.parquet(documents).filter(F.col("part") == part).select(F.col("doc_id").alias("_id"))
        changed = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi") if snap else docs
        embed(chunk(changed)).write.mode("error").parquet(os.path.join(root, part))
        built[part] = fresh
    kept = sum(live.values()) - fresh
    number = _commit(spark, root, number, embedder, documents, live, built)
    return {"snapshot": number, "embedded": fresh, "kept": kept, "dropped": before - kept}


def read(spark: SparkSession, root: str, embedder: str, number: int | None = None) -> DataFrame:
    """Live chunk rows of the current snapshot (or of ``number``); refused
    when another embedder built them."""
    number, snap = _snapshot(spark, root, embedder, number)
    if not snap:
        raise ValueError(f"no snapshot {number or ''} at {root}")
    return _rows(spark, root, snap, list(snap["parts"]))


def _rows(spark: SparkSession, root: str, snap: dict, names: list[str]) -> DataFrame:
    """Live rows of the named parts.  Parts without dead documents need no join."""
    whole = [p for p in names if snap["parts"][p]["live"] == snap["parts"][p]["built"]]
    frames = [spark.read.parquet(*[os.path.join(root, p) for p in whole])] if whole else []
    live = spark.read.parquet(snap["documents"]).select(F.col("doc_id").alias("_id"), "part")
    for p in sorted(set(names) - set(whole)):
        own = live.filter(F.col("part") == p).select("_id")
        frames.append(spark.read.parquet(os.path.join(root, p)).join(own, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"))
    if not frames:
        raise ValueError(f"the snapshot at {root} holds no documents")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def compact(spark: SparkSession, root: str, embedder: str, min_live: float = 0.7, small: float = 0.1) -> int:
    """Copy the live rows of parts below ``min_live`` of their documents, or
    holding less than ``small`` of all, into one new part (when there are two
    such parts or one with dead rows); returns the parts replaced."""
    number, snap = _snapshot(spark, root, embedder)
    if not snap:
        return 0
    total = sum(p["live"] for p in snap["parts"].values())
    names = [n for n, p in snap["parts"].items() if p["live"] < min_live * p["built"] or p["live"] < small * total]
    if not names or (len(names) == 1 and snap["parts"][names[0]]["live"] == snap["parts"][names[0]]["built"]):
        return 0
    part = os.path.basename(_folder(root, "part"))
    _rows(spark, root, snap, names).write.mode("error").parquet(os.path.join(root, part))
    table = spark.read.parquet(snap["documents"])
    documents, live = _save_documents(table.withColumn("part", F.when(F.col("part").isin(names), F.lit(part)).otherwise(F.col("part"))), root)
    built = {p: v["built"] for p, v in snap["parts"].items()} | {part: live[part]}
    _commit(spark, root, number, embedder, documents, live, built)
    return len(names)


def unused(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Folders that the last ``keep`` snapshots do not need."""
    snaps = [json.loads(line) for _, line in pointers(spark, root, NAME)]
    folders = [{s["documents"], *(os.path.join(root, p) for p in s["parts"])} for s in snaps]
    needed = set().union(*folders[-keep:]) if folders else set()
    return sorted(set().union(*folders) - needed) if folders else []
