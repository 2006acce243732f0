"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are majority votes over shingle hashes.  For a radius r every
bit gets a vector over r + 1 bits, and each non-zero vector v gives a table
whose mask holds the bits whose vector is not orthogonal to v.  The vectors of
up to r differing bits leave some v orthogonal to all of them, so two
fingerprints within the radius agree on that table's mask: no link is missed.

Distinct fingerprints, not documents, enter the tables.  A bucket with more
than ``CELL`` of them is dealt into blocks whose pairs meet in cells of at
most two blocks, so no task holds an unbounded bucket and no link is lost;
inside a cell only the links that connect it leave the task.

Defined results: a null text or one without words has fingerprint zero, which
is linked like any other; a very long text is read whole by one task; repeated
rows share one fingerprint; a row without
doc_id gets its fingerprint, links nothing and has no component; other columns
are ignored by ``near_duplicates`` and carried by ``one_per_group``; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, pick, positional, released
from tessera.llm.components import components

BITS, SHINGLE, RADIUS, SEED = 64, 4, 4, 42
CELL = 4096  # fingerprints per block of a large bucket
SHORT_RUN = 48  # buckets up to this size are compared with array shifts
CHUNK = 1 << 17  # rows compared together
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the XXH64 values of all word shingles, as unsigned 64 bits."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()  # bytes: A-Z only; space and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size)
    n = max(1, len(words) - shingle + 1)
    lo, hi = (end - size)[:n].tolist(), (end[len(words) - n:] - 1).tolist()
    votes = np.zeros((8, 256), np.int64)
    for at in range(0, n, 1 << 18):
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(lo[at:at + (1 << 18)], hi[at:at + (1 << 18)], strict=True)], np.uint64)
        votes += np.bincount((h.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
    bits = (votes @ BYTE_BITS).ravel() * 2 > n  # bit 8 * byte + position, little-endian
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary()).fill_null(b"")
            fp = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
    return run


def masks(radius: int, bits: int = BITS) -> list[int]:
    """The covering masks as signed 64-bit numbers, 2^(radius+1) - 1 of them."""
    n = 1 << (radius + 1)
    vector = [i % (n - 1) + 1 for i in range(bits)]
    out = [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, n)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of 0..n-1 under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _links_of_run(fp: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect what lies within the radius in one large cell: a
    search that compares each member with those not reached yet."""
    rest, a, b = np.arange(1, len(fp)), [], []
    todo = [0]
    while len(rest):
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
            continue
        x = todo.pop()
        near = np.bitwise_count(fp[rest] ^ fp[x]) <= radius
        hits = rest[near].tolist()
        rest = rest[~near]
        a += [x] * len(hits)
        b += hits
        todo += hits
    return a, b


def _links(radius: int):
    """Rows sorted by cell -> (a, b) links, b the smallest node reached among
    the rows compared together."""
    def compare(run_id: np.ndarray, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.concatenate([[True], run_id[1:] != run_id[:-1], [True]]))
        size = np.diff(edge)
        a, b = [], []
        for at, n in zip(edge[:-1][size > SHORT_RUN].tolist(), size[size > SHORT_RUN].tolist(), strict=True):
            x, y = _links_of_run(fp[at:at + n], radius)
            a.append(np.array(x, np.int64) + at)
            b.append(np.array(y, np.int64) + at)
        left = np.repeat(edge[1:], size) - np.arange(len(fp)) - 1  # rows behind this one in its run
        left[np.repeat(size > SHORT_RUN, size)] = 0
        step, i = 1, np.flatnonzero(left >= 1)
        while len(i):
            near = np.bitwise_count(fp[i] ^ fp[i + step]) <= radius
            a.append(i[near])
            b.append(i[near] + step)
            step += 1
            i = i[left[i] >= step]
        ids, at = np.unique(node, return_inverse=True)
        x, y = (at[np.concatenate(v)] if v else np.zeros(0, np.int64) for v in (a, b))
        root = _roots(x, y, len(ids))
        some = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for b in batches:
            held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(6)])
            rows += b.num_rows
            if rows < CHUNK:
                continue
            t = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = np.ones(rows, bool)  # the last cell may go on in the next batch
            for c in t[:4]:
                last &= c == c[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            held, rows = [[c[cut:] for c in t]], rows - cut
            if cut:
                yield compare(*_numbered([c[:cut] for c in t]))
        if rows:
            yield compare(*_numbered([np.concatenate(x) for x in zip(*held, strict=True)]))

    def _numbered(t):
        change = np.zeros(len(t[0]), bool)
        for c in t[:4]:
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change), t[4].view(np.uint64), t[5]
    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links that connect all nodes (fp, node) within the radius."""
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(radius))])
    rows = nodes.select("fp", "node", F.explode(tables).alias("x")).select("x.t", "x.key", "fp", "node")
    large = materialize(rows.groupBy("t", "key").count().filter(F.col("count") > CELL)
                        .select("t", "key", F.ceil(F.col("count") / CELL).cast("int").alias("blocks")), "large-buckets")
    # a bucket above CELL is named once; its blocks meet pairwise
    dealt = rows.join(large, ["t", "key"], "left").withColumn("own", F.expr("pmod(xxhash64(fp, t), coalesce(blocks, 1))").cast("int"))
    pair = F.struct(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    single = dealt.filter("blocks IS NULL").selectExpr("t", "key", "0 AS i", "0 AS j", "fp", "node")
    several = dealt.filter("blocks IS NOT NULL").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).filter("own <> other")
    several = several.withColumn("p", pair).selectExpr("t", "key", "p.i AS i", "p.j AS j", "fp", "node")
    cells = single.unionByName(several) if not large.isEmpty() else rows.selectExpr("t", "key", "0 AS i", "0 AS j", "fp", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(parts, "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return cells.mapInArrow(released(_links(radius)), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that
    links reach)."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    prints = materialize(d.mapInArrow(released(_fingerprints(shingle)), "doc_id long, fp long"), "fingerprints")
    nodes = materialize(prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    roots = components(links(nodes, radius))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    out = prints.join(named, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the
    smallest doc_id (rows without an id stay); all columns unchanged."""
    names, rows = docs.columns, positional(docs)
    gone = near_duplicates(docs, shingle, radius).filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    kept = rows.join(gone, F.col(f"_c{names.index('doc_id')}").cast("long") == F.col("_gone"), "left_anti")
    return kept.toDF(*names)
