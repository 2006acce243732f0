"""Secret scan: fixed patterns plus character Markov models.

The fixed patterns find assignments, access keys and long hex runs.  Their
values are the labelled random strings, all other token characters of the
corpus the labelled ordinary identifiers; first-order character chains of both
are counted over every document in one pass (a table of at most 2 x 66 x 66
counts, whatever the input).  A second pass scores each long token by the
log-likelihood ratio of the two chains and adds those above the threshold as
``random`` spans; spans of the fixed patterns always stay.

Defined results: a null or empty text has no spans; spans are code points, end
exclusive, by start, then kind as listed in ``KINDS``; a ``random`` span is a
whole token that base spans do not cover wholly, so it can overlap those that
cover a part; a very long text is scanned whole by one task;
repeated rows and null ids are scanned like any other row; other
columns are ignored by ``scan`` and carried by ``redact``; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pick, positional, released

KINDS = ("assign", "access", "hex", "random")
# The base patterns and lengths of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is a whole match of [0-9a-f]+
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
# Texts that can hold a base match (RE2, linear time).
BASE_HINT = r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=]|AKIA[A-Z0-9]|[0-9a-f]{16}"""

TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_TOKEN = 20  # shortest token the chains judge
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
# Nats: mean per character and in all.  e^20 : 1 outweighs any prior of a
# random token among the tokens of a document.
MIN_MEAN, MIN_TOTAL = 0.8, 20.0

SIZE = len(TOKEN_CHARS) + 1  # state 0: outside a token
STATE = np.zeros(256, np.int16)
STATE[np.frombuffer(TOKEN_CHARS.encode(), np.uint8)] = np.arange(1, SIZE)


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, kind number, kind, end, value start) of the fixed patterns."""
    out = [(m.start(), 0, "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    out += [(m.start(), 1, "access", m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), 2, "hex", m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _transitions(data: bytes | np.ndarray) -> np.ndarray:
    """Counts of (state, next state) with a next state inside a token."""
    s = STATE[np.frombuffer(data, np.uint8)].astype(np.int32)
    pair = np.empty(len(s), np.int32)
    pair[:1] = s[:1]
    pair[1:] = s[:-1] * SIZE + s[1:]
    return np.bincount(pair[s > 0], minlength=SIZE * SIZE)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, labelled = np.zeros(SIZE * SIZE, np.int64), np.zeros(SIZE * SIZE, np.int64)
    for b in batches:
        texts = b.column(0).cast(pa.large_string()).fill_null("")
        for t in texts.cast(pa.large_binary()):
            data = t.as_buffer()
            for at in range(0, len(data), 1 << 24):  # a token cut here starts anew
                total += _transitions(data[at:at + (1 << 24)])
        for t in texts.filter(pc.match_substring_regex(texts, BASE_HINT)).to_pylist():
            values = {(s[4], s[3]) for s in base_spans(t)}
            if values:
                labelled += _transitions(" ".join(t[a:e] for a, e in values).encode())
    for label, n in (("random", labelled), ("ordinary", np.maximum(total - labelled, 0))):
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(k), pa.string()), pa.array(k.astype(np.int32)), pa.array(n[k])], ["label", "pair", "n"])


@dataclass(frozen=True)
class Chains:
    """Log-likelihood ratio, random against ordinary, of every transition."""
    ratio: np.ndarray

    def score(self, token: str) -> float:
        s = STATE[np.frombuffer(token.encode(), np.uint8)]
        return float(self.ratio[np.concatenate([[0], s[:-1]]), s].sum())

    def is_random(self, token: str) -> bool:
        x = self.score(token)
        return x >= MIN_TOTAL and x >= MIN_MEAN * len(token)


def train(docs: DataFrame) -> Chains:
    """Chains counted over every document.  Each unseen transition counts
    once, so without any labelled string the random chain is uniform."""
    counts = pick(docs, "text").mapInArrow(released(_count), "label string, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    n = {"random": np.ones((SIZE, SIZE)), "ordinary": np.ones((SIZE, SIZE))}
    for r in counts.collect():  # at most 2 x 66 x 66 rows
        n[r.label][divmod(r.pair, SIZE)] += r.n
    logs = {k: np.log(v[:, 1:] / v[:, 1:].sum(axis=1, keepdims=True)) for k, v in n.items()}
    ratio = np.zeros((SIZE, SIZE))
    ratio[:, 1:] = logs["random"] - logs["ordinary"]
    return Chains(ratio)


def _covered(start: int, end: int, base: list[tuple[int, int, str, int, int]]) -> bool:
    """Do the base spans, by start, leave no character of [start, end)?"""
    for s, _, _, e, _ in base:
        if s > start:
            break
        start = max(start, e)
    return start >= end


def find(text: str, chains: Chains) -> list[tuple[str, int, int]]:
    """All spans of one text."""
    base = base_spans(text)
    spans = [(s, k, kind, e) for s, k, kind, e, _ in base]
    for m in TOKEN.finditer(text):
        if chains.is_random(m[0]) and not _covered(m.start(), m.end(), base):
            spans.append((m.start(), 3, "random", m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(spans)]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
HINT = f"{BASE_HINT}|[A-Za-z0-9+/_=-]{{{MIN_TOKEN}}}"


def _scan(chains: Chains, column: int, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(column)
            hint = np.asarray(pc.match_substring_regex(texts.cast(pa.large_string()).fill_null(""), HINT))
            spans, changed = [[]] * b.num_rows, {}
            for k in np.flatnonzero(hint).tolist():
                t = texts[k].as_py()
                found = find(t, chains)
                spans[k] = [{"kind": kind, "start": s, "end": e} for kind, s, e in found]
                if redact and found:
                    changed[k] = redacted(t, found)
            if redact:
                arrays = b.columns
                if changed:
                    arrays[column] = pa.array([changed.get(k, t) for k, t in enumerate(texts.to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPAN_TYPE)], ["doc_id", "spans"])
    return run


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """Every maximal run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, chains: Chains | None = None) -> DataFrame:
    """doc_id, spans (array of kind, start, end)."""
    chains = chains or train(docs)
    d = pick(docs, "doc_id", "text")
    return d.mapInArrow(released(_scan(chains, 1, False)), T.StructType([d.schema["doc_id"], T.StructField("spans", SPANS)]))


def redact(docs: DataFrame, chains: Chains | None = None) -> DataFrame:
    """``docs`` with every secret replaced by a mark; all columns kept."""
    chains, names, rows = chains or train(docs), docs.columns, positional(docs)
    return rows.mapInArrow(released(_scan(chains, names.index("text"), True)), rows.schema).toDF(*names)


def summary(spans: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans (as
    ``kind:start:end``, comma-joined)."""
    def written(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [number(k) for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    return summary(scan(docs))
