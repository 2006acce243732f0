"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the distinct n-grams (1 to 3
lower-cased characters) that two texts share, normalised by their own counts.
A bounded labelled sample gives landmarks for a Nyström map and the rows of a
one-versus-rest kernel ridge regression; a text is scored by one product of
its presence matrix with the landmarks' and one with the weights.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, or when no labelled text exists; ties go to the smaller language name;
whole texts are used; ``accepted`` keeps a text that its landmarks cannot
refuse, and every text with a letter where no held-out row has a label;
repeated rows and null ids are scored like any other
row (a null id is not held out and not learned from); other columns are
carried by ``predict`` whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, pick, positional, released

GRAMS = 3
# Bounds of the fit, per language: sampled texts, landmarks among them, and
# the length up to which texts are sampled first (prediction has no such bound).
SAMPLE, LANDMARKS, SAMPLE_CHARS = 200, 24, 20_000
SLICES = 64  # slices of tasks whose samples are ranked apart first
MAX_LANGS = 1000  # more label values than this are an error, not languages
RIDGE = 1e-2
# A text goes when it is far less familiar than labelled rows that the fit has
# not seen: below MARGIN times their QUANTILE.  PRIOR shared n-grams are granted,
# so a short text is not judged by a few of them.
PRIOR, QUANTILE, MARGIN = 10, 0.01, 0.5
BINS, LEVELS = 10_000, 3  # the quantile is exact to BINS ** -LEVELS
UND = "und"
ROWS = 256  # texts per matrix product
SPAN = 1 << 20  # characters whose n-grams are sorted together
LETTER = re.compile(r"[^\W\d_]")


def grams(text: str) -> np.ndarray:
    """Sorted distinct n-grams of the whole text, as integers."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
    parts = []
    for at in range(0, max(len(c), 1), SPAN):
        x = c[at:at + SPAN + GRAMS - 1]  # n-grams across the cut are kept
        key, some = x, [x]
        for n in range(2, GRAMS + 1):
            key = (key[:-1] << 21) | x[n - 1:]
            some.append(key)
        parts.append(np.unique(np.concatenate(some)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


@dataclass(frozen=True)
class Model:
    """Landmark n-grams (vocabulary x landmarks) and the weights behind them."""
    langs: tuple[str, ...]
    vocabulary: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def shared(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams shared with every landmark, over the root of the
        landmark's; n-grams of each text), by one product of presence matrices."""
        presence = np.zeros((len(texts), len(self.vocabulary)), np.float32)
        own = np.ones(len(texts))
        for i, t in enumerate(texts):
            g = grams(t)
            at = np.searchsorted(self.vocabulary, g)
            at[at == len(self.vocabulary)] = 0
            presence[i, at[self.vocabulary[at] == g]] = 1
            own[i] = max(1, len(g))
        return presence @ self.landmarks, own

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Normalised kernel of the texts with every landmark."""
        common, own = self.shared(texts)
        return common / np.sqrt(own)[:, None]

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, familiarity) of texts.  Familiarity is the largest
        share of n-grams, of the text or of the landmark, whichever has fewer,
        that the text has in common with a landmark."""
        if not self.langs or not texts:
            return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        common, own = self.shared(texts)
        s = common / np.sqrt(own)[:, None] @ self.weights
        best = s.argmax(axis=1)
        size = np.count_nonzero(self.landmarks, axis=0)
        familiar = ((common * np.sqrt(size) + PRIOR) / (np.minimum(own[:, None], size) + PRIOR)).max(axis=1)
        return [self.langs[k] for k in best], np.clip((s[np.arange(len(s)), best] + 1) / 2, 0, 1), familiar

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, held: bool = False) -> list[tuple[str, str]]:
    """min(SAMPLE, all) distinct texts of every language, from the rows to learn
    from or from those held out: the smallest hashes
    of the texts up to SAMPLE_CHARS, then those of longer ones.  Copies are one
    text whatever their number.  Hashes are ranked per language and slice of
    tasks and then per language, so a language's task meets at most
    SLICES * SAMPLE of them; texts are read for the chosen ones."""
    d = pick(docs, "doc_id", "text", "lang")
    d = d.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(held_out(F.col("doc_id")) == held)
    if d.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of lang")
    hashed = d.filter("text <> ''").withColumn("h", F.xxhash64("text"))
    one = hashed.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"), F.min(F.length("text") > SAMPLE_CHARS).alias("long"))
    sliced = one.withColumn("slice", F.spark_partition_id() % SLICES)
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("long", "h"))).filter(F.col("rank") <= SAMPLE)
    ranked = first.drop("slice").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("long", "h"))).filter(F.col("rank") <= SAMPLE)
    chosen = hashed.join(F.broadcast(ranked.drop("long")), ["lang", "h", "doc_id"]).dropDuplicates(["lang", "h"])
    return [(r.lang, r.text) for r in chosen.select("lang", "rank", "text").orderBy("lang", "rank").collect()]


def fit(labelled: list[tuple[str, str]]) -> Model:
    langs = tuple(sorted({x for x, _ in labelled}))
    taken, marks = dict.fromkeys(langs, 0), []
    for lang, text in labelled:
        if taken[lang] < LANDMARKS and LETTER.search(text):
            taken[lang] += 1
            marks.append(grams(text))
    if not marks:
        return Model((), np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    vocabulary = np.unique(np.concatenate(marks))
    rows = np.zeros((len(vocabulary), len(marks)), np.float32)
    for k, g in enumerate(marks):
        rows[np.searchsorted(vocabulary, g), k] = 1
    rows /= np.sqrt(rows.sum(axis=0))
    own = rows.T.astype(float) @ rows
    values, vectors = np.linalg.eigh(own)
    use = values > 1e-8 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])  # Nyström map: kernel row -> features
    model = Model(langs, vocabulary, rows, np.zeros((len(marks), len(langs))))
    texts = [t for _, t in labelled]
    k = np.concatenate([model.kernel(texts[at:at + ROWS]) for at in range(0, len(texts), ROWS)])
    target = np.array([[1.0 if x == lang else -1.0 for lang in langs] for x, _ in labelled])
    weight = np.array([len(labelled) / (len(langs) * sum(x == y for y, _ in labelled)) for x, _ in labelled])[:, None]
    phi = k @ root
    ridge = np.linalg.solve(phi.T @ (weight * phi) + RIDGE * np.eye(phi.shape[1]), phi.T @ (weight * target))
    return Model(langs, vocabulary, rows, root @ ridge)


def _predict(model: Model, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, familiar = [UND] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)
            for at in range(0, b.num_rows, ROWS):
                texts = b.column(column).slice(at, ROWS).to_pylist()
                known = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
                names, *values = model.judge([texts[k] for k in known])
                for k, x, v, f in zip(known, names, *(v.tolist() for v in values), strict=True):
                    lang[at + k], score[at + k], familiar[at + k] = x, v, f
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(familiar)],
                                             [*b.schema.names, "_lang", "_score", "_familiar"])
    return run


def _judged(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` as _c0, _c1, ... with _lang, _score, _familiar."""
    rows = positional(docs)
    schema = T.StructType([*rows.schema.fields, T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType()),
                           T.StructField("_familiar", T.DoubleType())])
    return rows.mapInArrow(released(_predict(model, docs.columns.index("text"))), schema)


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1)."""
    return _judged(docs, model).drop("_familiar").toDF(*docs.columns, lang, score)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows not held out."""
    model = fit(sample(docs))
    d = pick(docs, "doc_id", "text")
    return predict(d, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def familiar_floor(model: Model, labelled: list[tuple[str, str]]) -> float:
    """Familiarity below which a text is foreign, by labelled texts that the
    model was not fitted to (0 without any: nothing is foreign)."""
    texts = [t for _, t in labelled if LETTER.search(t)]
    if not texts or not model.langs:
        return 0.0
    seen = np.concatenate([model.judge(texts[at:at + ROWS])[2] for at in range(0, len(texts), ROWS)])
    return MARGIN * float(np.quantile(seen, QUANTILE))


def held_out_floor(docs: DataFrame, model: Model) -> float:
    """``familiar_floor`` of all distinct labelled texts held out, whatever
    their number: Spark judges them, and their quantile (the order statistic
    below it) is found by counting, BINS values at a time."""
    if not model.langs:
        return 0.0
    d = pick(docs, "doc_id", "text", "lang").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text <> ''").filter(held_out(F.col("doc_id")))
    judged = _judged(d.select("text"), model).filter(F.col("_lang") != UND).select(F.xxhash64("_c0").alias("h"), F.col("_familiar").alias("x"))
    seen = materialize(judged.groupBy("h").agg(F.min("x").alias("x")).select("x"), "familiar")
    n = seen.count()
    rank, low, width = int((n - 1) * QUANTILE), 0.0, 1.0  # familiarity is a share
    for _ in range(LEVELS if n else 0):
        width /= BINS
        place = F.least(F.greatest(F.floor((F.col("x") - low) / width), F.lit(0)), F.lit(BINS - 1)).alias("bin")
        counts = sorted((r.bin, r.n, r.low, r.high) for r in seen.groupBy(place).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect())  # at most BINS rows
        for at, held, least, most in counts:
            if rank < held:
                break
            rank -= held
        if least == most:
            return MARGIN * least
        seen, low = seen.filter(F.col("x").between(least, most)), low + at * width
    return MARGIN * least if n else 0.0


def accepted(docs: DataFrame, min_score: float = 0.25) -> DataFrame:
    """The rows of ``docs`` whose language can be told: not ``und``, not below
    ``min_score`` (a score of 0.5 is undecided, 1 is certain) and not foreign
    to every learned language (``held_out_floor``, over all rows held out)."""
    model = fit(sample(docs))
    floor = held_out_floor(docs, model)
    kept = _judged(docs, model).filter((F.col("_lang") != UND) & (F.col("_score") >= min_score) & (F.col("_familiar") >= floor))
    return kept.drop("_lang", "_score", "_familiar").toDF(*docs.columns)
