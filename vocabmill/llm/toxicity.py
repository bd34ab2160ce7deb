"""Toxicity: a factorization machine over hashed terms.

A document's terms are its words and the words' first four and five bytes (inflected or compound insults share them),
hashed into ``DIMENSIONS`` places. The score is the logistic of ``b + sum w_i + sum_{i<j} <v_i, v_j>`` over the
document's distinct chosen terms, so a pair of terms can weigh more than both alone.

Fitting: on a bounded sample of labelled rows, ``MOST_POSITIVE`` and ``MOST_NEGATIVE`` at most, in the order of a hash of doc_id;
rows whose crc32(doc_id as text) mod 3 is 1 are held out and never seen. Terms are chosen by the sample's
class counts. Scoring is one pass over all documents, whole texts; the fitted arrays (bounded by
``MOST_TERMS`` times ``FACTORS + 1`` numbers) are broadcast.

Defined results: null or empty texts have no terms and get the score of the bias; labels that are null, or of documents that
do not exist, are ignored; a document labelled more than once is toxic if any label says so; without rows of both classes the score
is 0 for all. A null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Words, aside, runs, small_batches, table

DIMENSIONS = 1 << 20
FACTORS = 6
MOST_POSITIVE, MOST_NEGATIVE = 3000, 5000
MOST_TERMS = 4096
THRESHOLD = 0.7


def terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed term) of all words and prefixes, repeats included."""
    owner = w.text_of()
    parts = [(owner, w.h)]
    for size in (4, 5):
        i, h = w.prefixes(size)
        parts.append((owner[i], h))
    text, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    return text, (h >> np.uint64(44)).astype(np.int64)  # 20 bits


class Machine:
    def __init__(self, ids: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.ids, self.bias, self.w, self.v = ids, bias, w, v

    def score(self, words: Words) -> np.ndarray:
        n = len(words.first) - 1
        text, term = terms(words)
        slot = np.full(DIMENSIONS, -1, np.int32) if not hasattr(self, "slot") else self.slot
        if not hasattr(self, "slot"):
            slot[self.ids] = np.arange(len(self.ids))
            self.slot = slot
        k = slot[term]
        hit = k >= 0
        pair = np.unique(text[hit].astype(np.int64) * max(1, len(self.ids)) + k[hit])
        text, k = pair // max(1, len(self.ids)), pair % max(1, len(self.ids))
        z = self.bias + np.bincount(text, self.w[k], n)
        for f in range(self.v.shape[1]):
            x = self.v[k, f]
            z += 0.5 * (np.bincount(text, x, n) ** 2 - np.bincount(text, x * x, n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(documents: list[np.ndarray], y: np.ndarray, seed: int = 7, epochs: int = 40) -> Machine:
    """Fit on the distinct terms of each sampled document."""
    if not len(y) or y.min() == y.max():
        return Machine(np.zeros(0, np.int64), -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    n1, n0 = int(y.sum()), int((1 - y).sum())
    c0, c1 = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for d, label in zip(documents, y, strict=True):
        (c1 if label else c0)[d] += 1
    a, b = (c1 + 0.5) / (n1 + 1), (c0 + 0.5) / (n0 + 1)
    z = np.log(a / b) / np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
    z[c1 + c0 < 4] = 0
    order = np.argsort(-np.abs(z), kind="stable")[:MOST_TERMS]
    ids = np.sort(order[np.abs(z[order]) > 4])
    slot = np.full(DIMENSIONS, -1)
    slot[ids] = np.arange(len(ids))
    known = [x[x >= 0] for x in (slot[d] for d in documents)]
    text, k = np.repeat(np.arange(len(known)), [len(x) for x in known]), np.concatenate(known)
    rng = np.random.default_rng(seed)
    d = len(ids)
    p = {"b": np.array([0.0]), "w": np.zeros(d), "v": rng.normal(0, 0.01, (d, FACTORS))}
    m, s = ({q: np.zeros_like(x) for q, x in p.items()} for _ in range(2))
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0) * len(y)
    first = np.searchsorted(text, np.arange(len(y) + 1))
    step, rate, decay = 0, 0.03, 1e-3
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 512)):
            at = np.concatenate([np.arange(first[i], first[i + 1]) for i in rows]) if len(rows) else np.zeros(0, int)
            own = np.repeat(np.arange(len(rows)), first[rows + 1] - first[rows])
            kk = k[at]
            vk = p["v"][kk]
            sums = np.stack([np.bincount(own, vk[:, f], len(rows)) for f in range(FACTORS)], 1)
            out = p["b"][0] + np.bincount(own, p["w"][kk], len(rows)) + 0.5 * ((sums**2).sum(1) - np.bincount(own, (vk**2).sum(1), len(rows)))
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            grad = {"b": np.array([g.sum()]), "w": np.bincount(kk, g[own], d) + decay * p["w"] / max(d, 1)}
            each = g[own][:, None] * (sums[own] - vk)
            grad["v"] = np.stack([np.bincount(kk, each[:, f], d) for f in range(FACTORS)], 1) + decay * p["v"]
            step += 1
            for q in p:
                m[q] += 0.1 * (grad[q] - m[q])
                s[q] += 0.001 * (grad[q] ** 2 - s[q])
                p[q] -= rate * (m[q] / (1 - 0.9**step)) / (np.sqrt(s[q] / (1 - 0.999**step)) + 1e-8)
    return Machine(ids, float(p["b"][0]), p["w"], p["v"])


def held_out(doc_id: Column) -> Column:
    """Never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on the bounded sample; only its distinct hashed terms reach the driver."""
    small_batches(docs.sparkSession)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("_o", F.xxhash64("doc_id"))
    some = known.where("toxic = 1").orderBy("_o", "doc_id").limit(MOST_POSITIVE).union(known.where("toxic = 0").orderBy("_o", "doc_id").limit(MOST_NEGATIVE))

    def own_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                text, term = terms(Words(data, offsets, ALNUM))
                pair = np.unique(text * DIMENSIONS + term)
                cuts = np.searchsorted(pair, np.arange(part.num_rows + 1) * DIMENSIONS)
                raw = (pair % DIMENSIONS).astype("<i4").tobytes()
                yield pa.record_batch({"doc_id": part.column("doc_id"), "toxic": part.column("toxic"), "terms": pa.array([raw[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some.drop("_o")), "doc_id")
    got = rows.mapInArrow(own_terms, "doc_id bigint, toxic int, terms binary").toArrow().sort_by([("doc_id", "ascending")])
    return fit([np.frombuffer(x, "<i4") for x in got.column("terms").to_pylist()], np.array(got.column("toxic").to_pylist(), float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and a score for every row (a column of that name is replaced)."""
    spark, docs = docs.sparkSession, docs.drop("score")
    small_batches(spark)
    shared = spark.sparkContext.broadcast((machine.ids, machine.bias, machine.w, machine.v))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*shared.value)
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(m.score(Words(data, offsets, ALNUM)))], names=[*part.schema.names, "score"])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(scored, schema)


def keep_clean(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that are not predicted toxic, as they were."""
    docs, back = aside(docs, "score")
    return score(docs, machine).where(F.col("score") < threshold).select(*back)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
