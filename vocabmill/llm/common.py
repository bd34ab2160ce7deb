"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor see.

    It lies under ``spark.checkpoint.dir`` of the session. Where that is unset a folder of the local machine is taken (and set, for
    checkpoints), but only if the session runs on one machine, as in tests; else an error is raised.
    """
    unset = not spark.conf.get("spark.checkpoint.dir", None)
    base = shared_folder(spark)
    if unset:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared Parquet folder and reread it: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ``stored`` tables that nothing reads any more. What led to them, shuffle files above all, goes with the driver's garbage."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{folder}")
    path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """``df`` with columns of those names moved out of the way, and the columns that put all back as they were."""
    moved = {c: f"_own_{c}" for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(moved), [F.col(moved.get(c, c)).alias(c) for c in df.columns]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows reach Python workers in batches of so many and of 16 MB at most (or of one row), so that a worker's memory stays bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def split_count(df: DataFrame, factor: int = 1) -> int:
    """A number of partitions that follows the size of the input."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions() * factor)


# ---------------------------------------------------------------- files in a shared folder


def local_path(path: str) -> str | None:
    """The plain path of a ``file:`` URI, None for any other store."""
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


def file_system(path: str):
    """(pyarrow file system, path in it) of any URI."""
    from pyarrow import fs

    local = local_path(path)
    return (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- words of many texts at once

_M = (1 << 64) - 1
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = 0x9E3779B97F4A7C55 | 3
_R_INV = pow(_R, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text: digits, a to z, everything from U+0080.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Words of [^\x20\x09-\x0D]+.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("r", ())) < n:
        size = max(n, 1 << 21)
        for key, base in (("r", _R), ("i", _R_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[key] = np.cumprod(x, dtype=np.uint64)
    return _POWERS["r"], _POWERS["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a run of whole texts: ``h`` 64-bit hashes, ``start``/``end`` byte places in ``data``, ``first`` per text.

    A text's words are ``first[i]:first[i + 1]``. Null texts have none. Hashes are polynomial sums
    over a random byte table, taken for all words of the run with one running sum.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = True, hashed: bool = True):
        self.raw, self.offsets = data, offsets
        b = LOWER[data] if lower else data
        self.data = b
        inside = kind[b]
        edge = np.empty(len(b) + 1, bool)
        edge[0], edge[-1] = True, True
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[offsets] = True
        at = np.flatnonzero(edge)
        keep = inside[at[:-1]] if len(b) else np.zeros(0, bool)
        self.start, self.end = at[:-1][keep], at[1:][keep]
        self.first = np.searchsorted(self.start, offsets)
        if hashed:
            r, inv = _powers(len(b) + 1)
            run = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(_BYTE[b] * r[: len(b)], out=run[1:])
            self.run, self.inv = run, inv
            self.h = mix((run[self.end] - run[self.start]) * inv[self.start] + (self.end - self.start).astype(np.uint64))

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of more than ``size`` bytes, and hashes of their first ``size`` bytes."""
        i = np.flatnonzero(self.end - self.start > size)
        at = self.start[i]
        return i, mix((self.run[at + size] - self.run[at]) * self.inv[at] + np.uint64(0x5BD1E995 * size))

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def hashes(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``data[at:end]``."""
    r, inv = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * r[: len(data)], out=run[1:])
    return mix((run[end] - run[at]) * inv[at] + (end - at).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string array; null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole texts of about ``most`` bytes (a longer text is a run of its own)."""
    data, offsets = buffers(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each text's shingles of ``size`` words; a shorter text with words has one, its whole sequence."""
    n = len(w.h)
    count = np.diff(w.first)
    text_of = np.repeat(np.arange(len(count)), count)
    out = np.zeros(max(0, n - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            c = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
            out += w.h[k : n - size + 1 + k] * c if n >= size else out
    whole = text_of[: len(out)] == text_of[size - 1 :] if n >= size else np.zeros(0, bool)
    h, t = mix(out[whole]), text_of[: len(out)][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = []
        for i in short:
            x = int(count[i])
            for k, v in enumerate(w.h[w.first[i] : w.first[i + 1]]):
                x = (x + int(v) * pow(0xA0761D6478BD642F, k + 1, 1 << 64)) & _M
            extra.append(x)
        h, t = np.concatenate([h, mix(np.array(extra, np.uint64))]), np.concatenate([t, short])
    return h, t


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and n + 1 offsets."""
    h, t = shingles(w, size)
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[keep], t[keep]
    return h, np.searchsorted(t, np.arange(len(w.first)))


# ---------------------------------------------------------------- connected components


#: So many links at most (16 bytes each) are connected by one task; beyond it rounds of joins do.
ONE_TASK = 1 << 16


def connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of links (u, v), all of them in this task."""
    held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if held:
        u, v = (np.concatenate(x) for x in zip(*held, strict=True))
        name, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        u, v, low = at[: len(u)], at[len(u) :], np.arange(len(name))
        while True:  # the smallest neighbour's label, then the label's label
            new = low.copy()
            np.minimum.at(new, u, low[v])
            np.minimum.at(new, v, low[u])
            new = new[new]
            if (new == low).all():
                break
            low = new
        yield pa.record_batch({"node": pa.array(name), "component": pa.array(name[low])})


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps over written tables; groups only ever meet in
    partial minimums and joins, which Spark can split, so a node with very many links is no hot task.
    Up to ``ONE_TASK`` links are no work for that many jobs: one task connects them.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    if e.limit(ONE_TASK + 1).count() <= ONE_TASK:
        return e.coalesce(1).mapInArrow(connected, "node bigint, component bigint")
    before = None
    while True:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), name)
        # a sum of hashes as a decimal cannot overflow
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
