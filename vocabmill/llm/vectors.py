"""Embedding near-dedup: an exact range join in the metric of angles.

Vectors are compared within equal labels only. Pivots, vectors of the label itself, cut a label's vectors into Voronoi cells; a
vector's home is its nearest pivot's cell. By the triangle inequality a vector can only have a neighbour at home in another cell if
its angle to that pivot exceeds the one to its own by at most twice the bound; on the sphere the distance to the two
pivots' bisector is a tighter form of the same test. It is copied to just those cells. Each cell then joins its home vectors with
all that it received, alone: every neighbour of a home vector is in its cell, so its links are counted there.

A cell's home vectors are dealt out in blocks of ``BLOCK`` at most; all else streams past a block, so memory does not grow with a cell.
Within a block links fold into trees at once: what leaves a task is a count a vector and a tree edge a vector, never
the pairs of a group of copies.

Bounds: a pivot for each ``PER_CELL`` vectors of a label, ``MOST_PIVOTS`` in all (10 MB), collected and broadcast; where a table needs
more, cells grow instead. In many dimensions vectors without structure lie near all bisectors and are copied to most cells: the join
then costs what comparing a label's vectors in blocks costs.

Defined results: vectors that are null, of another length than a pivot's, zero, or that hold null or non-finite components, and those
with a null label, link with nothing and are components of their own; repeated vec_ids are rows of their own; a null vec_id links as
others do and its row's ``kept`` is false.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, small_batches, stored, table

COSINE = 0.93
PER_CELL, MOST_PIVOTS, BLOCK = 4000, 20_000, 4096


def unit_rows(vectors: DataFrame, name: str) -> DataFrame:
    """row, vec_id, label, v (the vector as doubles, null where it cannot link); written once, so that row numbers stay."""

    def to_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
                a = np.array([np.nan if y is None else y for y in x] if x else [0.0], np.float64)
                norm = np.sqrt(np.dot(a, a)) if np.isfinite(a).all() else 0.0
                out.append(a.tobytes() if label is not None and np.isfinite(norm) and norm > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], names=["row", "vec_id", "label", "v"])

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return stored(rows.mapInArrow(to_unit, "row bigint, vec_id bigint, label string, v binary"), name)


def normed(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def assigned(rows: DataFrame, theta: float) -> DataFrame:
    """cell, home, row, v: each vector at home and in every cell that the triangle inequality leaves open."""
    spark = rows.sparkSession
    able = rows.where("v is not null").withColumn("label", F.concat_ws("/", F.octet_length("v").cast("string"), "label"))
    sizes = able.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PER_CELL)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    per = max(PER_CELL, ceil(total / MOST_PIVOTS))
    order = Window.partitionBy("label").orderBy(F.xxhash64("row"), "row")
    few = able.join(F.broadcast(sizes.where(F.col("n") > per)), "label").withColumn("k", F.row_number().over(order)).where((F.col("k") <= F.ceil(F.col("n") / per)) & (F.col("k") <= MOST_PIVOTS))
    found: dict[str, list[bytes]] = {}
    for r in few.select("label", "k", "v").orderBy("label", "k").toLocalIterator():
        found.setdefault(r.label, []).append(bytes(r.v))
    shared = spark.sparkContext.broadcast(found)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = {k: normed(v) for k, v in shared.value.items()}
        gaps = {k: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for k, p in pivots.items()}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            row, raw = batch.column("row").to_numpy(), batch.column("v").to_pylist()
            for label in set(labels):
                i = np.flatnonzero(labels == label)
                if label not in pivots:
                    yield pa.record_batch({"cell": [f"{label}/0"] * len(i), "home": [True] * len(i), "row": row[i], "v": pa.array([raw[k] for k in i], pa.binary())})
                    continue
                cos = np.clip(normed([raw[k] for k in i]) @ pivots[label].T, -1, 1)
                home = cos.argmax(1)
                own = cos[np.arange(len(i)), home]
                near = np.arccos(cos) - np.arccos(own)[:, None] <= 2 * theta + 1e-9
                near &= own[:, None] - cos <= sin(theta) * gaps[label][home] + 1e-9
                near[np.arange(len(i)), home] = True
                a, c = np.nonzero(near)
                yield pa.record_batch({"cell": [f"{label}/{k}" for k in c], "home": c == home[a], "row": row[i[a]], "v": pa.array([raw[k] for k in i[a]], pa.binary())})

    return able.select("label", "row", "v").mapInArrow(assign, "cell string, home boolean, row bigint, v binary")


class Block:
    """The home vectors of a cell's block: counts of links and a forest of what the links connect."""

    def __init__(self, rows: list[int], raw: list[bytes], bound: float):
        self.rows, self.u, self.bound = np.array(rows, np.int64), normed(raw), bound
        self.raw = raw
        self.count, self.root = np.zeros(len(rows), np.int64), np.arange(len(rows))

    def meet(self, rows: np.ndarray, raw: list[bytes]) -> list[tuple[int, int]]:
        """Link other vectors with the block's; an edge for each of them that has a link."""
        other, edges = normed(raw), []
        for i in range(0, len(raw), 512):
            cos = other[i : i + 512] @ self.u.T
            linked = cos >= self.bound
            for a, b in np.argwhere(np.abs(cos - self.bound) < 1e-12):  # on the line: once more, by the plain formula
                x, y = np.frombuffer(raw[i + a]), np.frombuffer(self.raw[b])
                linked[a, b] = np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y))) >= self.bound
            linked &= rows[i : i + 512, None] != self.rows[None, :]
            self.count += linked.sum(0)
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            first = np.searchsorted(a, np.unique(a))
            edges += zip(rows[i + a[first]].tolist(), self.rows[b[first]].tolist(), strict=True)
            head = b[first][np.searchsorted(np.unique(a), a)]
            self.join(head, b)
        return edges

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            if (ra == rb).all():
                return
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def linked(rows: DataFrame, bound: float = COSINE, name: str = "vectors") -> tuple[DataFrame, DataFrame]:
    """(row, n_links) of every vector that may link, and (a, b) edges of rows that connect what links connect."""
    theta = acos(bound)
    cells = stored(assigned(rows, theta), name)
    sizes = cells.where("home").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select("cell", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    # a cell of many home vectors is dealt out in blocks; to each of them all its vectors stream
    dealt = cells.join(F.broadcast(sizes), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = dealt.where("home").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))).select("cell", "block", F.lit(0).alias("role"), "row", "v")
    rest = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("cell", "block", F.lit(1).alias("role"), "row", "v")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, rows, raw = None, None, [], []

        def result(edges: list[tuple[int, int]], done: Block | None) -> pa.RecordBatch:
            a, b, n = [x for x, _ in edges], [y for _, y in edges], [None] * len(edges)
            if done is not None:
                a += done.rows.tolist()
                b += done.rows[done.root].tolist()
                n += done.count.tolist()
            return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

        for batch in batches:
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("block").to_pylist(), batch.column("role").to_pylist(), strict=True))
            row, v = batch.column("row").to_numpy(), batch.column("v").to_pylist()
            i = 0
            while i < len(keys):
                j = i
                while j < len(keys) and keys[j] == keys[i]:
                    j += 1
                if keys[i][:2] != key:
                    if block is not None:
                        yield result([], block)
                    key, block, rows, raw = keys[i][:2], None, [], []
                if keys[i][2] == 0:
                    rows += row[i:j].tolist()
                    raw += v[i:j]
                elif rows:
                    block = block or Block(rows, raw, bound)
                    edges = block.meet(row[i:j], v[i:j])
                    if edges:
                        yield result(edges, None)
                i = j
        if block is not None:
            yield result([], block)

    small_batches(rows.sparkSession, 2000)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells.rdd.getNumPartitions())
    ordered = home.union(rest).repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "role")
    met = stored(ordered.mapInArrow(meet, "a bigint, b bigint, n bigint"), name)
    return met.where("n is not null").select(F.col("a").alias("row"), F.col("n").alias("n_links")), met.where("a <> b").select("a", "b")


def near_dedup(vectors: DataFrame, bound: float = COSINE, name: str = "vectors") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = unit_rows(vectors, name)
    counts, edges = linked(rows, bound, name)
    parts = components(edges, name).select(F.col("node").alias("row"), "component")
    both = rows.select("row", "vec_id").join(parts, "row", "left").withColumn("component", F.coalesce("component", "row")).join(counts, "row", "left")
    both = stored(both, name)
    low = both.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = both.join(low, "component")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "embeddings"))


ORACLE = {
    "op9_vectors": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
              WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {COSINE}),
        r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
        c AS (SELECT x, min(y) AS low FROM r GROUP BY x), n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
        FROM v LEFT JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id""",
}
