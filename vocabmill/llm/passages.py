"""Substring dedup by hashing of lines and the sentences in them.

Units are sentences within lines: a unit ends at a line's end, or at ``.``, ``!`` or ``?`` before white space. A unit is normalised to its
lower-cased words, so punctuation and spacing don't matter, and hashed to 128 bits. Over the whole corpus the earliest unit of
equal digests (smallest doc_id, then place) stays; all others are repeats. What goes are runs of neighbouring repeats that have ``RUN_WORDS`` words
or more together, so a repeated paragraph goes with its short sentences, while a short phrase that many texts use stays. Places are
byte offsets into the original UTF-8 text, end exclusive; they are never renumbered.

A passage that repeats inside other text shares its inner sentences with its other places, even where it
begins or ends within a sentence or a line.

Defined results: null and empty texts have no units; rows that repeat a doc_id and a text tie at equal places and ties stay; a null doc_id sorts
first; extra columns are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ALNUM, SPACED, Words, mix, runs, small_batches, stored, table

RUN_WORDS = 20
_ENDS = np.zeros(256, bool)
_ENDS[[33, 46, 63]] = True


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end, words, h1, h2) of every unit of a run of texts."""
    w = Words(data, offsets, ALNUM)
    n = len(w.h)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    owner = w.text_of()
    white = ~SPACED[data]
    stop = data == 10
    stop[:-1] |= _ENDS[data[:-1]] & white[1:]
    run = np.concatenate([[0], np.cumsum(stop)])
    new = np.ones(n, bool)
    new[1:] = (run[w.start[1:]] > run[w.end[:-1]]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    blanks = np.append(np.flatnonzero(white), len(data))
    end = np.minimum(blanks[np.searchsorted(blanks, w.end[last])], offsets[owner[last] + 1])
    out = []
    place = (np.arange(n) - np.repeat(first, last - first + 1)).astype(np.uint64)
    for salt in (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(w.h + (place + np.uint64(1)) * np.uint64(salt)), dtype=np.uint64)])
        out.append(mix(total[last + 1] - total[first] + (last - first).astype(np.uint64)).view(np.int64))
    begin = offsets[owner[first]]
    return owner[first], w.start[first] - begin, end - begin, last - first + 1, *out


def units(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, unit (its number in the text), start, end, n_words, h1, h2 of each unit."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                owner, start, end, n, h1, h2 = unit_spans(data, offsets)
                rows = part.select(["doc_id", "text_key"]).take(pa.array(owner))
                unit = np.arange(len(owner)) - np.searchsorted(owner, owner)
                yield pa.record_batch({"doc_id": rows.column("doc_id"), "text_key": rows.column("text_key"), "unit": unit, "start": start, "end": end, "n_words": n, "h1": h1, "h2": h2})

    plain = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    return plain.mapInArrow(cut, "doc_id bigint, text_key bigint, unit bigint, start bigint, end bigint, n_words bigint, h1 bigint, h2 bigint")


def repeats(docs: DataFrame, run_words: int = RUN_WORDS, name: str = "passages") -> DataFrame:
    """doc_id, start, end, n_words, kept_doc_id, kept_start: every unit that goes and the one that stays for it."""
    own = units(docs)
    # the order of units as one number, which hash aggregation can hold: doc_id (null first), then place
    moment = F.expr("cast(coalesce(cast(doc_id as decimal(20, 0)), cast('-9223372036854775809' as decimal(20, 0))) * cast(4294967296 as decimal(10, 0)) + cast(start as decimal(10, 0)) as decimal(32, 0))")
    first = own.groupBy("h1", "h2").agg(F.min(moment).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    first = stored(first, name)  # a written table, so that the join below may split a unit that very many texts hold
    later = own.join(first, ["h1", "h2"]).where(moment > F.col("first"))
    text = Window.partitionBy("doc_id", "text_key")
    later = later.withColumn("run", F.col("unit") - F.dense_rank().over(text.orderBy("unit")))
    # rows that repeat a text have its units several times over: a run's words are counted once
    copies = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "text_key", "unit"))
    later = later.withColumn("total", F.sum(F.col("n_words") / copies).over(Window.partitionBy("doc_id", "text_key", "run"))).where(F.col("total") > run_words - 0.5)
    low = F.expr("pmod(first, cast(4294967296 as decimal(10, 0)))").cast("long")
    kept = ((F.col("first") - low) / F.lit(4294967296).cast("decimal(10,0)")).cast("decimal(20,0)")
    return later.select("doc_id", "start", "end", "n_words", F.when(kept >= F.lit("-9223372036854775808").cast("decimal(20,0)"), kept.cast("long")).alias("kept_doc_id"), low.alias("kept_start"))


def dedup(docs: DataFrame, run_words: int = RUN_WORDS, name: str = "passages") -> DataFrame:
    """``docs`` with ``text`` lacking the units that go and ``removed``, their spans in the original text (a column of that name is replaced)."""
    docs = docs.drop("removed")
    moved = {c: f"_own_{c}" for c in docs.columns if c in ("_id", "_raw")}
    span = F.array_sort(F.collect_set(F.struct("start", "end")))
    gone = stored(repeats(docs, run_words, name).groupBy(F.col("doc_id").alias("_id")).agg(span.alias("removed")), name)
    both = docs.withColumnsRenamed(moved).join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left").withColumn("_raw", F.encode("text", "UTF-8"))
    # what stands before each span and after the last one, each byte taken once
    kept = """array_join(transform(concat(removed, array(named_struct('start', cast(octet_length(_raw) as bigint), 'end', cast(octet_length(_raw) as bigint)))),
        (s, i) -> cast(substring(_raw, cast(CASE WHEN i = 0 THEN 0 ELSE removed[i - 1].end END as int) + 1, cast(greatest(s.start - CASE WHEN i = 0 THEN 0 ELSE removed[i - 1].end END, 0) as int)) as string)), '')"""
    both = both.withColumn("text", F.when(F.col("removed").isNotNull() & F.col("text").isNotNull(), F.expr(kept)).otherwise(F.col("text")))
    return both.drop("_id", "_raw").withColumnsRenamed({v: k for k, v in moved.items()})


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))
