"""Benchmark decontamination with a generalised suffix automaton.

The items' normalised words make one automaton (every substring of every item is a path from its root). Document words
are streamed through it; the length of the longest match that ends at each word decides which words are hit. Runs of
words that cannot hold a window (a word, or a pair of neighbours, that no item has) are left out by array
operations before anything is streamed.

``scan`` gives counts, items and byte spans for every document; ``clean`` takes the spans out and drops documents of which
more than ``max_coverage`` of the words are hit.

Bounds: the items go to every task, so their size is checked; beyond ``MOST_WORDS`` words they are worked through
in several automata, one pass over the documents each, and the passes are merged by document.

Defined results: null or empty texts have no words and no hits; items without words are never found; item_ids that
are null count as items but have no id in the digest; repeated items count once an id; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Words, aside, buffers, runs, small_batches, table

WINDOW = 10
#: Words of items in one automaton (about 400 bytes each).
MOST_WORDS = 400_000
FOUND = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


class SuffixAutomaton:
    def __init__(self, items: list[tuple[str | None, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends = []
        for name, words in items:
            last, path = 0, []
            for w in words:
                last = self._extend(last, w)
                path.append(last)
            ends.append((name, len(words), path))
        n = len(self.link)
        #: Items that hold the window that ends a match, at the state whose strings have the window's length.
        self.found: dict[int, set] = {}
        #: Items shorter than a window, at the state that holds the whole item.
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for name, size, path in ends:
            if 0 < size < window:
                self.short.setdefault(self._of(path[-1], size), []).append((size, name))
            elif size:
                for v in path[window - 1 :]:
                    self.found.setdefault(self._of(v, window), set()).add(name)
        order = sorted(range(1, n), key=self.len.__getitem__)
        self.window_state = [-1] * n
        self.shorts: list[tuple] = [()] * n
        for v in order:
            up = self.link[v]
            self.window_state[v] = v if self.len[up] < window <= self.len[v] else self.window_state[up]
            self.shorts[v] = (*self.shorts[up], *self.short.get(v, ()))

    def _of(self, v: int, size: int) -> int:
        """The state, on the suffix path of ``v``, that holds the suffix of that length."""
        while self.len[self.link[v]] >= size:
            v = self.link[v]
        return v

    def _clone(self, p: int, q: int, w: int) -> int:
        c = len(self.link)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, w)
        new = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.len.append(self.len[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, w)
        return new

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """(merged hit ranges, items) of a run of words."""
        v = length = 0
        hits: list[tuple[int, int]] = []
        items: set = set()
        nxt, link, lens = self.next, self.link, self.len
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                length = lens[v]
            if w in nxt[v]:
                v = nxt[v][w]
                length += 1
            most = length if length >= self.window else 0
            if most:
                items |= self.found.get(self.window_state[v], set())
            for size, name in self.shorts[v]:
                if length >= size:
                    items.add(name)
                    most = max(most, size)
            if most:
                a = i - most + 1
                while hits and hits[-1][1] >= a:
                    a = min(a, hits.pop()[0])
                hits.append((a, i + 1))
        return hits, items


class Matcher:
    """The automaton with the vocabulary and word pairs of its items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        data, offsets = buffers(pa.array([t or "" for _, t in items], pa.string()))
        w = Words(data, offsets, ALNUM)
        self.vocabulary, ids = np.unique(w.h, return_inverse=True)
        n = np.diff(w.first)
        named = [(name, ids[w.first[i] : w.first[i + 1]].tolist()) for i, (name, _) in enumerate(items)]
        self.automaton = SuffixAutomaton(named, window)
        self.least = int(min([window, *n[n > 0]]))
        inner = w.text_of()
        pair = ids[:-1].astype(np.int64) * len(self.vocabulary) + ids[1:]
        self.pairs = np.unique(pair[inner[1:] == inner[:-1]]) if len(ids) > 1 else np.zeros(0, np.int64)

    def match(self, w: Words) -> Iterator[tuple[int, list[tuple[int, int]], set]]:
        """(text, hit ranges as word numbers, items) of the texts with hits, run by run."""
        if not len(self.vocabulary) or not len(w.h):
            return
        ids = np.searchsorted(self.vocabulary, w.h)
        ids[ids == len(self.vocabulary)] = 0
        known = self.vocabulary[ids] == w.h
        owner = w.text_of()
        tied = np.zeros(len(ids), bool)
        j = np.flatnonzero(known[1:] & known[:-1] & (owner[1:] == owner[:-1])) + 1
        pair = ids[j - 1].astype(np.int64) * len(self.vocabulary) + ids[j]
        at = np.searchsorted(self.pairs, pair)
        at[at == len(self.pairs)] = 0
        tied[j] = self.pairs[at] == pair if len(self.pairs) else False
        begin = np.flatnonzero(known & ~tied)
        stop = np.flatnonzero(~np.append(tied, False)[1:] & known) + 1
        long = stop - begin >= self.least
        for a, b in zip(begin[long].tolist(), stop[long].tolist(), strict=True):
            hits, items = self.automaton.stream(ids[a:b].tolist())
            if hits:
                yield int(owner[a]), [(x + a, y + a) for x, y in hits], items


def groups(items: DataFrame, most: int = MOST_WORDS) -> list[list[tuple[str | None, str | None]]]:
    """The items in groups of at most so many words (an item longer than that is a group of its own)."""
    out, size = [[]], 0
    rows = items.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).dropDuplicates(["i", "t"])
    for r in rows.toLocalIterator():
        n = len((r.t or "").split()) + 1
        if out[-1] and size + n > most:
            out.append([])
            size = 0
        out[-1].append((r.i, r.t))
        size += n
    return out


def matched(docs: DataFrame, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` and those of ``FOUND``, for one group of items."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(items)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(FOUND).fields])
    kept: list[Matcher] = []

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.append(Matcher(shared.value, window))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                w = Words(data, offsets, ALNUM)
                n = part.num_rows
                hit, names, spans = np.zeros(n, np.int64), [set() for _ in range(n)], [[] for _ in range(n)]
                for i, ranges, items_found in kept[-1].match(w):
                    names[i] |= items_found
                    for a, b in ranges:
                        hit[i] += b - a
                        spans[i].append({"start": int(w.start[a] - offsets[i]), "end": int(w.end[b - 1] - offsets[i])})
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(w.first), pa.int64()), pa.array(hit), pa.array([sorted(x or "" for x in s) for s in names], pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                    names=[*part.schema.names, "n_words", "n_hit", "items", "spans"],
                )

    clean = docs.withColumn("text", F.col("text").cast("string"))
    return clean.mapInArrow(scan_batches, schema)


FOUND_NAMES = ("n_words", "n_hit", "items", "spans")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = MOST_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids, sorted) and spans (bytes of the UTF-8 text, end exclusive).

    Columns of those names that ``docs`` has already are replaced.
    """
    docs, back = aside(docs.drop(*FOUND_NAMES), "_row", "_items", "_spans")
    return scanned(docs, items, window, most).select(*back, *FOUND_NAMES)


def scanned(docs: DataFrame, items: DataFrame, window: int, most: int) -> DataFrame:
    """The same for ``docs`` without columns that the passes need for themselves."""
    parts = groups(items, most)
    if len(parts) == 1:
        return matched(docs, parts[0], window)
    key = F.monotonically_increasing_id()
    # spans of several passes over the same rows: put in order, and folded where they meet
    keyed = docs.withColumn("_row", key)
    passes = [matched(keyed.select("_row", "text"), p, window).where("n_hit > 0").select("_row", "items", "spans") for p in parts]
    both = passes[0]
    for p in passes[1:]:
        both = both.unionByName(p)
    fold = "aggregate(array_sort(flatten(collect_list(spans))), cast(array() as array<struct<start:bigint,end:bigint>>), (a, x) -> if(size(a) > 0 and element_at(a, -1).end >= x.start, concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))), concat(a, array(x))))"
    merged = both.groupBy("_row").agg(F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("_items"), F.expr(fold).alias("_spans"))
    base = matched(keyed, [], window).join(merged, "_row", "left")
    words = "size(regexp_extract_all(cast(substring(encode(text, 'UTF-8'), cast(s.start as int) + 1, cast(s.end - s.start as int)) as string), '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+', 0))"
    return base.select(
        *docs.columns, "n_words",
        F.expr(f"cast(aggregate(coalesce(_spans, array()), 0, (n, s) -> n + {words}) as bigint)").alias("n_hit"),
        F.coalesce("_items", "items").alias("items"), F.coalesce("_spans", "spans").alias("spans"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without the hit spans; a document with more than ``max_coverage`` of its words hit is dropped."""
    columns = docs.columns
    docs, back = aside(docs, "n_words", "n_hit", "items", "spans")
    found = scan(docs, items, window).where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    raw = "encode(text, 'UTF-8')"
    # what stands between the spans, from byte 1 of the text to its end
    kept = f"""aggregate(spans, named_struct('t', cast('' as string), 'at', 0L),
        (a, s) -> named_struct('t', concat(a.t, cast(substring({raw}, cast(a.at as int) + 1, cast(s.start - a.at as int)) as string)), 'at', s.end),
        a -> concat(a.t, cast(substring({raw}, cast(a.at as int) + 1, octet_length(text)) as string)))"""
    found = found.withColumn("text", F.when(F.size("spans") > 0, F.expr(kept)).otherwise(F.col("text")))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*back)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = {
    "op1_decontaminate": f"""
        WITH b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark WHERE text IS NOT NULL),
        w AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS gram
              FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
        d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS ws FROM documents),
        p AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w)),
        h AS (SELECT p.doc_id, p.i, w.n, w.item_id FROM p JOIN w ON w.n = p.n AND w.gram = array_to_string(p.ws[p.i:p.i + p.n - 1], ' ')),
        c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
        s AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)""",
}
