"""SentencePiece encoding and decoding: by a model's merges, or by a max-plus parallel scan.

Merges (``merges=True``) are the way of a model file of kind BPE, such as the public one: of all neighbours whose join is a piece, those of the
highest score join first, the leftmost of equals; what is no piece in the end becomes its UTF-8 byte pieces. Ids are those of the library.
No piece crosses the end of a word, so each distinct word is solved once and a giant text is cut between words, its parts solved
in parallel (a giant word stays whole). ``by_merges`` tells which way a file takes; the query and the pipeline follow it.

The scan (``merges=False``) is the way of unigram files: the path of highest total score through the lattice of the model's pieces. Whole
scores are taken as they are, others as multiples of 1 / ``FINE``; a character that is no piece becomes its byte pieces, at ``BYTE_SCORE``
each, or with the library's penalty a character where scores are not whole. Sums are whole numbers, so the max-plus product of
matrices is exactly associative. On a file of kind BPE the scan's ids are not the library's.

A giant text is cut into chunks. At a cut the state is how far the piece that covers it reaches beyond it; a chunk
yields the matrix of best scores from entry to exit state, chunks in parallel. A text's matrices are combined from the right
into best rests, which fix the state at every cut; then each chunk is traced back on its own, again in parallel.

Pieces never run from a word into a following blank, so within a chunk (and in all shorter texts) words are independent and
each distinct one is solved once; the state at a word's start is the single state 0.

Decoding (``decode``) is the same for both.

Defined results: null or empty texts have no ids and decode to the empty text; repeated rows get equal results; other columns are kept.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, hashes, runs, small_batches, stored, table

CHUNK = 1 << 16
BYTE_SCORE = -100_000
FINE = 1 << 20
NONE = -(1 << 60)
BLANK = "▁"
_MODELS: dict[tuple[str, bool], Pieces] = {}


class Pieces:
    MOST, KEPT = 100_000, 1_000_000

    def __init__(self, path: str, merges: bool = False):
        import sentencepiece

        self.merges = merges
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.names) if sp.is_byte(i)}
        usable = [i for i in range(len(self.names)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        scores = {self.names[i]: sp.get_score(i) for i in usable}
        whole = all(s == int(s) for s in scores.values())
        self.score = {p: int(s) if whole else round(s * FINE) for p, s in scores.items()}
        self.penalty = None if whole else min(self.score.values()) - 10 * FINE
        self.id = {self.names[i]: i for i in usable}
        self.width = max(map(len, self.score))
        # where a text falls apart: pieces with a blank hold nothing before it but blanks, and none holds a line's end
        if any(BLANK in p.lstrip(BLANK) or "\n" in p and p != "\n" for p in self.score):
            raise ValueError("pieces of this model run over the ends of words")
        # each beginning of a piece, with the piece's score or NONE where it is none itself
        self.begun = {p[:k]: NONE for p in self.score for k in range(1, len(p))} | self.score
        # the bytes that each id stands for, one after another
        spelled = [p.replace(BLANK, " ").encode() for p in self.names]
        for b, i in self.bytes.items():
            spelled[i] = bytes([b])
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self._forget()
        self.units = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n").findall
        self.known: dict[str, tuple[int, bytes]] = {}

    def forward(self, text: str, start: int = 0, end: int | None = None, cut: int | None = None) -> tuple[list[int], list[int]]:
        """(best score, start of the last piece) for each place from ``start`` to ``end``; beyond ``cut`` only pieces that cover it.

        From each place the text is followed as long as it can still become a piece.
        """
        end = len(text) if end is None else end
        best, back = [NONE] * (end + 1), [-1] * (end + 1)
        best[start] = 0
        begun, last = self.begun, end if cut is None else cut
        for i in range(start, min(last, end) if cut is not None else end):
            here = best[i]
            if here == NONE:
                continue
            for j in range(i + 1, end + 1):
                s = begun.get(text[i:j])
                if s is None:
                    break
                if s != NONE and here + s > best[j]:
                    best[j], back[j] = here + s, i
            if text[i] not in self.score:
                s = here + (BYTE_SCORE * len(text[i].encode("utf-8", "surrogatepass")) if self.penalty is None else self.penalty)
                if s > best[i + 1]:
                    best[i + 1], back[i + 1] = s, i
        return best, back

    def spell(self, text: str) -> list[int]:
        i = self.id.get(text)
        return [i] if i is not None else [self.bytes[b] for b in text.encode("utf-8", "surrogatepass")]

    def trace(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        cuts = [end]
        while cuts[-1] > start:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        return [x for a, b in zip(cuts, cuts[1:]) for x in self.spell(text[a:b])]

    def merged(self, text: str) -> list[int]:
        """The ids of a word by merges: the pair of the highest score joins first, the leftmost of equals."""
        n = len(text)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        score = self.score
        pairs = [(-score[text[i : i + 2]], i, i + 2) for i in range(n - 1) if text[i : i + 2] in score]
        heapify(pairs)
        while pairs:
            _, i, z = heappop(pairs)
            m = end[i]
            if m <= i or m >= n or end[m] != z:  # a part has joined another one since
                continue
            end[i], end[m] = z, -1
            if z < n:
                before[z] = i
                s = score.get(text[i : end[z]])
                if s is not None:
                    heappush(pairs, (-s, i, end[z]))
            h = before[i]
            if h >= 0:
                s = score.get(text[h:z])
                if s is not None:
                    heappush(pairs, (-s, h, z))
        out, i = [], 0
        while i < n:
            out += self.spell(text[i : end[i]])
            i = end[i]
        return out

    def solve(self, text: str) -> list[int]:
        return self.merged(text) if self.merges else self.trace(text, self.forward(text)[1], 0, len(text))

    def unit(self, text: str) -> tuple[int, bytes]:
        got = self.known.get(text)
        if got is None:
            if len(self.known) >= self.MOST:
                self.known.clear()
            if self.merges:  # a sum of scores means nothing here
                got = 0, array("i", self.merged(text)).tobytes()
            else:
                best, back = self.forward(text)
                got = best[-1], array("i", self.trace(text, back, 0, len(text))).tobytes()
            if len(text) <= 64:
                self.known[text] = got
        return got

    def _forget(self) -> None:
        self.keys, self.at, self.len, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode_run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each, the marked texts' bytes with blanks as blanks, their offsets).

        The words of a run are told apart by array operations and each distinct one is solved once; a worker keeps what it has learned
        within ``KEPT`` words.
        """
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        marked_ = np.insert(data, offsets[:-1][full], 32)
        cuts = offsets + np.concatenate([[0], np.cumsum(full)])
        raw = marked_.tobytes()
        if BLANK.encode() in raw:  # a visible mark in a text reads as a blank
            texts = [raw[a:b].replace(BLANK.encode(), b" ") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
            raw = b"".join(texts)
            marked_ = np.frombuffer(raw, np.uint8)
        size = len(marked_)
        if not size:
            return np.zeros(0, np.int32), np.zeros(n, np.int64), marked_, cuts
        start = np.zeros(size, bool)
        start[cuts[:-1][np.diff(cuts) > 0]] = True
        blank, line = marked_ == 32, marked_ == 10
        start |= line
        start[1:] |= line[:-1] | blank[1:] & ~blank[:-1]
        at = np.flatnonzero(start)
        end = np.append(at[1:], size)
        owner = np.searchsorted(cuts, at, "right") - 1
        keys, first, inverse = np.unique(hashes(marked_, at, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.KEPT:
            self._forget()
        put = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        old = put < len(self.keys)
        new[old] = self.keys[put[old]] != keys[old]
        if new.any():
            f = first[new]
            found = []
            for a, b in zip(at[f].tolist(), end[f].tolist(), strict=True):
                text = raw[a:b].decode().replace(" ", BLANK)
                found.append(array("i", self.solve(text)).tobytes())
            length = np.array([len(x) // 4 for x in found], np.int64)
            put, begin = np.searchsorted(self.keys, keys[new]), len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.int32)])
            self.keys, self.at, self.len = np.insert(self.keys, put, keys[new]), np.insert(self.at, put, begin), np.insert(self.len, put, length)
        k = np.searchsorted(self.keys, keys)[inverse]
        length, place = self.len[k], self.at[k]
        ids = self.ids[np.arange(int(length.sum())) + np.repeat(place - np.cumsum(length) + length, length)]
        return ids, np.bincount(owner, weights=length, minlength=n).astype(np.int64), marked_, cuts

    def decode_run(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for, one after another (a text's leading blank included)."""
        size = self.size[ids]
        return self.flat[np.arange(int(size.sum())) + np.repeat(self.place[ids] - np.cumsum(size) + size, size)]

    def encode(self, text: str) -> tuple[int, bytes]:
        """(score, ids as 32-bit integers) of a whole text."""
        if not text:
            return 0, b""
        found = [self.unit(u) for u in self.units(marked(text))]
        return sum(s for s, _ in found), b"".join([x for _, x in found])

    # ------------------------------------------------------------ chunks: text reaches width - 1 characters beyond the cut

    def falls_apart(self, text: str, size: int) -> tuple[int, int] | None:
        """The first and last place, from ``width`` on and up to ``size``, where words meet."""
        first = last = None
        for m in re.finditer(f"(?<=[^{BLANK}])(?={BLANK})|(?<=\n)|(?=\n)", text[: size + 1]):
            if self.width <= m.start() <= size:
                first = m.start() if first is None else first
                last = m.start()
        return None if first is None else (first, last)

    def matrix(self, text: str, size: int, final: bool) -> np.ndarray:
        """Best scores from each entry state (rows) to each exit state; a final chunk has exit state 0 only."""
        w = self.width
        out = np.full((w, w), NONE, np.int64)
        exits = 1 if final else min(w, len(text) - size + 1)
        apart = self.falls_apart(text, size)
        if apart is None:
            for a in range(min(w, size + 1)):
                best, _ = self.forward(text, a, size + exits - 1, size)
                out[a, :exits] = best[size : size + exits]
            if size < w:  # a piece may reach over the whole chunk
                for a in range(size + 1, min(w, size + exits)):
                    out[a, a - size] = 0
            return out
        first, last = apart
        middle = sum(self.unit(u)[0] for u in self.units(text[first:last]))
        tail, _ = self.forward(text, last, size + exits - 1, size)
        for a in range(w):
            best, _ = self.forward(text, a, first)
            if best[first] > NONE:
                out[a, :exits] = [best[first] + middle + x if x > NONE else NONE for x in tail[size : size + exits]]
        return out

    def between(self, text: str, size: int, a: int, z: int) -> bytes:
        """The ids of a chunk from entry state ``a`` to exit state ``z``."""
        if a >= size + z:
            return b""
        apart = self.falls_apart(text, size)
        if apart is None or apart[0] < a:
            _, back = self.forward(text, a, size + z, size)
            return array("i", self.trace(text, back, a, size + z)).tobytes()
        first, last = apart
        _, head = self.forward(text, a, first)
        _, tail = self.forward(text, last, size + z, size)
        ends = [array("i", self.trace(text, b, x, y)).tobytes() for b, x, y in ((head, a, first), (tail, last, size + z))]
        return ends[0] + b"".join([self.unit(u)[1] for u in self.units(text[first:last])]) + ends[1]

    def decode(self, ids: list[int]) -> str:
        out = bytearray()
        for i in ids:
            p = self.names[i]
            if len(p) == 6 and p.startswith("<0x") and self.bytes.get(int(p[3:5], 16)) == i:
                out.append(int(p[3:5], 16))
            else:
                out += p.replace(BLANK, " ").encode("utf-8", "surrogatepass")
        return out[1:].decode("utf-8", "replace") if out[:1] == b" " else out.decode("utf-8", "replace")


def marked(text: str) -> str:
    """A blank is put before a text and every blank becomes a visible mark; a mark in the text itself reads as a blank, as the library has it."""
    return BLANK + text.replace(" ", BLANK)


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NONE)


def pieces(path: str, merges: bool = False) -> Pieces:
    if (path, merges) not in _MODELS:
        _MODELS[path, merges] = Pieces(path, merges)
    return _MODELS[path, merges]


def by_merges(path: str) -> bool:
    """Whether the model file is of kind BPE."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE


def states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(entry, exit) state of each chunk on a best path: best rests from the right, then one walk over the cuts."""
    rest = [np.full(matrices[0].shape[1], NONE, np.int64)]
    rest[0][0] = 0
    for m in reversed(matrices):
        rest.append(np.maximum((m + rest[-1][None, :]).max(1), NONE))
    rest.reverse()
    out, s = [], 0
    for k, m in enumerate(matrices):
        z = int((m[s] + rest[k + 1]).argmax())
        out.append((s, z))
        s = z
    return out


def lists(raw: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), np.int32)))


def is_giant(chunk: int):
    return F.coalesce(F.length("text"), F.lit(0)) > chunk


def encode(docs: DataFrame, model: str, chunk: int = CHUNK, name: str = "pieces", merges: bool = False, check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) of the whole text, by merges or by the scan; a column of that name is replaced.

    ``check`` adds ``round_trip``: whether decoding the ids gives the text (a null one: the empty text) again, found in the same pass.
    """
    small_batches(docs.sparkSession, 500)
    docs, back = aside(docs.drop("ids", *(["round_trip"] if check else [])).withColumn("text", F.col("text").cast("string")), "_row")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, merges)
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                ids, n, text, cuts = p.encode_run(data, offsets)
                column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids))
                more = [pa.array(same_texts(p, ids, n, text, cuts), pa.bool_())] if check else []
                yield pa.RecordBatch.from_arrays([*part.columns, column, *more], names=[*part.schema.names, "ids", *added])

    added = ["round_trip"] if check else []
    if check:
        schema = schema.add("round_trip", T.BooleanType())
    large = giants(docs.where(is_giant(chunk)), model, chunk, name, merges)
    if check:
        large = decode(large, model).withColumn("round_trip", F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(BLANK), F.lit(" ")))
    coded = docs.where(~is_giant(chunk)).mapInArrow(short, schema).union(large.select(*docs.columns, "ids", *added))
    return coded.select(*back, "ids", *added)


def same_texts(p: Pieces, ids: np.ndarray, n: np.ndarray, text: np.ndarray, cuts: np.ndarray) -> list[bool]:
    """For each text of a run whether its ids stand for its bytes."""
    back, size = p.decode_run(ids), np.concatenate([[0], np.cumsum(p.size[ids])])
    at = size[np.concatenate([[0], np.cumsum(n)])]
    whole = len(back) == len(text) and bool((back == text).all())
    return [(whole and at[i] == cuts[i] and at[i + 1] == cuts[i + 1]) or bool(np.array_equal(back[at[i] : at[i + 1]], text[cuts[i] : cuts[i + 1]])) for i in range(len(n))]


def between_words(text: str, chunk: int) -> Iterator[str]:
    """A marked text in parts of whole words of about ``chunk`` characters (a longer word is a part of its own)."""
    begin = size = 0
    for m in re.finditer(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n", text):
        if size and m.end() - begin > chunk:
            yield text[begin : m.start()]
            begin = m.start()
        size = m.end() - begin
    yield text[begin:]


def giants_by_merges(docs: DataFrame, model: str, chunk: int, name: str) -> DataFrame:
    """Giant texts cut between words, the parts solved in parallel."""
    spark = docs.sparkSession
    giants = stored(docs.withColumn("_row", F.monotonically_increasing_id()), name)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for k, part in enumerate(between_words(marked(text), chunk)):
                    yield pa.record_batch({"_row": pa.array([row], pa.int64()), "k": pa.array([k], pa.int64()), "part": [part]})

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, True)
        for b in batches:
            raw = [b"".join([p.unit(u)[1] for u in p.units(t)]) for t in b.column("part").to_pylist()]
            yield pa.record_batch({"_row": b.column("_row"), "k": b.column("k"), "ids": lists(raw)})

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    cuts = giants.select("_row", "text").mapInArrow(cut, "_row bigint, k bigint, part string").repartition(parts, "_row", "k")
    whole = cuts.mapInArrow(solve, "_row bigint, k bigint, ids array<int>").groupBy("_row")
    whole = whole.agg(F.expr("flatten(transform(array_sort(collect_list(struct(k, ids))), x -> x.ids))").alias("ids"))
    return giants.join(whole, "_row").drop("_row")


def giants(docs: DataFrame, model: str, chunk: int, name: str, merges: bool = False) -> DataFrame:
    """The same for giant texts: chunks solved, joined and traced in parallel."""
    if merges:
        return giants_by_merges(docs, model, chunk, name)
    spark = docs.sparkSession
    giants = stored(docs.withColumn("_row", F.monotonically_increasing_id()), name)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = pieces(model).width - 1
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = marked(text)
                for i in range(0, len(text), chunk):
                    size = min(chunk, len(text) - i)
                    yield pa.record_batch({"_row": pa.array([row], pa.int64()), "k": pa.array([i // chunk], pa.int64()), "size": pa.array([size], pa.int64()), "final": [i + size == len(text)], "part": [text[i : i + size + reach]]})

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            m = [p.matrix(t, n, f).tobytes() for t, n, f in zip(b.column("part").to_pylist(), b.column("size").to_pylist(), b.column("final").to_pylist(), strict=True)]
            yield pa.record_batch({"_row": b.column("_row"), "k": b.column("k"), "m": pa.array(m, pa.binary())})

    def combine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("k")
        width = pieces(model).width
        found = states([np.frombuffer(x, np.int64).reshape(width, width) for x in rows.column("m").to_pylist()])
        return pa.table({"_row": rows.column("_row"), "k": rows.column("k"), "a": pa.array([a for a, _ in found], pa.int64()), "z": pa.array([z for _, z in found], pa.int64())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            raw = [p.between(*x) for x in zip(b.column("part").to_pylist(), b.column("size").to_pylist(), b.column("a").to_pylist(), b.column("z").to_pylist(), strict=True)]
            yield pa.record_batch({"_row": b.column("_row"), "k": b.column("k"), "ids": lists(raw)})

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    chunks = stored(giants.select("_row", "text").mapInArrow(cut, "_row bigint, k bigint, size bigint, final boolean, part string").repartition(parts, "_row", "k"), name)
    fixed = chunks.mapInArrow(solve, "_row bigint, k bigint, m binary").groupBy("_row").applyInArrow(combine, "_row bigint, k bigint, a bigint, z bigint")
    traced = chunks.join(fixed, ["_row", "k"]).select("_row", "k", "size", "part", "a", "z").mapInArrow(trace, "_row bigint, k bigint, ids array<int>")
    whole = traced.groupBy("_row").agg(F.expr("flatten(transform(array_sort(collect_list(struct(k, ids))), x -> x.ids))").alias("ids"))
    return giants.join(whole, "_row").drop("_row")


def decode(coded: DataFrame, model: str) -> DataFrame:
    """``coded`` with ``decoded``, the text of ``ids``."""
    coded = coded.drop("decoded")
    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.decode(x) if x is not None else None for x in batch.column("ids").to_pylist()], pa.string())], names=[*batch.schema.names, "decoded"])

    return coded.mapInArrow(spell, schema)


DESCRIBED = "doc_id bigint, n_ids bigint, ids_crc32 bigint, same_text boolean"


def described(coded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers), same_text: whether decoding gives the text back."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            ids = b.column("ids").to_pylist()
            same = [p.decode(x) == (t or "").replace(BLANK, " ") for x, t in zip(ids, b.column("text").to_pylist(), strict=True)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_ids": pa.array(map(len, ids), pa.int64()), "ids_crc32": pa.array([zlib.crc32(array("i", x).tobytes()) for x in ids], pa.int64()), "same_text": pa.array(same)})

    return coded.select("doc_id", "text", "ids").mapInArrow(describe, DESCRIBED)


def round_trip(docs: DataFrame, model: str, chunk: int = CHUNK, name: str = "pieces", merges: bool = False) -> DataFrame:
    """``described`` of all documents, with texts that are not giant encoded and decoded in one pass."""
    small_batches(docs.sparkSession, 500)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, merges)
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                ids, n, text, cuts = p.encode_run(data, offsets)
                ends = np.cumsum(n)
                same = same_texts(p, ids, n, text, cuts)
                raw = memoryview(ids.astype("<i4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for k, e in zip(n.tolist(), ends.tolist(), strict=True)]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_ids": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "same_text": pa.array(same, pa.bool_())})

    return docs.where(~is_giant(chunk)).mapInArrow(short, DESCRIBED).union(described(giants(docs.where(is_giant(chunk)), model, chunk, name, merges), model))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return round_trip(table(spark, sf_dir, "documents"), model, merges=by_merges(model))
