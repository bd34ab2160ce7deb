"""Token ids in binary shards: a wavelet matrix per shard, with rank and select.

A shard is one compressed file: a JSON header, then for each bit-plane (highest first) blocks of ``BLOCK``
bits, each zstd-compressed, with a directory of places and of running counts of ones; then the documents' ids and
their token counts. ``WaveletMatrix`` opens such a file and answers access, count (rank), occurrence lookup (select) and
whole ranges by reading only the blocks that they touch.

Encoding: a text is cut where its white space cannot join tokens over the cut; distinct pieces of a run are
encoded once by the tokenizer's own model and the ids are put together by array operations. A text with white space beyond
ASCII goes through the library whole.

Defined results: null or empty texts give the end id alone; rows with a null doc_id sort first; repeated ids are rows of
their own; an empty table gives no shard and an empty result.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACED, file_system, hashes, local_path, runs, shared_dir, small_batches, table

MAGIC = b"WVM1"
BLOCK = 1 << 16


# ---------------------------------------------------------------- the file format


def build(ids: np.ndarray, levels: int = 16) -> list[tuple[int, np.ndarray]]:
    """(number of zeros, bits) of each plane, highest bit first."""
    a, planes = ids, []
    for level in range(levels - 1, -1, -1):
        one = (a >> a.dtype.type(level)) & a.dtype.type(1) != 0
        zeros = a.take(np.flatnonzero(~one))
        planes.append((len(zeros), one))
        a = np.concatenate([zeros, a.take(np.flatnonzero(one))])
    return planes


def dump(out, ids: np.ndarray, doc_ids: list, counts: np.ndarray, end_id: int) -> None:
    packer = zstandard.ZstdCompressor(level=1)
    head, body, at = {"n": len(ids), "docs": len(doc_ids), "end": end_id, "planes": []}, [], 0

    def put(data: bytes) -> int:
        nonlocal at
        body.append(packer.compress(data))
        at += len(body[-1])
        return at - len(body[-1])

    for zeros, bits in build(ids):
        packed = np.packbits(bits)
        ones = np.cumsum([0, *(np.count_nonzero(bits[i : i + BLOCK]) for i in range(0, len(bits), BLOCK))]).tolist()
        places = [put(packed[i : i + BLOCK // 8].tobytes()) for i in range(0, len(packed), BLOCK // 8)]
        head["planes"].append({"zeros": zeros, "at": [*places, at], "ones": ones})
    known = np.array([x is not None for x in doc_ids], bool)
    head["ids"] = [put(known.tobytes()), put(np.array([x or 0 for x in doc_ids], np.int64).tobytes()), put(counts.astype(np.int64).tobytes()), at]
    packed_head = packer.compress(json.dumps(head).encode())
    out.write(MAGIC + struct.pack("<I", len(packed_head)) + packed_head)
    for x in body:
        out.write(x)


class WaveletMatrix:
    """A shard's tokens, read from its file as far as they are asked for."""

    def __init__(self, f):
        self.f = f
        if f.read(4) != MAGIC:
            raise ValueError("not a shard")
        (size,) = struct.unpack("<I", f.read(4))
        self.base = 8 + size
        self.head = json.loads(zstandard.ZstdDecompressor().decompress(f.read(size)))
        self.n, self.planes = self.head["n"], self.head["planes"]
        self.cache: dict[tuple[int, int], np.ndarray] = {}

    def _read(self, start: int, end: int) -> bytes:
        self.f.seek(self.base + start)
        return zstandard.ZstdDecompressor().decompress(self.f.read(end - start))

    def _block(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self.cache:
            if len(self.cache) >= 256:
                self.cache.clear()
            at = self.planes[level]["at"]
            self.cache[level, k] = np.unpackbits(np.frombuffer(self._read(at[k], at[k + 1]), np.uint8))
        return self.cache[level, k]

    def _rank1(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        k, r = divmod(i, BLOCK)
        return self.planes[level]["ones"][k] + (int(self._block(level, k)[:r].sum()) if r else 0)

    def _select(self, level: int, bit: int, j: int) -> int:
        """The place of the ``j``-th (from 0) bit of that value."""
        ones = self.planes[level]["ones"]
        lo, hi = 0, len(ones) - 1
        before = lambda k: ones[k] if bit else min(k * BLOCK, self.n) - ones[k]
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if before(mid) <= j else (lo, mid)
        return lo * BLOCK + int(np.flatnonzero(self._block(level, lo)[: self.n - lo * BLOCK] == bit)[j - before(lo)])

    def access(self, i: int) -> int:
        value = 0
        for level, p in enumerate(self.planes):
            bit = int(self._block(level, i // BLOCK)[i % BLOCK])
            ones = self._rank1(level, i)
            i = p["zeros"] + ones if bit else i - ones
            value = value * 2 + bit
        return value

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before place ``i``."""
        lo, hi = 0, i
        for level, p in enumerate(self.planes):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (p["zeros"] + a, p["zeros"] + b) if token >> (len(self.planes) - 1 - level) & 1 else (lo - a, hi - b)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """The place of the ``j``-th (from 0) occurrence of ``token``."""
        lo = 0
        bits = [token >> (len(self.planes) - 1 - k) & 1 for k in range(len(self.planes))]
        for level, p in enumerate(self.planes):
            a = self._rank1(level, lo)
            lo = p["zeros"] + a if bits[level] else lo - a
        i = lo + j
        for level in range(len(self.planes) - 1, -1, -1):
            i = self._select(level, bits[level], i - self.planes[level]["zeros"] if bits[level] else i)
        return i

    def tokens(self) -> np.ndarray:
        """All ids, from the lowest plane upwards."""
        a = np.zeros(self.n, np.uint16)
        for k in range(len(self.planes) - 1, -1, -1):
            p = self.planes[k]
            packed = b"".join(self._read(p["at"][b], p["at"][b + 1]) for b in range(len(p["at"]) - 1))
            one = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n).view(bool)
            up = np.empty_like(a)
            up[np.flatnonzero(~one)] = a[: p["zeros"]]
            up[np.flatnonzero(one)] = a[p["zeros"] :] | np.uint16(1 << (len(self.planes) - 1 - k))
            a = up
        return a

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids and token counts."""
        i = self.head["ids"]
        known, ids, counts = (np.frombuffer(self._read(i[k], i[k + 1]), t) for k, t in enumerate((bool, np.int64, np.int64)))
        return [int(x) if y else None for x, y in zip(ids, known, strict=True)], counts


# ---------------------------------------------------------------- encoding

#: How the tokenizer's family cuts a text before merging, and white space beyond ASCII.
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE = "[\x1c-\x1f\x85\xa0  -     　]"
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """``encode`` of a run of texts; what it has learned of pieces is kept within fixed bounds."""

    MOST, WORDS = 1_200_000, 250_000

    def __init__(self, path: str):
        import re

        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.cut = regex.compile(_PIECES).findall
        self.wide = re.compile(_WIDE).search
        self.special = [str(x.content) for x in self.whole.get_added_tokens_decoder().values()]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(visible)]
        self.shown = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.words: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _word(self, piece: str) -> bytes:
        got = self.words.get(piece)
        if got is None:
            if len(self.words) >= self.WORDS:
                self.words.clear()
            plain = piece.isascii() and piece.isprintable()
            shown = piece.replace(" ", self.shown[32]) if plain else piece.encode().decode("latin-1").translate(self.shown)
            got = array("H", [t.id for t in self.model.tokenize(shown)]).tobytes()
            self.words[piece] = got
        return got

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        word, cut, found = self._word, self.cut, []
        for p in pieces:
            body = p[1:] if p[0] == " " else p
            if body.isalpha():  # as \\p{L}+
                found.append(word(p))
            elif body[-1:] in ".,!?" and body[:-1].isalpha():
                found.append(word(p[:-1]) + word(p[-1]))
            else:
                found.append(b"".join([word(x) for x in cut(p)]))
        size = np.array([len(x) // 2 for x in found], np.int64)
        if len(self.keys) + len(keys) > self.MOST:
            self._forget()
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint16)])
        put = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = np.insert(self.keys, put, keys), np.insert(self.at, put, at), np.insert(self.size, put, size)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        n = len(offsets) - 1
        odd = np.zeros(n, bool)
        raw = data.tobytes()
        suspect = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3) | (data == 60) | ((data >= 0x1C) & (data <= 0x1F)))
        for i in np.unique(np.searchsorted(offsets, suspect, "right") - 1):
            text = raw[offsets[i] : offsets[i + 1]].decode()
            odd[i] = bool(self.wide(text)) or any(s in text for s in self.special)
        at, end, owner, h = self._pieces(data, offsets, odd)
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.MOST:
            self._forget()
        put = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        old = put < len(self.keys)
        new[old] = self.keys[put[old]] != keys[old]
        if new.any():
            f = first[new]
            self._learn(keys[new], [raw[a:b].decode() for a, b in zip(at[f].tolist(), end[f].tolist(), strict=True)])
        k = np.searchsorted(self.keys, keys)[inverse]
        size, place = self.size[k], self.at[k]
        begin = np.cumsum(size) - size
        ids = self.ids[np.arange(int(size.sum())) + np.repeat(place - begin, size)]
        counts = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
        if odd.any():
            parts, cuts = [], np.concatenate([[0], np.cumsum(counts)])
            for i in range(n):
                if odd[i]:
                    one = np.array(self.whole.encode(raw[offsets[i] : offsets[i + 1]].decode(), add_special_tokens=False).ids, np.uint16)
                    counts[i] = len(one)
                    parts.append(one)
                else:
                    parts.append(ids[cuts[i] : cuts[i + 1]])
            ids = np.concatenate(parts)
        return ids, counts

    @staticmethod
    def _pieces(data: np.ndarray, offsets: np.ndarray, odd: np.ndarray):
        """Start, end, text and hash of each piece.

        A blank before a word belongs to the word's piece; the rest of a run of white space is a piece, and
        so is its last character where that is no blank and a word follows.
        """
        n = len(data)
        white = ~SPACED[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.ones(n, bool)  # white space stands before, or the text begins
        before[1:] = white[:-1]
        before[offsets[:-1][offsets[:-1] < n]] = True
        after = np.zeros(n, bool)  # no white space follows, within the text
        after[:-1] = ~white[1:]
        stop = offsets[1:] - 1
        after[stop[(stop >= 0) & (np.diff(offsets) > 0)]] = False
        start = first[:n].copy()
        ahead = np.zeros(n, bool)  # a blank right before, which this word takes
        ahead[1:] = (data[:-1] == 32) & ~first[1:n]
        start |= ~white & before & ~ahead
        start |= white & (~before | after)
        at = np.flatnonzero(start)
        end = np.append(at[1:], n)
        owner = np.searchsorted(offsets, at, "right") - 1
        keep = ~odd[owner]
        at, end, owner = at[keep], end[keep], owner[keep]
        return at, end, owner, hashes(data, at, end)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- writing and reading shards


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> list[tuple[str, int]]:
    """Write the shards in ascending doc_id order; returns (path, tokens) of each committed shard, in order.

    ``docs`` is dealt out by ranges of doc_id, each sorted and written by one task under a name of its own; the driver
    receives one small row a shard.
    """
    spark = docs.sparkSession
    small_batches(spark, 2000)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ids, doc_ids, counts = encoder(tokenizer), [], [], []
        for batch in batches:
            for part, data, offsets in runs(batch, "text", 2 << 20):
                got, n = enc.encode(data, offsets)
                ids.append(np.insert(got, np.cumsum(n), end_id).astype(np.uint16))
                counts.append(n + 1)
                doc_ids += part.column("doc_id").to_pylist()
        if not doc_ids:
            return
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name = uuid.uuid4().hex + ".wm"
        all_ids, n = np.concatenate(ids), np.concatenate(counts)
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            dump(out, all_ids, doc_ids, n, end_id)
        from pyspark import TaskContext

        yield pa.record_batch({"shard": [TaskContext.get().partitionId()], "path": [f"{folder.rstrip('/')}/{name}"], "tokens": [len(all_ids)]})

    parts = max(docs.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    done = docs.select("doc_id", F.col("text").cast("string").alias("text")).repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    rows = done.mapInArrow(write, "shard bigint, path string, tokens bigint").collect()
    return [(r.path, r.tokens) for r in sorted(rows, key=lambda r: r.shard)]


def read_shards(spark: SparkSession, shards: list[tuple[str, int]]) -> DataFrame:
    """A row a document, from the files: doc_id, start, n_tokens, ids_crc32."""
    starts, total = [], 0
    for path, n in shards:
        starts.append((path, total))
        total += n
    if not starts:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = file_system(path)
                with fs.open_input_file(name) as f:
                    shard = WaveletMatrix(f)
                    ids, (doc_ids, counts) = shard.tokens().astype("<u4"), shard.documents()
                end = np.cumsum(counts)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (b - a) : 4 * b]) for a, b in zip(counts.tolist(), end.tolist(), strict=True)]
                yield pa.record_batch({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + end - counts), "n_tokens": pa.array(counts), "ids_crc32": pa.array(crc, pa.int64())})

    files = spark.createDataFrame(starts, "path string, start bigint").repartition(len(starts))
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op3_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into shards, then describe every document as the files hold it."""
    import public_tokenizers

    shards = write_shards(table(spark, sf_dir, "documents"), shared_dir(spark, "wavelet"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_shards(spark, shards)
