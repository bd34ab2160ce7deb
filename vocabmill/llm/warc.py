"""WARC archives: a writer with digest-based revisit records and a Spark Python data source.

Writer: one archive a partition, each record a gzip member of its own. The member's header carries an
``sl`` extra field (the member's whole length and the payload's length), so that a reader that has seen the record's
header block can step over the payload without inflating it.

Data source ``warc`` (``spark.read.format("warc")``): partitions are byte ranges of the archives, found
by listing files on the driver; filters on ``record_type``, ``target_uri``, ``page_id`` and ``payload_digest``
are taken over by the reader (``pushFilters``) and tested on the parsed headers, before any payload is inflated. With
``payload=false`` payloads are never inflated.

Defined results: a null html is an empty payload; a null page_id leaves the id header out and reads back
as null; rows that tie on the largest page_id of a payload are all responses; an empty table gives no archives and
an empty result. Extra columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from .common import file_system, local_path, shared_dir, small_batches, table

#: Fixed values of the formats: gzip magic with the FEXTRA flag, then the extra field's id and length.
_MAGIC = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x14\0sl\x10\0"
_HEAD = len(_MAGIC) + 16
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
SCHEMA = "record_type string, record_id string, refers_to string, target_uri string, page_id bigint, payload_digest string, payload_bytes bigint, payload binary, headers map<string,string>"
#: Only so many duplicated payloads are broadcast (32 bytes each or so); beyond it they are joined by a shuffle.
BROADCAST_ROWS = 100_000


def member(head: bytes, body: bytes, level: int = 6) -> bytes:
    """A gzip member with the skip lengths in its header; head and body are one deflate stream, flushed between."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(head) + z.flush(zlib.Z_SYNC_FLUSH) + z.compress(body) + z.flush()
    tail = struct.pack("<II", zlib.crc32(body, zlib.crc32(head)), (len(head) + len(body)) & 0xFFFFFFFF)
    return _MAGIC + struct.pack("<QQ", _HEAD + len(packed) + 8, len(body)) + packed + tail


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = _HTTP % len(payload)
    body = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    return member(("\r\n".join(head) + "\r\n\r\n").encode() + http, body + b"\r\n\r\n")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages with ``digest`` (hex SHA-1 of the payload), ``bytes`` and ``keep``: the page a revisit refers to, else null."""
    p = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    many = p.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1 and keep is not null")
    many = many.select(F.col("digest").alias("_d"), F.col("bytes").alias("_b"), "keep").persist()
    if many.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        many = F.broadcast(many)
    p = p.join(many, (p.digest == F.col("_d")) & (p.bytes == F.col("_b")), "left").drop("_d", "_b")
    return p.withColumn("keep", F.when(~F.col("keep").eqNullSafe(F.col("page_id")), F.col("keep")))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> list[str]:
    """Write archives under ``folder``; returns the paths of those whose tasks were committed.

    A task writes under a name of its own, so a repeated or lost attempt leaves at most a file that is not in the list.
    """
    small_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name, n, out = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for page_id, url, html, digest, _, keep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or fs.open_output_stream(name, compression=None)
                kind = "response" if keep is None else "revisit"
                out.write(record(kind, page_id, url, html.encode(), base64.b32encode(bytes.fromhex(digest)).decode(), keep))
                n += 1
        if out:
            out.close()
            yield pa.record_batch({"path": [f"file://{name}" if local_path(folder) else f"{folder.rstrip('/')}/{name.rpartition('/')[2]}"], "records": [n]})

    done = with_revisits(pages, min_bytes).select("page_id", "url", "html", "digest", "bytes", "keep").mapInArrow(write, "path string, records bigint")
    return sorted(r.path for r in done.collect())  # a row for each partition


class Archive(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class WarcReader(DataSourceReader):
    #: Columns of the headers on which a filter can be decided before the payload is touched.
    HEADERS = ("record_type", "target_uri", "page_id", "payload_digest")

    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split("\n") if p]
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitbytes", 32 << 20))
        self.pushed: list[tuple[str, tuple]] = []
        self.present: list[str] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if column in self.HEADERS and isinstance(f, EqualTo):
                self.pushed.append((column, (f.value,)))
            elif column in self.HEADERS and isinstance(f, In):
                self.pushed.append((column, tuple(f.value)))
            elif column in self.HEADERS and isinstance(f, IsNotNull):
                self.present.append(column)
            else:
                yield f

    def partitions(self) -> list[Archive]:
        from pyarrow.fs import FileSelector, FileType

        out = []
        for path in self.paths:
            fs, base = file_system(path)
            info = fs.get_file_info(base)
            found = [info] if info.type == FileType.File else [x for x in fs.get_file_info(FileSelector(base, recursive=True)) if x.type == FileType.File and x.path.endswith((".warc", ".warc.gz"))]
            for x in found:
                uri = f"file://{x.path}" if local_path(path) else f"{path[: len(path) - len(base.lstrip('/'))]}{x.path.lstrip('/')}"
                if x.path.endswith(".gz"):
                    with fs.open_input_file(x.path) as f:
                        own = f.read(len(_MAGIC)) == _MAGIC
                    step = self.split if own else max(1, x.size)  # without skip lengths a file is one partition
                    out += [Archive(uri, i, min(i + step, x.size)) for i in range(0, x.size, step)]
                elif x.size:
                    out.append(Archive(uri, 0, x.size))
        return out or [Archive("", 0, 0)]

    def wanted(self, row: dict) -> bool:
        return all(row[c] in v for c, v in self.pushed) and all(row[c] is not None for c in self.present)

    def read(self, part: Archive):
        if not part.path:
            return
        fs, path = file_system(part.path)
        with fs.open_input_file(path) as f:
            own = f.read(len(_MAGIC)) == _MAGIC
            records = skipping(f, part.start, part.end) if own else plain(f, path.endswith(".gz"))
            for head, body in records:
                row = parsed(head)
                if not self.wanted(row):
                    continue
                payload = None
                if self.payload and row["record_type"] != "revisit":
                    payload = body()
                    if not own:  # the block still holds the answer's own headers
                        payload = payload.partition(b"\r\n\r\n")[2] if row["headers"].get("content-type", "").startswith("application/http") else payload
                        row["payload_bytes"] = len(payload)
                yield (row["record_type"], row["record_id"], row["refers_to"], row["target_uri"], row["page_id"], row["payload_digest"], row["payload_bytes"], payload, row["headers"])


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})


def parsed(head: bytes) -> dict:
    lines = head.split(b"\r\n\r\n", 1)[0].decode("utf-8", "replace").split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    digest, page, size = headers.get("warc-payload-digest"), headers.get("x-page-id"), headers.get("x-payload-length")
    return {
        "record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "refers_to": headers.get("x-refers-to-page", headers.get("warc-refers-to")), "target_uri": headers.get("warc-target-uri"),
        "page_id": int(page) if page else None, "payload_digest": digest.rpartition(":")[2] if digest else None, "payload_bytes": int(size) if size else None, "headers": headers,
    }


def skipping(f, start: int, end: int):
    """(header block, function that inflates the payload) of each member that begins in the range."""
    at = aligned(f, start, end)
    size = f.size()
    while at is not None and at < min(end, size):
        f.seek(at)
        first = f.read(min(4096, size - at))
        if first[: len(_MAGIC)] != _MAGIC:
            raise ValueError(f"no record at byte {at}")
        whole, body = struct.unpack_from("<QQ", first, len(_MAGIC))
        z, head, used = zlib.decompressobj(-15), b"", _HEAD
        data = first[_HEAD:whole]
        while head.count(b"\r\n\r\n") < 2:
            head += z.decompress(data)
            used += len(data)
            if head.count(b"\r\n\r\n") < 2:
                data = f.read(min(4096, whole - used))
                if not data:
                    break
        cut = head.index(b"\r\n\r\n", head.index(b"\r\n\r\n") + 4) + 4 if head.count(b"\r\n\r\n") >= 2 else len(head)

        def payload(z=z, rest=head[cut:], begin=at + used, left=at + whole - 8, body=body) -> bytes:
            f.seek(begin)
            return (rest + z.decompress(f.read(max(0, left - begin))) + z.flush())[: body - 4]

        yield head[:cut], payload
        at += whole


def aligned(f, start: int, end: int) -> int | None:
    """The first member at or after ``start`` whose own length leads to another member or the end."""
    if not start:
        return 0
    size, at, step = f.size(), start, 1 << 20
    while at < end:
        f.seek(at)
        block = f.read(step + _HEAD)
        i = block.find(_MAGIC)
        while i >= 0 and at + i < end:
            f.seek(at + i + len(_MAGIC))
            whole = struct.unpack("<Q", f.read(8).ljust(8, b"\0"))[0]
            if at + i + whole == size:
                return at + i
            if _HEAD < whole and at + i + whole < size:
                f.seek(at + i + whole)
                if f.read(len(_MAGIC)) == _MAGIC:
                    return at + i
            i = block.find(_MAGIC, i + 1)
        at += step
    return None


def plain(f, packed: bool):
    """(header block, function that gives the block) of the records of another writer's archive."""
    import gzip
    import io

    f.seek(0)
    stream = gzip.GzipFile(fileobj=f) if packed else io.BufferedReader(f)
    while True:
        head = b""
        while not head.endswith(b"\r\n\r\n"):
            line = stream.readline()
            if not line:
                return
            if head or line.strip():
                head += line
        length = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
        block = stream.read(length)
        yield head, lambda block=block: block


def read_warc(spark: SparkSession, paths: list[str], payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("paths", "\n".join(paths)).option("payload", str(payload).lower()).load()


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, then read all records back; what is stored of a response is measured on its payload."""
    paths = write_warc(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    r = read_warc(spark, paths)
    full = F.col("record_type") == "response"

    @F.pandas_udf("string")
    def digest(payload):
        return payload.map(lambda x: None if x is None else base64.b32encode(hashlib.sha1(x).digest()).decode())

    return r.select(
        "page_id",
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, digest("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLE = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) || '0' AS x, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes,
            list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x || '0', (5 * i) // 4 + 1, 3))::INT >> (7 - (5 * i) % 4)) & 31), 1) FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
            CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN keep <> page_id THEN keep END AS refers_to
        FROM h""",
}
