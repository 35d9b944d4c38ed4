"""WARC: writing archives, and the normaliser for archives that are one gzip stream.

``write_archives`` writes pages as WARC/1.1 records, each file one whole gzip stream,
as naive tools make them.  ``normalise`` inflates such a stream once, front to back in
chunks, writes every record again as a gzip member of its own, and writes a sidecar
index of offsets beside the file.  ``read_records`` seeks by that index.

Files are written by tasks under names of their own and listed in a table only by
tasks that succeed, so a repeated task leaves at most files that nothing lists.

Defined results: a null html is an empty payload.  Of pages with equal payloads of
``min_bytes`` or more the one with the smallest page_id is the response (every row that
repeats that id and payload is), the others are revisits, null ids too unless all are
null; smaller payloads are responses.  Only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, make_dir, put_file, shared_dir, written

MIN_BYTES = 100
#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
#: Every record carries this date, so that equal pages give equal archives.
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record; a revisit has the digest and size of its payload, not the payload."""
    body = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if kind == "revisit":
        head.insert(4, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(5, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + END + body + END


def parse_head(head: bytes) -> dict[str, str]:
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, whole record) for each record of an uncompressed stream, one in memory at a time."""
    held = bytearray()

    def more() -> bool:
        chunk = next(chunks, None)
        if chunk is None:
            return False
        held.extend(chunk)
        return True

    while held or more():
        seen = 0
        while (at := held.find(END, max(0, seen - len(END)))) < 0:
            seen = len(held)
            if not more():
                raise ValueError("the stream ends within a header")
        head = parse_head(bytes(held[:at]))
        size = at + len(END) + int(head["content-length"]) + len(END)
        while len(held) < size:
            if not more():
                raise ValueError("the stream ends within a record")
        yield head, bytes(held[:size])
        del held[:size]


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Chunks of a gzip file's content; the file is one stream, or several members."""
    z = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            if out := z.decompress(chunk, CHUNK):
                yield out
            if z.eof:
                chunk, z = z.unused_data, zlib.decompressobj(31)
            else:
                chunk = z.unconsumed_tail
    while not z.eof and (out := z.decompress(z.unconsumed_tail, CHUNK)):
        yield out


def _read(path: str) -> Iterator[bytes]:
    system, name = filesystem(path)
    with system.open_input_stream(name, compression=None) as f:
        while chunk := f.read(CHUNK):
            yield chunk


def with_kind(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, digest, kind, refers_to for every page."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    big = pages.filter(F.length("payload") >= min_bytes)
    firsts = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).filter("c > 1").select("digest", "first")
    firsts = written(firsts, f"{folder}/firsts")
    known = pages.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return known.select("page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """(path, n): archives of one gzip stream each, from the rows of ``with_kind``."""
    make_dir(folder)

    def write(batches):
        part, n, size, z, out = TaskContext.get().partitionId(), 0, 0, None, []

        def close():
            path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
            put_file(path, b"".join([*out, z.flush()]))
            return pa.RecordBatch.from_pydict({"path": pa.array([path]), "n": pa.array([n], pa.int64())})

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "kind", "refers_to")), strict=True):
                z = z or zlib.compressobj(6, zlib.DEFLATED, 31)
                page_id, url, payload, *rest = (x.as_py() for x in row)
                out.append(z.compress(record_bytes(page_id, url, payload, *rest)))
                n, size = n + 1, size + len(payload)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    n, size, z, out = 0, 0, None, []
        if z:
            yield close()

    return written(pages.mapInArrow(write, "path string, n long"), f"{folder}-list")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """(path, n): archives with one gzip member a record.

    For every archive in ``path`` a file of the same name is written, and beside it a
    sidecar ``.idx`` with "offset size record-id kind" a line.
    """
    make_dir(folder)

    def rewrite(batches):
        for batch in batches:
            for source in batch.column("path"):
                source = source.as_py()
                path, at, out, index = f"{folder}/{source.rsplit('/', 1)[1]}", 0, [], []
                for head, record in records(inflated(_read(source))):
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(record) + z.flush()
                    out.append(member)
                    index.append(f"{at} {len(member)} {head['warc-record-id']} {head['warc-type']}\n")
                    at += len(member)
                put_file(path, b"".join(out))
                put_file(path + ".idx", "".join(index).encode())
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(index)], pa.int64())], ["path", "n"])

    spread = archives.select("path").repartition(max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return written(spread.mapInArrow(rewrite, "path string, n long"), f"{folder}-list")


def sidecar(path: str) -> list[tuple[int, int, str, str]]:
    """(offset, size, record id, kind) of each member of an archive, from the file beside it."""
    lines = b"".join(_read(path + ".idx")).decode().splitlines()
    return [(int(at), int(size), record_id, kind) for at, size, record_id, kind in (line.split(" ") for line in lines)]


def _page(urn: str | None):
    text = urn[len("<urn:page:") : -1] if urn else "None"
    return None if text == "None" else int(text)


def read_records(archives: DataFrame) -> DataFrame:
    """page_id, url, payload (null in revisits), payload_bytes, payload_digest, record_type, refers_to.

    Seeks to each member by the archive's sidecar; a response whose payload doesn't have
    its digest is an error.
    """

    def read(batches):
        for path in (p.as_py() for batch in batches for p in batch.column("path")):
            rows = []
            system, name = filesystem(path)
            with system.open_input_file(name) as f:
                for at, size, _, _ in sidecar(path):
                    f.seek(at)
                    ((head, record),) = records(iter([zlib.decompress(f.read(size), 31)]))
                    n, digest = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha256:")
                    payload = None
                    if head["warc-type"] == "response":
                        payload = record[len(record) - len(END) - int(head["content-length"]) : len(record) - len(END)]
                        if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {head['warc-record-id']} is damaged")
                    rows.append((_page(head["warc-record-id"]), head["warc-target-uri"], payload, n, digest, head["warc-type"], _page(head.get("warc-refers-to"))))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    spread = archives.select("path").repartition(max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return spread.mapInArrow(read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as whole-stream archives, normalise them, and return the list of the normalised ones."""
    folder = shared_dir(pages.sparkSession)
    whole = write_archives(with_kind(pages, f"{folder}/kinds"), f"{folder}/whole")
    return normalise(whole, f"{folder}/members")
