"""Token ids in binary files: frequency ranks, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus (0: most frequent), so that common ids
take one byte.  A block of a file holds whole documents: their ids and token counts,
then control bytes with four 2-bit lengths each, then the data bytes, one to four for
each token.  A table from control byte to lengths decodes a block in numpy.

The ranks are written once beside the files (``ranks.bin``: little-endian uint32 ids,
most frequent first).  Files are in ascending order of doc_id (null first; equal ids by
their tokens); ``start`` counts the tokens of all documents before.  Ids of documents are integers.

Encoding looks up units (a run of white space with the run of other characters that
follows): byte-level BPE of this kind splits before every run of white space, so units
can be encoded apart.  A worker remembers CACHE_UNITS of them, about, some 200 bytes each;
half of these are forgotten if they weren't met for as many new ones.

Defined results: null and empty texts have the end id only; repeated rows are repeated
documents; an empty table gives no files; only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, make_dir, put_file, shared_dir, written

MAGIC = b"RVB1"
END_ID = 2
#: Tokens of a block, about, and tokens after which a task begins another file.
BLOCK_TOKENS, FILE_TOKENS = 1 << 20, 1 << 24
CACHE_UNITS = 1_600_000
UNIT = re.compile(r"\s*\S+|\s+")
#: White space other than the space and the line feed, as ASCII and others.
SPACES = tuple(map(chr, (9, 11, 12, 13, 28, 29, 30, 31)))
WIDE_SPACES = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Signs that, behind letters and before white space, are always a part of their own.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: From here on, letters of later versions of Unicode may not be letters to the library.
LATER_LETTERS = "\u0250"
HEAD = struct.Struct("<4sIIII")


def byte_names() -> dict[int, str]:
    """Names of bytes in a byte-level vocabulary: printing Latin-1 as it is, the rest from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_NAMES = byte_names()

LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def plain(text: str) -> bool:
    """Whether single spaces and line feeds within it are all the white space of a text."""
    if text[0].isspace() or text[-1].isspace() or any(x in text for x in ("  ", " \n", "\n ", "\n\n")):
        return False
    return not any(x in text for x in (SPACES if text.isascii() else SPACES + WIDE_SPACES))


def units(text: str, special: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """(first part, the parts after it) of a text, which the tokenizer encodes independently.

    A later part is a unit without its white space where that is one space, and else
    the whole unit; no other part begins with a character that isn't white space.
    """
    if any(s in text for s in special):
        return text, []
    if not plain(text):
        first, *rest = UNIT.findall(text)
        return first, [u[1:] if u[0] == " " and u[1:2].strip() else u for u in rest]
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


class _Bare(dict):
    """text -> ids of a text as it is, found when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        got = self[text] = struct.pack(f"<{len(ids)}I", *ids)
        return got


class _Parts(dict):
    """Later part, as ``units`` gives it -> its ids, found when first asked for.

    Letters, then signs, are encoded apart, other parts as they are.  The library's model
    takes a word of old letters directly, in the names of its bytes, behind a space: the
    pre-tokenizer leaves it whole.
    """

    def __init__(self, tokenizer, bare: _Bare):
        super().__init__()
        self.tokenize, self.bare, self.old = tokenizer.model.tokenize, bare, {}

    def word(self, w: str) -> bytes:
        if w.isascii():
            name = "Ġ" + w
        elif max(w) < LATER_LETTERS:
            name = "Ġ" + w.encode().decode("latin-1").translate(BYTE_NAMES)
        else:
            return self.bare[" " + w]
        ids = [t.id for t in self.tokenize(name)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, u: str) -> bytes:
        got = self.old.get(u)
        if got is None:
            if u.isalpha():
                got = self.word(u)
            else:
                core = u[1:] if u[0] == "\n" else u
                word = core.rstrip(SIGNS)
                if not word.isalpha():
                    got = self.bare[u if u[0].isspace() else " " + u]
                else:
                    got = self.bare["\n"] + self.bare[word] if u[0] == "\n" else self[word]
                    if len(core) > len(word):
                        got += self.bare[core[len(word) :]]
        self[u] = got
        return got

    def turn(self) -> None:
        """Forget what wasn't asked for since the last turn."""
        self.old = dict(self)
        self.clear()


class Encoder:
    """text -> ids as little-endian uint32 bytes, remembering CACHE_UNITS parts at most, about."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.bare = _Bare(self.tokenizer)
        self.known = _Parts(self.tokenizer, self.bare)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE_UNITS // 2:
            self.known.turn()
        if len(self.bare) > CACHE_UNITS // 4:
            self.bare.clear()
        known, out = self.known.__getitem__, []
        for t in texts:
            first, rest = units(t, self.special) if t else ("", [])
            out.append((self.bare[first] if first else b"") + b"".join(map(known, rest)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker, which its tasks share."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, at_once: int = 256) -> DataFrame:
    """(doc_id, n, crc, ids): ids as zstandard-packed little-endian uint32."""
    end = struct.pack("<I", end_id)

    def encode(batches):
        coder, pack = encoder(tokenizer), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for i in range(0, batch.num_rows, at_once):
                some = batch.slice(i, at_once)
                got = [x + end for x in coder.encode(some.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array([len(x) // 4 for x in got], pa.int64()), pa.array([zlib.crc32(x) for x in got], pa.int64()), pa.array([pack(_shorter(x)) for x in got], pa.binary())],
                    ["doc_id", "n", "crc", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, crc long, ids binary")


def _shorter(ids: bytes) -> bytes:
    """Low halves of the ids, then the high halves: packs better than whole ids."""
    a = np.frombuffer(ids, "<u2").reshape(-1, 2)
    return a[:, 0].tobytes() + a[:, 1].tobytes()


def _longer(halves: bytes) -> np.ndarray:
    a = np.frombuffer(halves, "<u2")
    return a[: len(a) // 2].astype(np.uint32) | a[len(a) // 2 :].astype(np.uint32) << np.uint32(16)


def frequency_ranks(tokens: DataFrame) -> np.ndarray:
    """Ids by descending count, then ascending: no more than the vocabulary has."""

    def count(batches):
        total = np.zeros(1, np.int64)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                n = np.bincount(np.concatenate([_longer(unpack(x)) for x in batch.column("ids").slice(i, 256).to_pylist()]))
                if len(n) > len(total):
                    n, total = total, n
                total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    rows = rows.sort_values(["n", "id"], ascending=[False, True])
    return rows["id"].to_numpy(np.uint32)


def pack_block(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    """Header, validity and ids of the documents, token counts, control bytes, data bytes."""
    n = len(ranks)
    padded = np.zeros(-(-n // 4) * 4, np.uint32)
    padded[:n] = ranks
    length = 1 + (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    quads = (length - 1).reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    raw = padded.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < length[:, None]]
    parts = [np.array([d is not None for d in doc_ids], np.uint8).tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(counts, "<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()]
    return HEAD.pack(MAGIC, len(doc_ids), n, len(control), len(data)) + b"".join(parts)


def unpack_block(read) -> tuple[list[int | None], np.ndarray, np.ndarray] | None:
    """(doc ids, token counts, ranks) of the next block; ``read(n)`` gives n bytes."""
    head = read(HEAD.size)
    if not head:
        return None
    magic, docs, n, controls, size = HEAD.unpack(head)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    valid, ids = np.frombuffer(read(docs), np.uint8), np.frombuffer(read(8 * docs), "<i8")
    counts = np.frombuffer(read(4 * docs), "<u4")
    length = LENGTHS[np.frombuffer(read(controls), np.uint8)].reshape(-1)
    data = np.frombuffer(read(size), np.uint8)
    at = np.cumsum(length, dtype=np.int64) - length
    ranks = data[at].astype(np.uint32) if len(at) else np.empty(0, np.uint32)
    for i in range(1, 4):
        more = np.flatnonzero(length > i)
        if len(more):
            ranks[more] |= data[at[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return [int(d) if v else None for d, v in zip(ids, valid, strict=True)], counts, ranks[:n]


def write_files(tokens: DataFrame, folder: str) -> DataFrame:
    """(path, part, seq, n): files of ``tokens`` (as from ``encoded``) in order of part and seq."""
    make_dir(folder)
    ranks = frequency_ranks(tokens)
    put_file(f"{folder}/ranks.bin", ranks.astype("<u4").tobytes())
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def write(batches):
        ids, unpack = shared.value, zstandard.ZstdDecompressor().decompress
        rank_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
        rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
        part, seq, blocks, total = TaskContext.get().partitionId(), 0, [], 0
        docs, counts, parts, n = [], [], [], 0

        def flush():
            nonlocal docs, counts, parts, n, total
            if docs:
                blocks.append(pack_block(docs, counts, rank_of[np.concatenate(parts)]))
                total += n
                docs, counts, parts, n = [], [], [], 0

        def close():
            nonlocal blocks, total, seq
            path = f"{folder}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex[:12]}.tok"
            put_file(path, b"".join(blocks))
            row = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([total], pa.int64())], ["path", "part", "seq", "n"])
            blocks, total, seq = [], 0, seq + 1
            return row

        for batch in batches:
            for doc_id, packed in zip(batch.column("doc_id"), batch.column("ids"), strict=True):
                own = _longer(unpack(packed.as_py()))
                docs.append(doc_id.as_py()), counts.append(len(own)), parts.append(own)
                n += len(own)
                if n >= BLOCK_TOKENS:
                    flush()
                    if total >= FILE_TOKENS:
                        yield close()
        flush()
        if blocks:
            yield close()

    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(parts, "doc_id", "crc", "n").sortWithinPartitions("doc_id", "crc", "n")
    return written(ordered.select("doc_id", "ids").mapInArrow(write, "path string, part long, seq long, n long"), f"{folder}-list")


def read_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    # one row a file: their token counts, in order, give where each file starts
    rows = sorted(files.select("part", "seq", "path", "n").collect())
    at, starts = 0, []
    for _, _, path, n in rows:
        starts.append((path, at))
        at += n

    def read(batches):
        system, name = filesystem(f"{folder}/ranks.bin")
        with system.open_input_stream(name, compression=None) as f:
            ids = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for path, start in zip(batch.column("path"), batch.column("start"), strict=True):
                start = start.as_py()
                system, name = filesystem(path.as_py())
                with system.open_input_stream(name, compression=None) as f:
                    while block := unpack_block(f.read):
                        docs, counts, ranks = block
                        own = ids[ranks]
                        ends = np.cumsum(counts, dtype=np.int64)
                        raw = own.astype("<u4").tobytes()
                        crcs = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                        columns = [pa.array(docs, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(own, pa.int64())))
                        start += int(ends[-1])
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    spark = files.sparkSession
    parts = max(1, min(len(starts), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spread = spark.createDataFrame(starts, "path string, start long").repartition(parts)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def token_files(docs: DataFrame, tokenizer: str) -> tuple[DataFrame, str]:
    """Write ``docs`` as token files: (their list, their folder)."""
    folder = shared_dir(docs.sparkSession)
    tokens = written(encoded(docs, tokenizer), f"{folder}/ids", "none")
    return write_files(tokens, f"{folder}/files"), f"{folder}/files"
