"""SentencePiece encoding and decoding over a relational lattice.

The distinct units of the corpus are exploded into their substrings of bounded length;
an equi-join with the piece table (the vocabulary, so small enough to broadcast) leaves
the edges of each unit's lattice; grouped by unit they are folded by Spark's
higher-order ``aggregate`` into the ends of the unit's pieces.

For a unigram model the fold is Viterbi over edges in order of their ends: of equal
scores the edge that starts first stays.  For a model made by merging pairs no sum of
scores gives the library's ids, so the fold takes the edges in merge order and keeps
those whose ends are still ends of pieces, as ``pieces`` explains.  Units of any length
take the same way; the fold copies its state, so its time grows with the square of a
unit's length.

Units travel packed: a row holds those of one block and one bucket, so that what is
written and shuffled is a few bytes a unit; back they travel as ids alone, which name
their unit.  A block is a fixed number of rows of a file, whatever splits it is read in;
a bucket is a hash of the unit, and one task segments a bucket.  The segmented units
come back to the documents as one file a block.

Defined results: null and empty texts have no pieces; a character without a piece becomes
its bytes; decoding gives the text back but for "▁" in it, which becomes a space; repeated
rows are encoded alike, and rows with null ids as others; columns other than doc_id and
text are not read by ``encode``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, filesystem, make_dir, put_file, shared_dir, written
from .pieces import SPACE, Pieces, load, parts, units, units_of

#: Rows of a block, distinct units that are held before they leave a task, and documents looked up together.
BLOCK_ROWS, UNITS_AT_ONCE, DOCS_AT_ONCE = 4096, 500_000, 500
#: Buckets for each of the session's shuffle partitions.
SPREAD = 4


def in_blocks(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, text and block: a key of the file and its BLOCK_ROWS rows that a row is one of."""
    part = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("block")
    try:
        return docs.select("doc_id", "text", part)
    except AnalysisException:  # not read from files as they are
        return written(docs.select("doc_id", "text"), f"{folder}/docs").select("doc_id", "text", part)


def block_units(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, units): the distinct units of each block, or nearly, sorted, with a space between."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, odd = None, set(), set()

        def out():
            for p in held:
                odd.update(units_of(p))
            held.clear()
            dealt: list[list[str]] = [[] for _ in range(buckets)]
            for u in sorted(odd):
                dealt[zlib.crc32(u.encode()) % buckets].append(u)
            odd.clear()
            rows = [(i, " ".join(us)) for i, us in enumerate(dealt) if us]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["bucket", "block", "units"])

        for batch in batches:
            for own, text in zip(batch.column("block").to_pylist(), batch.column("text"), strict=True):
                if (held or odd) and (own != block or len(held) + len(odd) > UNITS_AT_ONCE):
                    yield out()
                block = own
                if text := text.as_py():
                    plain = parts(text)
                    if plain is None:
                        odd.update(units(text))
                    else:
                        held.update(plain)
        if held or odd:
            yield out()

    return docs.select("block", "text").mapInArrow(split, "bucket int, block long, units string")


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """(piece, rank, score): rank orders merges; single characters are no merges."""
    ranks = pieces.ranks()
    rows = [(p, ranks.get(p), s) for p, s in pieces.scores.items() if p in ranks or not pieces.merges]
    return spark.createDataFrame(rows, "piece string, rank long, score double")


def longest_from(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """(head, longest): for each two first characters of pieces, the length of the longest."""
    longest: dict[str, int] = {}
    for p in pieces.scores:
        if len(p) > 1:
            longest[p[:2]] = max(longest.get(p[:2], 0), len(p))
    return spark.createDataFrame(list(longest.items()), "head string, longest int")


def edges_of(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(bucket, unit, s, k, rank, score): the lattice's edges, from place s over k characters.

    Edges of one character are left out where merges are wanted: they hold from the start.
    """
    spark = words.sparkSession
    starts = words.select("bucket", "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("s"))
    heads = starts.withColumn("head", F.substr("unit", F.col("s") + 1, F.lit(2)))
    kind = "inner" if pieces.merges else "left"
    heads = heads.join(F.broadcast(longest_from(spark, pieces)), "head", kind)
    most = F.least(F.coalesce("longest", F.lit(1)), F.length("unit") - F.col("s"))
    heads = heads.filter(F.length("unit") - F.col("s") > 1) if pieces.merges else heads
    spans = heads.select("bucket", "unit", "s", F.explode(F.sequence(F.lit(2 if pieces.merges else 1), most)).alias("k"))
    substrings = spans.select("bucket", "unit", "s", "k", F.substr("unit", F.col("s") + 1, F.col("k")).alias("piece"))
    edges = substrings.join(F.broadcast(piece_table(spark, pieces)), "piece", kind)
    return edges if pieces.merges else edges.filter("score is not null or k = 1")


def merged(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(bucket, unit, ends): one byte for each place of a unit, "1" where a piece begins; by merge order.

    An edge is one number: rank, start and length from its high bits down, so sorting
    numbers puts edges in merge order.
    """
    edge = F.shiftleft("rank", 44).bitwiseOR(F.shiftleft(F.col("s").cast("long"), 8)).bitwiseOR(F.col("k").cast("long"))
    lattice = edges_of(words, pieces).groupBy("bucket", "unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    one, zeros = F.lit(b"1"), F.lit(b"0" * 255)

    def fold(ends: Column, x: Column) -> Column:
        s, k = F.shiftright(x, 8).bitwiseAND(2**36 - 1).cast("int"), x.bitwiseAND(255).cast("int")
        apart = (F.substr(ends, s + 1, F.lit(1)) == one) & (F.substr(ends, s + k + 1, F.lit(1)) == one)
        return F.when(apart, F.overlay(ends, F.substr(zeros, F.lit(1), k - 1), s + 2, k - 1)).otherwise(ends)

    start = F.encode(F.repeat(F.lit("1"), F.length("unit") + 1), "US-ASCII")
    return lattice.select("bucket", "unit", F.aggregate("edges", start, fold).alias("ends"))


def best_sums(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(bucket, unit, ends) by the best sum of scores: Viterbi."""
    edge = F.struct((F.col("s") + F.col("k")).alias("e"), "s", F.coalesce("score", F.lit(pieces.unk_score)).alias("score"))
    lattice = edges_of(words, pieces).groupBy("bucket", "unit").agg(F.array_sort(F.collect_list(edge)).alias("edges"))
    state = "array<struct<score:double,s:int>>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("s"))).cast(state)

    def fold(best: Column, x: Column) -> Column:
        score = F.get(best, x["s"])["score"] + x["score"]
        here = F.array(F.struct(score.alias("score"), x["s"].alias("s"))).cast(state)
        return F.when(F.size(best) <= x["e"], F.concat(best, here)).when(score > F.get(best, x["e"])["score"], F.concat(F.slice(best, 1, x["e"]), here)).otherwise(best)

    best = lattice.select("bucket", "unit", F.aggregate("edges", start, fold).alias("best"))
    path = "struct<at:int,ends:binary>"
    last = F.struct(F.length("unit").alias("at"), F.lit(b"1").alias("ends")).cast(path)

    def back(a: Column, _: Column) -> Column:
        s = F.get(F.col("best"), a["at"])["s"]
        span = F.overlay(F.encode(F.repeat(F.lit("0"), a["at"] - s), "US-ASCII"), F.lit(b"1"), F.lit(1), F.lit(1))
        return F.when(a["at"] <= 0, a).otherwise(F.struct(s.alias("at"), F.concat(span, a["ends"]).alias("ends")).cast(path))

    return best.select("bucket", "unit", F.aggregate(F.sequence(F.lit(1), F.length("unit")), last, back)["ends"].alias("ends"))


def distinct_units(packed: DataFrame) -> DataFrame:
    """(bucket, units) as in ``packed``, whose rows are sorted by bucket: each unit about once a bucket."""

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, set()

        def out():
            row = pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([" ".join(sorted(held))], pa.string())], ["bucket", "units"])
            held.clear()
            return row

        for batch in batches:
            for own, names in zip(batch.column("bucket").to_pylist(), batch.column("units"), strict=True):
                if held and (own != bucket or len(held) > UNITS_AT_ONCE):
                    yield out()
                bucket = own
                held.update(names.as_py().split(" "))
        if held:
            yield out()

    return packed.select("bucket", "units").mapInArrow(unite, "bucket int, units string")


def segmented(packed: DataFrame, pieces: Pieces, buckets: int) -> DataFrame:
    """(bucket, unit, ends) of every distinct unit of ``packed`` that has an edge: one shuffle."""
    words = distinct_units(packed).repartitionById(buckets, F.col("bucket"))
    words = words.select("bucket", F.explode(F.split("units", " ")).alias("unit")).distinct()
    return (merged if pieces.merges else best_sums)(words, pieces)


def _planes(a: np.ndarray) -> bytes:
    """Bytes of small 32-bit numbers, put together by significance."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


class Names:
    """The bytes that each id stands for, for joining many at once; the last place is a space."""

    def __init__(self, pieces: Pieces, spaces: bool = False):
        raw = [n.replace(SPACE, " ").encode() if spaces else n.encode() for n in pieces.names] + [b" "]
        if pieces.bytes_at is not None:
            raw[pieces.bytes_at : pieces.bytes_at + 256] = [bytes([b]) for b in range(256)]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat, self.space = np.frombuffer(b"".join(raw), np.uint8), len(raw) - 1

    def join(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' bytes one after the other, and where each id's end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at].tobytes(), ends


def _packed_ids(ids: list[bytes], names: str = "") -> bytes:
    """How many ids each unit has, and the ids (little-endian, 32 bits); the units' names if ids don't tell them."""
    flat, raw = np.frombuffer(b"".join(ids), "<u4"), names.encode()
    counts = np.fromiter(map(len, ids), "<u4", len(ids)) // np.uint32(4)
    sizes = np.array([len(raw), len(counts), len(flat)], "<u4")
    return zstandard.compress(sizes.tobytes() + raw + _planes(counts) + _planes(flat), 3)


def _unpacked_ids(packed: bytes, names: Names) -> tuple[list[str], list[bytes]]:
    """The units, and the ids of each."""
    raw = zstandard.decompress(packed)
    size, n, m = np.frombuffer(raw[:12], "<u4").tolist()
    at = 12 + size
    counts, flat = _from_planes(raw[at : at + 4 * n]), _from_planes(raw[at + 4 * n : at + 4 * (n + m)])
    ends = np.cumsum(counts, dtype=np.int64)
    known = raw[12:at].decode() or names.join(np.insert(flat, ends[:-1], names.space))[0].decode()
    data, cuts = flat.tobytes(), [0, *(4 * ends).tolist()]
    return known.split(" "), list(map(data.__getitem__, map(slice, cuts, cuts[1:])))


class _Ids(dict):
    """unit -> its ids; units that have no edge are single characters apart."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, unit: str) -> bytes:
        ids = [i for c in unit for i in self.pieces.ids_of(c)]
        got = self[unit] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def odd(self, names: list[str]) -> str:
        """The units with a space between, if an unknown character hides the name of one."""
        if self.pieces.bytes_at is not None:
            return ""
        unknown = struct.pack("<I", self.pieces.unk)
        return " ".join(names) if any(unknown in (x[i : i + 4] for i in range(0, len(x), 4)) for x in map(self.__getitem__, names)) else ""


def write_buckets(found: DataFrame, folder: str, pieces: Pieces) -> None:
    """A file of units and their ids for each bucket of ``found``, which has a bucket in one task."""
    make_dir(folder)
    shared = found.sparkSession.sparkContext.broadcast(pieces)

    def write(batches):
        held: dict[int, list[tuple[str, bytes]]] = {}
        known = _Ids(shared.value)
        for piece in known.pieces.scores:
            known[piece] = struct.pack("<I", known.pieces.ids[piece])
        of = known.__getitem__
        for batch in batches:
            for bucket, unit, ends in zip(*(batch.column(c).to_pylist() for c in ("bucket", "unit", "ends")), strict=True):
                at, ids = 0, []
                while at < len(unit):
                    end = ends.index(b"1", at + 1)
                    ids.append(of(unit[at:end]))
                    at = end
                held.setdefault(bucket, []).append((unit, b"".join(ids)))
        for bucket, rows in held.items():
            rows.sort()
            # small files that are read whole: names as they are
            put_file(f"{folder}/{bucket}", _packed_ids([r[1] for r in rows], " ".join([r[0] for r in rows])))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], ["bucket"])

    written(found.select("bucket", "unit", "ends").mapInArrow(write, "bucket int"), f"{folder}-list")


def _read_file(path: str) -> bytes:
    system, name = filesystem(path)
    with system.open_input_stream(name, compression=None) as f:
        return f.read()


def _has_file(path: str) -> bool:
    system, name = filesystem(path)
    return system.get_file_info(name).is_file


def write_blocks(packed: DataFrame, words: str, folder: str, pieces: Pieces) -> None:
    """A file for each block of ``packed``, which is sorted by bucket, with the ids of its units."""
    make_dir(folder)
    shared = packed.sparkSession.sparkContext.broadcast(pieces)

    def look_up(batches):
        own, bucket, known = shared.value, None, None
        names = Names(own)
        for batch in batches:
            for b, block, us in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "units")), strict=True):
                if b != bucket:
                    bucket, known = b, _Ids(own)
                    if _has_file(f"{words}/{b}"):  # none if no unit of the bucket has an edge
                        known.update(zip(*_unpacked_ids(_read_file(f"{words}/{b}"), names), strict=True))
                us = us.split(" ")
                part = _packed_ids(list(map(known.__getitem__, us)), known.odd(us))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.binary())], ["block", "part"])

    def write(batches):
        block, parts = None, []

        def close():
            put_file(f"{folder}/{block}", np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64())], ["block"])

        for batch in batches:
            for own, part in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if parts and own != block:
                    yield close()
                    parts = []
                block = own
                parts.append(part)
        if parts:
            yield close()

    parts = packed.mapInArrow(look_up, "block long, part binary")
    n = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written(parts.repartition(n, "block").sortWithinPartitions("block").mapInArrow(write, "block long"), f"{folder}-list")


class _Block(dict):
    """part -> ids, of a block's units; ``others`` has the units that are no part of one unit."""

    def __init__(self, path: str, names: Names):
        super().__init__()
        self.others: dict[str, bytes] = {}
        data = _read_file(path)
        n = int(np.frombuffer(data[:4], "<u4")[0])
        at = 4 + 4 * n
        for size in np.frombuffer(data[4:at], "<u4").tolist():
            for unit, ids in zip(*_unpacked_ids(data[at : at + size], names), strict=True):
                if unit[0] == SPACE and unit[1:2] != SPACE:
                    self[unit[1:]] = ids
                else:
                    self.others[unit] = ids
            at += size

    def __missing__(self, part: str) -> bytes:
        got = self[part] = b"".join(map(self.of_unit, units_of(part)))
        return got

    def of_unit(self, unit: str) -> bytes:
        return self.others[unit] if unit in self.others else self[unit[1:]]

    def of_text(self, text: str) -> bytes:
        plain = parts(text)
        return b"".join(map(self.of_unit, units(text))) if plain is None else b"".join(map(self.__getitem__, plain))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text, ids): every text's piece ids; ``model`` is the path of a model file."""
    return encode_with(docs, load(model))


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text, ids, decoded): ``encode`` and ``decode`` in one pass of Python workers."""
    return encode_with(docs, load(model), decoded=True)


def encode_with(docs: DataFrame, pieces: Pieces, decoded: bool = False) -> DataFrame:
    spark = docs.sparkSession
    folder = shared_dir(spark)
    docs = in_blocks(docs, folder)
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = block_units(docs, buckets).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "block")
    packed = written(packed, f"{folder}/units")
    write_buckets(segmented(packed, pieces, buckets), f"{folder}/words", pieces)
    write_blocks(packed, f"{folder}/words", f"{folder}/blocks", pieces)
    drop(spark, f"{folder}/units", f"{folder}/words")
    kind, shared = docs.schema["doc_id"].dataType.simpleString(), spark.sparkContext.broadcast(pieces)

    def look_up(batches):
        block, known, names, one = None, None, Names(shared.value), decoder(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                some, ids = batch.slice(i, DOCS_AT_ONCE), []
                for own, text in zip(some.column("block").to_pylist(), some.column("text"), strict=True):
                    text = text.as_py()
                    if text and own != block:
                        known = None  # before the next is there
                        block, known = own, _Block(f"{folder}/blocks/{own}", names)
                    ids.append(known.of_text(text) if text else b"")
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
                flat = np.frombuffer(b"".join(ids), "<i4")
                columns = [some.column("doc_id"), some.column("text"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    columns.append(pa.array(one(flat, ends), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "ids", "decoded"][: len(columns)])

    return docs.mapInArrow(look_up, f"doc_id {kind}, text string, ids array<int>" + ", decoded string" * decoded)


def decoder(pieces: Pieces):
    """(ids, ends) -> a text for each two ends: pieces joined, bytes put together, "▁" as spaces, the dummy prefix dropped."""
    names = Names(pieces, spaces=True)

    def decode(ids: np.ndarray, ends: np.ndarray) -> list[str]:
        data, at = names.join(ids)
        cuts = np.append(0, at)[ends].tolist()
        return [data[a:z].decode("utf-8", "replace").removeprefix(" ") for a, z in zip(cuts, cuts[1:], strict=False)]

    return decode


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (doc_id, text, ids) with ``decoded``, the text that the ids stand for."""
    return decode_with(encoded, load(model))


def decode_with(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        one = decoder(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(i, DOCS_AT_ONCE)
                lists = some.column("ids").fill_null([])
                ends = lists.offsets.to_numpy()
                texts = one(lists.values.to_numpy()[ends[0] : ends[-1]], ends - ends[0])
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "text", "ids").mapInArrow(run, f"doc_id {kind}, text string, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_hash, and whether decoding gave the text back."""
    same = F.coalesce("text", F.lit("")) == F.col("decoded")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), same.alias("round_trip"))
