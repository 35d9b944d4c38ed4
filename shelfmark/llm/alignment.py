"""Cross-tokenizer alignment: which tokens of two tokenizers lie over the same bytes.

Tokenizer A is byte-level BPE, B a SentencePiece model; both get a space and the text.  All
tokens of both are sorted by where they begin (``lexsort``); a running maximum of their ends
(``maximum.accumulate``) breaks groups where a token begins at or behind everything before.
Within a group each token of A is expanded to the tokens of B that overlap it.

A text is encoded in units: it is cut before a space or line feed that follows another
character than white space.  A splits before every run of white space, and no piece of B
has a space or a line feed behind another character (``Tokenizers`` checks it), so both
encode units as they encode the whole text.  A worker aligns distinct units once, many at a
time, and remembers them; a document is then a list of units.  Beyond CACHE_UNITS units or
CACHE_BYTES it forgets all but those that most batches had, so its memory has a bound that
neither the number of documents nor long units raise.

How many documents hold an id pair linked is counted over the corpus.  Documents travel in
chunks of up to about CHUNK_PAIRS different (document, pair); of the pairs only one row a
chunk and pair is shuffled, to be counted and to come back to its chunk with its count, so a
pair that every document has is met once a chunk.  What a document has of the pairs travels
compressed, and is opened for one chunk at a time.  A document is never split.

Defined results: null and empty texts, and texts whose bytes one of the tokenizers changes
(for B: those with "▁"), have no tokens; repeated rows are documents of their own; an empty
table gives no rows; only doc_id and text are read, and doc_id, an integer, may be null.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, written
from .pieces import SPACE, load
from .token_files import BYTE_NAMES, plain

#: Of a worker's remembered units, and how much of that stays when it forgets; a unit takes UNIT_BYTES besides its own.
CACHE_UNITS, CACHE_BYTES, KEPT, UNIT_BYTES = 500_000, 64 << 20, 0.4, 220
CHUNK_PAIRS, CHUNK_DOCS = 400_000, 4_000
#: Texts that are handled together, and their bytes if there is more than one; units that are aligned together.
AT_ONCE, BYTES_AT_ONCE, UNITS_AT_ONCE = 256, 1 << 20, 8_192
UNIT = re.compile(r"(?<=\S)(?=[ \n])")
#: Bits of an id in a pair.
B_BITS = 21

CHUNK = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, n_pairs array<int>, held binary, pairs array<long>, n_docs array<long>"


def groups_of(a_end: np.ndarray, b_end: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each A token, of each B token): ``base`` has where A's and then B's tokens begin."""
    n_a = len(a_end)
    end = np.concatenate([a_end, b_end])
    order = np.lexsort((end, base))
    reach = np.maximum.accumulate(end[order])
    breaks = np.append(True, base[order][1:] >= reach[:-1]) if len(order) else np.empty(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:n_a], group[n_a:]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A tokens, B tokens) of all pairs that overlap; the tokens of each side are in order, without gaps."""
    first, behind = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = behind - first
    a = np.repeat(np.arange(len(a_start)), n)
    return a, spread(first, n)


def counted(of: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, pair, sum of times) of the different pairs of each ``of``, in order."""
    key = of << 2 * B_BITS | pair
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first] >> 2 * B_BITS, key[first] & (1 << 2 * B_BITS) - 1, np.add.reduceat(times[order], first) if len(key) else times


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each ``first`` the n places from there on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def extended(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` behind its first n; a full one is copied to one with room for half as many again."""
    if n + len(more) > len(held):
        room = np.empty(((n + len(more)) * 3 // 2, *held.shape[1:]), held.dtype)
        room[:n] = held[:n]
        held = room
    held[n : n + len(more)] = more
    return held


class Tokenizers:
    """Both tokenizers, with the number of bytes and the bytes of each token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        of = {BYTE_NAMES.get(b, chr(b)): bytes([b]) for b in range(256)}
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for name, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = b"".join(of[c] for c in name) if all(c in of for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        table = load(b_path)  # raises if a piece reaches over the ends of units
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(table.names)]
        # behind a line feed B adds no space, and its two tokens before the unit can be left out
        if self.b.encode("\n") != [table.ids.get(SPACE), self.b.piece_to_id("<0x0A>")]:
            raise ValueError("B doesn't encode a line feed as a space and a byte")
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << B_BITS:
            raise ValueError("a vocabulary has too many ids")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    def same(self, units: list[str], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether the bytes of each unit's tokens are the unit's, on both sides."""
        given = [u.encode("utf-8", "replace") for u in units]
        whole, sizes = b"".join(given), list(map(len, given))
        for ids, names in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(names.__getitem__, chain.from_iterable(ids))) != whole:
                return False
            size = np.append(0, np.cumsum((self.a_size if ids is a else self.b_size)[np.fromiter(chain.from_iterable(ids), np.int64)]))
            if np.diff(size[np.append(0, np.cumsum(list(map(len, ids))))]).tolist() != sizes:
                return False
        return True

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)], [x[2:] for x in self.b.encode(["\n" + u for u in units])]


class Units(dict):
    """unit -> its number, of units that were aligned; -1: its bytes differ.  ``facts`` and others are by number.

    Arrays have room behind the ``len(text)`` units and their pairs.
    """

    def __init__(self, tokenizers: Tokenizers):
        super().__init__()
        self.tokenizers = t = tokenizers
        # each id behind its side's beginning, and what follows it: in a side, between sides, between groups
        self.names = [f"{i}{sep}" for size in (len(t.a_bytes), len(t.b_bytes)) for i in range(size) for sep in ",|;"]
        self.widths = np.array(list(map(len, self.names)))
        self.text: list[bytes] = []
        self.facts, self.used = np.zeros((0, 4), np.int32), np.zeros(0, np.int32)
        self.pair_at, self.pairs, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.size = 0

    def forget(self) -> None:
        """Forget all but the units that most batches had, of KEPT of the bounds together, and none that one batch had."""
        n = len(self.text)
        n_pairs = np.diff(self.pair_at[: n + 1])
        size = n_pairs * 12 + np.fromiter(map(len, self.text), np.int64, n) * 2
        order = np.argsort(-self.used[:n], kind="stable")
        order = order[self.used[order] > 1][: int(CACHE_UNITS * KEPT)]
        kept = np.sort(order[np.cumsum(size[order] + UNIT_BYTES) <= CACHE_BYTES * KEPT])
        number = np.full(n, -1)
        number[kept] = np.arange(len(kept))
        number = number.tolist()
        units = {u: number[i] for u, i in self.items() if i >= 0 and number[i] >= 0}
        self.clear()
        self.update(units)
        self.text = [self.text[i] for i in kept.tolist()]
        self.facts, self.used = self.facts[kept], self.used[kept] // 2
        at = spread(self.pair_at[kept], n_pairs[kept])
        self.pairs, self.times, self.pair_at = self.pairs[at], self.times[at], np.append(0, np.cumsum(n_pairs[kept]))
        self.size = int(size[kept].sum()) + UNIT_BYTES * len(kept)

    def learn(self, units: list[str]) -> None:
        """Align ``units``, which are not known yet, all in one go."""
        self.size += UNIT_BYTES * len(units)
        t = self.tokenizers
        a, b = t.encode(units)
        if not t.same(units, a, b):
            alike = [t.same(*x) for x in zip(*[[[y] for y in x] for x in (units, a, b)], strict=True)]
            self.update((u, -1) for u, ok in zip(units, alike, strict=True) if not ok)
            self.size += sum(2 * len(u) for u, ok in zip(units, alike, strict=True) if not ok)
            units, a, b = ([y for y, ok in zip(x, alike, strict=True) if ok] for x in (units, a, b))
        if not units:
            return
        n, known = len(units), len(self.text)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, n) for x in (a, b))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        a_end, b_end = np.cumsum(t.a_size[a_ids]), np.cumsum(t.b_size[b_ids])  # a unit's bytes follow those of the one before
        a_start, b_start = a_end - t.a_size[a_ids], b_end - t.b_size[b_ids]
        a_group, b_group = groups_of(a_end, b_end, np.concatenate([a_start, b_start]))
        firsts = np.append(0, np.cumsum(n_a))
        n_groups = a_group[firsts[1:] - 1] - a_group[firsts[:-1]] + 1
        x, y = overlaps(a_start, a_end, b_start, b_end)
        unit = np.repeat(np.arange(n), n_a)[x]
        of, pair, times = counted(unit, a_ids[x] << B_BITS | b_ids[y], np.ones(len(x), np.int64))
        held = int(self.pair_at[known])
        self.pairs, self.times = extended(self.pairs, held, pair), extended(self.times, held, times)
        self.pair_at = extended(self.pair_at, known + 1, held + np.cumsum(np.bincount(of, minlength=n)))
        self.facts = extended(self.facts, known, np.stack([n_a, n_b, n_groups, np.bincount(unit, minlength=n)], 1))
        self.used = extended(self.used, known, np.zeros(n, np.int32))
        self.update(zip(units, range(known, known + n), strict=True))
        texts = self._texts(a_ids, a_group, b_ids, b_group, np.cumsum(n_a + n_b))
        self.text += texts
        self.size += 12 * len(pair) + 2 * sum(map(len, texts))

    def _texts(self, a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The text of each unit's groups: ``a1,a2|b1;a3|b2,b3;``."""
        place = np.concatenate([a_group * 2, b_group * 2 + 1])
        order = np.argsort(place, kind="stable")
        place = np.append(place[order], place[order[-1]] + 1)
        follows = np.where(place[1:] == place[:-1], 0, 2 - (place[:-1] & 1 == 0))
        code = np.concatenate([a_ids, b_ids + len(self.tokenizers.a_bytes)])[order] * 3 + follows
        whole = "".join(map(self.names.__getitem__, code.tolist())).encode()
        cuts = np.append(0, np.cumsum(self.widths[code])[ends - 1]).tolist()
        return [whole[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    def numbers(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The numbers of the units of each text; None: it has no tokens."""
        if len(self) > CACHE_UNITS or self.size > CACHE_BYTES:
            self.forget()
        cut = [units(t) if t else None for t in texts]
        new = sorted({u for c in cut if c for u in c if u not in self})
        for i in range(0, len(new), UNITS_AT_ONCE):
            self.learn(new[i : i + UNITS_AT_ONCE])
        out, met = [], np.zeros(len(self.text), bool)
        for c in cut:
            x = np.fromiter(map(self.__getitem__, c), np.int64, len(c)) if c else None
            out.append(None if x is None or x.min() < 0 else x)
            if out[-1] is not None:
                met[x] = True
        self.used[: len(met)] += met
        return out


def units(text: str) -> list[str]:
    """A space and the text, cut before spaces and line feeds that follow other characters."""
    if not plain(text):
        return UNIT.split(" " + text)
    first, *rest = text.split("\n")
    out = [" " + w for w in first.split(" ")]
    for line in rest:
        head, *words = line.split(" ")
        out.append("\n" + head)
        out += [" " + w for w in words]
    return out


_OWN: dict[tuple[str, str], Units] = {}


def known_units(a_path: str, b_path: str) -> Units:
    """One for each Python worker, which its tasks share."""
    if (a_path, b_path) not in _OWN:
        _OWN[a_path, b_path] = Units(Tokenizers(a_path, b_path))
    return _OWN[a_path, b_path]


def forget_units() -> None:
    """Give back what a Python worker remembers."""
    _OWN.clear()


class _Chunk:
    def __init__(self):
        self.docs: list[tuple] = []
        self.n_pairs: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, numbers: list[np.ndarray | None], known: Units) -> None:
        held = [x for x in numbers if x is not None]
        doc = np.repeat(np.flatnonzero([x is not None for x in numbers]), list(map(len, held)))
        unit = np.concatenate([*held, np.zeros(0, np.int64)])
        facts = np.zeros((len(ids), 4), np.int64)
        np.add.at(facts, doc, known.facts[unit].astype(np.int64))
        doc, unit, count = counted(doc, unit, np.ones(len(unit), np.int64))
        first, n = known.pair_at[unit], known.pair_at[unit + 1] - known.pair_at[unit]
        at = spread(first, n)
        row, pair, times = counted(np.repeat(doc, n), known.pairs[at], known.times[at] * np.repeat(count, n))
        self.n_pairs.append(np.bincount(row, minlength=len(ids)))
        self.pairs.append(pair)
        self.times.append(times)
        self.size += len(pair)
        for doc_id, of, fact in zip(ids, numbers, facts.tolist(), strict=True):
            sha = "" if of is None else hashlib.sha256(b"".join(map(known.text.__getitem__, of.tolist()))[:-1]).hexdigest()
            self.docs.append((doc_id, *fact, sha))

    def full(self) -> bool:
        return self.size >= CHUNK_PAIRS or len(self.docs) >= CHUNK_DOCS

    def batch(self, number: int) -> pa.RecordBatch:
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        pairs, at, n_docs = np.unique(join(self.pairs), return_inverse=True, return_counts=True)
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
        # a document's pairs are in order, so their places are small steps
        held = pa.compress(np.concatenate([np.diff(at, prepend=0), join(self.times)]).astype(np.int32).tobytes(), "zstd", asbytes=True)
        docs = list(zip(*self.docs, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[one(x, pa.int64()) for x in docs[:5]], one(docs[5], pa.string()), one(join(self.n_pairs), pa.int32()), pa.array([held], pa.binary()), one(pairs, pa.int64()), one(n_docs, pa.int64())],
            [x.split()[0] for x in CHUNK.split(", ")],
        )


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, how many) of texts that are handled together."""
    ends, i = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while i < len(ends):
        most = np.searchsorted(ends, (ends[i - 1] if i else 0) + BYTES_AT_ONCE, "right")
        n = min(AT_ONCE, max(1, int(most) - i))
        yield i, n
        i += n


def chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Aligned documents in chunks, each with its different pairs and how many of its documents have them."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, chunk = known_units(a_path, b_path), TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            for i, n in portions(batch.column("text")):
                some = batch.slice(i, n)
                chunk.add(some.column("doc_id").to_pylist(), known.numbers(some.column("text").to_pylist()), known)
                if chunk.full():
                    yield chunk.batch(number)
                    number, chunk = number + 1, _Chunk()
        if chunk.docs:
            yield chunk.batch(number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, CHUNK)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold an id pair linked, and whether no pair of its A id has more."""
    one = aligned.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.n_docs").alias("n"))
    counted = one.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", B_BITS))
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document.

    n_best counts the links whose pair is its A id's most frequent, ties included;
    count_sum adds the links' counts.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    aligned = written(chunks(docs, a_path, b_path), f"{folder}/aligned")
    counts = written(pair_counts(aligned), f"{folder}/counts")
    wanted = aligned.select("chunk", F.posexplode("pairs").alias("pos", "pair")).join(counts, "pair")
    # a chunk's pairs come back in one array, of as many numbers as the chunk has pairs
    back = wanted.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "count", "best"))).alias("back"))
    back = back.select("chunk", F.col("back.count").alias("count"), F.col("back.best").alias("best"))
    rows = aligned.drop("pairs", "n_docs").join(back, "chunk", "left")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_units()
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c).slice(i, 1).flatten() for c in (*kept, "n_pairs", "count", "best")}
                n_pairs = one["n_pairs"].to_numpy().astype(np.int64)
                size, some = int(n_pairs.sum()), np.flatnonzero(n_pairs)
                steps = np.frombuffer(pa.decompress(batch.column("held")[i].as_buffer(), 8 * size, "zstd"), np.int32).astype(np.int64)
                at, times, first = np.cumsum(steps[:size]), steps[size:], (np.cumsum(n_pairs) - n_pairs)[some]
                totals = []
                for per_pair in (one["best"].to_numpy(zero_copy_only=False).astype(np.int64), one["count"].to_numpy(zero_copy_only=False)):
                    x = np.zeros(len(n_pairs), np.int64)
                    if size:
                        x[some] = np.add.reduceat(per_pair[at] * times, first)
                    totals.append(pa.array(x))
                yield pa.RecordBatch.from_arrays([*[one[c] for c in kept], *totals], [*kept, "n_best", "count_sum"])

    out = rows.mapInArrow(summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
