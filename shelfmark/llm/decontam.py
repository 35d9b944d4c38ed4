"""Benchmark decontamination by latent semantic retrieval.

Texts become ids of the benchmark's words.  A randomised SVD of the TF-IDF matrix of
passages gives each word a vector of K latent, whitened dimensions; a passage's vector
is the weighted sum of its words'.  Every window of every document is compared with
every item of its size by cosine, and candidates are confirmed by the longest common
subsequence of words: most of the item's words in order, or, for paraphrases, fewer of
them with the item's answer (its last sentence) nearly whole.  An item of fewer than
MIN_WORDS words has too little for a vector; it is found where all its words stand one
after the other.

Document frequencies and the SVD take all passages of all documents: one pass counts how
often words meet in a passage, exactly, in tables of the vocabulary's size, and the SVD's
products are with these counts.  The benchmark is the query set: it is taken in blocks of
BLOCK_ITEMS items and MAX_VOCAB words at most (or one item), each a pass over the ids, so
its size is not bounded, while what a task holds is.

Defined results: items and documents without words match nothing; null ids are kept as
they are; repeated items and repeated documents are each reported; only doc_id, text
and item_id, text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, settled, shared_dir, written

K, EXTRA = 192, 32
PASSAGE = 64
#: Tasks that count words meeting, at least, and passages of one, about, so that few tables are summed.
FIT_PARTS, PART_PASSAGES = 12, 250_000
#: Passages whose pairs are made together; after how many a task sends its table, so that no cell overflows.
SLICE, FULL = 4096, 500_000
BLOCK_ITEMS, MAX_VOCAB = 512, 4095
#: Cells of a task's table of words that meet.
MAX_CELLS = (MAX_VOCAB + 1) ** 2
STEP = 16
MIN_WORDS = 8
COSINE = 0.42
#: Share of an item's words that must be there in order; less will do if the answer is there.
COVERED, PARAPHRASED, ANSWERED = 0.75, 0.6, 0.8
SEED = 20240101
_EDGE = b".,;:!?\"'()[]{}<>*#$%&|`~_-+=/\\"
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without outer punctuation, those without other characters left out."""
    return [w for x in (text or "").lower().encode("utf-8", "surrogatepass").split() if (w := x.strip(_EDGE))]


class _Ids(dict):
    """raw word -> id in the vocabulary, -1 if not in it, -2 if it is punctuation only."""

    def __init__(self, vocabulary: dict[bytes, int], limit: int = 300_000):
        super().__init__()
        self.vocabulary, self.limit = vocabulary, limit

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        w = raw.strip(_EDGE)
        i = self[raw] = self.vocabulary.get(w, -1) if w else -2
        return i


class Items:
    """A block of items: their ids, words as vocabulary ids, and the words of their answers."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        self.ids, self.words, self.answers, vocabulary = [], [], [], {}
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            sentences = [w for s in _SENTENCE.split(text.strip()) if (w := words_of(s))]
            self.ids.append(item_id)
            self.words.append([vocabulary.setdefault(w, len(vocabulary)) for w in words])
            self.answers.append([vocabulary[w] for w in sentences[-1]] if len(sentences) > 1 else [])
        self.vocabulary = vocabulary
        self.windows = [max(2 * STEP, 1 << (len(w) - 1).bit_length()) if len(w) >= MIN_WORDS else 0 for w in self.words]

    def short(self) -> dict[int, dict[tuple[int, ...], list[int]]]:
        """Length -> words -> the items that are just these, of those without a window."""
        out: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for i, w in enumerate(self.words):
            if not self.windows[i]:
                out.setdefault(len(w), {}).setdefault(tuple(w), []).append(i)
        return out


def item_blocks(benchmark: DataFrame):
    """Blocks of the benchmark in order of item_id, each small enough for a task."""
    rows, n = [], BLOCK_ITEMS
    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        rows.append((r.item_id, r.text))
        if len(rows) >= n:
            yield from _fitting(rows)
            rows = []
    if rows:
        yield from _fitting(rows)


def _fitting(rows):
    items = Items(rows)
    if len(items.vocabulary) <= MAX_VOCAB or len(rows) == 1:
        yield items
    else:
        yield from _fitting(rows[: len(rows) // 2])
        yield from _fitting(rows[len(rows) // 2 :])


def word_ids(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, th, n, ids): each text's hash, count of words, and words as little-endian int32."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def number(batches):
        ids = _Ids(shared.value)
        for batch in batches:
            out, n = [], []
            for text in batch.column("text"):
                raw = (text.as_py() or "").lower().encode("utf-8", "surrogatepass").split()
                a = np.fromiter(map(ids.__getitem__, raw), np.int32, len(raw))
                if len(a) and a.min() == -2:
                    a = a[a > -2]
                out.append(a.tobytes())
                n.append(len(a))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "th", "n", "ids"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(number, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, th long, n long, ids binary")


def inverse_frequencies(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """log((1 + documents) / (1 + documents with the word)), over all documents."""

    def count(batches):
        df, n, here = np.zeros(vocabulary + 1, np.int64), 0, np.zeros(vocabulary + 1, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                a = np.frombuffer(x.as_py(), np.int32)  # -1, other words, is the last place
                here[a] = 1
                df += here
                here[a] = 0
                n += 1
        df = df[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(vocabulary), -1), pa.int64()), pa.array(np.append(df, n), pa.int64())], ["word", "n"])

    rows = ids.select("ids").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    n = dict(zip(rows["word"], rows["n"], strict=True))
    return np.log((1 + n.get(-1, 0)) / (1 + np.array([n.get(i, 0) for i in range(vocabulary)], float)))


def cooccurrences(ids: DataFrame, vocabulary: int, passages: int, folder: str) -> DataFrame:
    """(row, cells, counts): C'C of the word counts C of all passages, by blocks of rows, exact.

    Its upper triangle, what is off the diagonal twice; a cell is its place in its block.
    A task sorts the words of each passage and counts pairs of places, in one table of
    MAX_CELLS cells at most; for more words it sends what a slice of passages has.
    """
    wide = vocabulary + 1  # the last place: other words, and what fills a passage up
    rows_each = _rows_each(vocabulary)

    def sent(cells, counts):
        keep = (cells % wide < vocabulary) & (cells < vocabulary * wide)
        cells, counts = cells[keep], counts[keep]
        block = cells // (rows_each * wide)
        for at in np.split(np.arange(len(cells)), np.flatnonzero(np.diff(block)) + 1) if len(cells) else ():
            first = int(block[at[0]])
            own = (cells[at] - first * rows_each * wide).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([first * rows_each], pa.int64()), pa.array([own.tobytes()], pa.binary()), pa.array([counts[at].astype(np.int64).tobytes()], pa.binary())], ["row", "cells", "counts"])

    def pairs(passages):
        """Cells of the pairs of places in ``passages``, and how often each counts."""
        passages = np.sort(passages, axis=1)
        used = (passages < vocabulary).sum(axis=1)
        by = np.argsort(used, kind="stable")
        passages, used = passages[by].astype(np.int64), used[by]
        for width in range(4, PASSAGE + 1, 4):  # passages with about as many words together
            lo, hi = np.searchsorted(used, [width - 4, width], "right")
            some = passages[lo:hi, :width]
            for d in range(width if hi > lo else 0):
                yield (some[:, : width - d] * wide + some[:, d:]).ravel(), 2 if d else 1

    def slices(batches):
        held, n = [], 0
        for batch in batches:
            for x in batch.column("ids"):
                a = np.frombuffer(x.as_py(), np.int32)
                for i in range(0, len(a), SLICE * PASSAGE):
                    own = a[i : i + SLICE * PASSAGE]
                    filled = np.full(-(-len(own) // PASSAGE) * PASSAGE, vocabulary, np.int32)
                    filled[: len(own)] = np.where(own < 0, vocabulary, own)
                    held.append(filled)
                    n += len(filled)
                    if n >= SLICE * PASSAGE:
                        yield np.concatenate(held).reshape(-1, PASSAGE)
                        held, n = [], 0
        if held:
            yield np.concatenate(held).reshape(-1, PASSAGE)

    def tally(batches):
        table, n = np.zeros(wide * wide if wide * wide <= MAX_CELLS else 0, np.int32), 0
        for some in slices(batches):
            if not len(table):
                for cells, each in pairs(some):
                    cells, counts = np.unique(cells, return_counts=True)
                    yield from sent(cells, counts * each)
                continue
            for cells, each in pairs(some):
                np.add.at(table, cells, np.int32(each))
            n += len(some)
            if n >= FULL:  # a passage adds less than 2 ** 12 to a cell
                cells = np.flatnonzero(table)
                yield from sent(cells, table[cells])
                table[:], n = 0, 0
        cells = np.flatnonzero(table)
        yield from sent(cells, table[cells])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rows_each * wide, np.int64)
        for batch in batches:
            for cells, counts in zip(batch.column("cells"), batch.column("counts"), strict=True):
                total[np.frombuffer(cells.as_py(), np.int32)] += np.frombuffer(counts.as_py(), np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([cells.astype(np.int32).tobytes()], pa.binary()), pa.array([total[cells].tobytes()], pa.binary())], ["row", "cells", "counts"])

    kind = "row long, cells binary, counts binary"
    parts = ids.select("ids").coalesce(max(FIT_PARTS, -(-passages // PART_PASSAGES))).mapInArrow(tally, kind)
    return settled(parts.groupBy("row").applyInArrow(add, kind), folder)


def _rows_each(vocabulary: int) -> int:
    """Rows of a block of ``cooccurrences``."""
    return max(1, min(64, (1 << 21) // (vocabulary + 1)))


def _gram_times(counts: DataFrame, weights: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'A right for the TF-IDF matrix A of which ``counts`` is ``cooccurrences``; partial sums meet by rows of terms."""
    shared = counts.sparkSession.sparkContext.broadcast((weights, right * weights[:, None]))
    rows_each, block, wide = 512, _rows_each(len(weights)), len(weights) + 1

    def multiply(batches):
        w, r = shared.value
        total, any_rows = np.zeros_like(r), False
        for batch in batches:
            for row, cells, n in zip(*(batch.column(c) for c in ("row", "cells", "counts")), strict=True):
                any_rows, row = True, row.as_py()
                upper = np.zeros(block * wide)
                upper[np.frombuffer(cells.as_py(), np.int32)] = np.frombuffer(n.as_py(), np.int64) / 2
                upper = upper.reshape(block, wide)[: len(r) - row, :-1]
                total[row : row + len(upper)] += upper @ r
                total += upper.T @ r[row : row + len(upper)]
        if any_rows:
            total *= w[:, None]
            starts = range(0, len(total), rows_each)
            yield pa.RecordBatch.from_arrays([pa.array(list(starts), pa.int64()), pa.array([total[s : s + rows_each].tobytes() for s in starts], pa.binary())], ["row", "part"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("part"):
                a = np.frombuffer(x.as_py(), float)
                total = a.copy() if total is None else total + a
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["row", "part"])

    parts = counts.coalesce(FIT_PARTS).mapInArrow(multiply, "row long, part binary").groupBy("row").applyInArrow(add, "row long, part binary")
    total = np.zeros_like(right)
    for r in parts.collect():  # as many numbers as ``right`` has
        a = np.frombuffer(r.part, float).reshape(-1, right.shape[1])
        total[r.row : r.row + len(a)] = a
    return total


def latent_space(ids: DataFrame, vocabulary: int, folder: str) -> np.ndarray:
    """A row for each word: its weighted, whitened vector in the latent space of all passages."""
    passages = ids.agg(F.sum(F.ceil(F.col("n") / PASSAGE))).first()[0] or 0
    weights = inverse_frequencies(ids, vocabulary)
    width = min(K + EXTRA, vocabulary)
    counts = cooccurrences(ids, vocabulary, passages, folder)
    start = np.random.default_rng(SEED).standard_normal((vocabulary, width))
    basis, _ = np.linalg.qr(_gram_times(counts, weights, start))
    squares, turn = np.linalg.eigh(basis.T @ _gram_times(counts, weights, basis))
    order = np.argsort(squares)[::-1][:K]
    order = order[squares[order] > 1e-9 * max(float(squares.max(initial=0)), 1e-300)]
    vectors = (basis @ turn[:, order]) / np.sqrt(squares[order]) if len(order) else np.zeros((vocabulary, 1))
    drop(ids.sparkSession, folder)
    return (vectors * weights[:, None] * np.sqrt(max(passages, 1))).astype(np.float32)


def common_words(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel steps over the text."""
    at: dict[int, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in text:
        if m := at.get(w):
            u = row & m
            row = (row + u | row - u) & full
    return len(item) - row.bit_count()


def confirmed(item: list[int], answer: list[int], text: list[int]) -> tuple[float, float] | None:
    """(share of the item's words there in order, of the answer's), if that is a leak."""
    covered = common_words(item, text) / len(item)
    if covered < PARAPHRASED:
        return None
    answered = common_words(answer, text) / len(answer) if answer else 0.0
    return (covered, answered) if covered >= COVERED or answered >= ANSWERED else None


def search(ids: DataFrame, items: Items, space: np.ndarray) -> DataFrame:
    """(doc_id, th, item_id, cosine, covered, answered): confirmed leaks of a block of items."""
    spark = ids.sparkSession
    table = np.vstack([space, np.zeros((1, space.shape[1]), np.float32)])  # the last row: other words
    scales: dict[int, list[int]] = {}
    for i, w in enumerate(items.windows):
        if w:
            scales.setdefault(w, []).append(i)

    def unit(a):
        return a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)

    queries = {w: (own, unit(np.array([space[items.words[i]].sum(axis=0) for i in own], np.float32))) for w, own in scales.items()}
    has = np.zeros((len(items.words), len(table)), bool)  # which words an item has
    for i, words in enumerate(items.words):
        has[i, words] = True
    shared = spark.sparkContext.broadcast((table, queries, items.words, items.answers, has))
    short = items.short()
    widest = max(scales, default=2 * STEP) // STEP

    def flush(docs, table, queries, words, answers, has):
        """docs: (index, ids); yields (index, item, cosine, covered, answered)."""
        sizes = np.array([len(a) for _, a in docs])
        starts = np.zeros(len(docs) + 1, np.int64)
        np.cumsum(-(-sizes // STEP) + widest, out=starts[1:])  # empty blocks keep windows within a document
        blocks = int(starts[-1])
        flat = np.full(blocks * STEP, len(table) - 1, np.int32)
        for (_, a), s in zip(docs, starts.tolist(), strict=False):
            flat[s * STEP : s * STEP + len(a)] = a
        flat[flat < 0] = len(table) - 1
        sums = np.empty((blocks, table.shape[1]), np.float32)
        for i in range(0, blocks, 1024):
            sums[i : i + 1024] = table[flat[i * STEP : (i + 1024) * STEP]].reshape(-1, STEP, table.shape[1]).sum(axis=1)
        by_size, m = {1: sums}, 1
        while m < widest:  # windows of twice the size from pairs of windows
            by_size[2 * m] = by_size[m][:-m] + by_size[m][m:]
            m *= 2
        for w, (own, items_at) in queries.items():
            m = w // STEP
            window = by_size[m][:: m // 2]
            least = COSINE * np.sqrt(np.einsum("ij,ij->i", window, window))
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for i in range(0, len(window), 4096):
                dots = window[i : i + 4096] @ items_at.T
                low = least[i : i + 4096, None]
                at, which = np.nonzero((dots >= low) & (low > 0))
                block = (i + at) * (m // 2)
                in_doc = np.searchsorted(starts, block, "right") - 1
                begin = np.maximum(starts[in_doc] * STEP, block * STEP - w // 2)
                end = np.minimum(starts[in_doc] * STEP + sizes[in_doc], block * STEP + w + w // 2)
                cosines = dots[at, which] / low[at, 0] * COSINE
                for d, q, a, b, c in zip(in_doc.tolist(), which.tolist(), begin.tolist(), end.tolist(), cosines.tolist(), strict=True):
                    item = own[q]
                    near = flat[a:b]
                    if np.count_nonzero(has[item][near]) < PARAPHRASED * len(words[item]):
                        continue
                    if found := confirmed(words[item], answers[item], near.tolist()):
                        best[d, item] = max(best.get((d, item), (0.0, 0.0, 0.0)), (*found, c))
            for (d, item), (covered, answered, cosine) in best.items():
                yield docs[d][0], item, cosine, covered, answered

    def whole(a):
        """The short items whose words stand one after the other in a."""
        found = set()
        for n, by_words in short.items():
            firsts = np.array([w[0] for w in by_words], np.int32)
            for at in np.flatnonzero(np.isin(a[: max(0, len(a) - n + 1)], firsts)).tolist():
                found.update(by_words.get(tuple(a[at : at + n].tolist()), ()))
        return sorted(found)

    def scan(batches):
        own = shared.value
        for batch in batches:
            docs, size, out = [], 0, []
            for i, x in enumerate(batch.column("ids")):
                a = np.frombuffer(x.as_py(), np.int32)
                out += [(i, item, 1.0, 1.0, 1.0) for item in whole(a)]
                docs.append((i, a))
                size += len(a) + 64
                if size > 150_000:
                    out += flush(docs, *own)
                    docs, size = [], 0
            if docs:
                out += flush(docs, *own)
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), pa.array([o[1] for o in out], pa.int64()), *(pa.array([o[j] for o in out], pa.float64()) for j in (2, 3, 4))], ["doc_id", "th", "item", "cosine", "covered", "answered"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    found = ids.select("doc_id", "th", "ids").mapInArrow(scan, f"doc_id {kind}, th long, item long, cosine double, covered double, answered double")
    names = spark.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
    return found.join(F.broadcast(names), "item").select("doc_id", "th", "item_id", "cosine", "covered", "answered")


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``leaks`` with th, the hash of the document's text."""
    folder, out = shared_dir(docs.sparkSession), None
    for i, items in enumerate(item_blocks(benchmark)):
        if not items.ids:
            continue
        ids = written(word_ids(docs, items), f"{folder}/ids{i}")
        found = written(search(ids, items, latent_space(ids, len(items.vocabulary), f"{folder}/fit{i}")), f"{folder}/found{i}")
        out = found if out is None else out.union(found)
    if out is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        out = docs.sparkSession.createDataFrame([], f"doc_id {kind}, th long, item_id long, cosine double, covered double, answered double")
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, covered, answered) for each item found in a document."""
    return _leaks(docs, benchmark).drop("th")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, columns as given; rows are told apart by doc_id and text."""
    found = _leaks(docs, benchmark).select(F.col("doc_id").alias("_leaked"), F.col("th").alias("_th")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_leaked"]) & (F.xxhash64(docs["text"]) == found["_th"]), "left_anti")
