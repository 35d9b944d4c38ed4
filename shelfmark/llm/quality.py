"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words, hashed into WORDS buckets (logarithm of the count, scaled
to length 1 over the text), one bin of each structure statistic (shares of kinds of bytes,
of distinct words, of words that end in a sign; lengths) and one bin of each metadata
column, here ``n_chars``.  The score is the logistic of

    bias + sum of w[i] x[i] + sum over pairs of <v[i], v[j]> x[i] x[j]

whose pairs cost no more than the features, as they are half of the square of the sum less
the sum of the squares, for each of RANK dimensions.

It is learned from labelled rows with crc32(doc_id as text) mod 4 <> 2, at most about
MAX_LABELS of them, chosen by a hash of the id.  Their features are written once; in each
of ROUNDS rounds or more every shard takes its rows in steps from the same weights, and the
weights that come out are averaged by rows.  So the driver holds a few copies of the
weights, whose size is fixed, and no rows.  Labels, language, source and id are never
inputs of a score.

Defined results: null and empty texts are scored by their (empty) statistics; metadata that
is absent, null, no number or below 0 has a bin of its own; labels other than 0 and 1 and
null ids are not learned from, and an id labelled twice counts as 0 if either label says so;
without labels of both kinds every text scores the share of label 1 (1 half without any);
rows that repeat are scored alike; further columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK, _word_hashes, drop, shared_dir, written
from .toxicity import held_out

#: Labelled rows that are learned from, about; with more, a share of them by hash.
MAX_LABELS = 100_000
WORD_BITS = 15
WORDS = 1 << WORD_BITS
RANK, STEP_ROWS = 8, 64
#: Shards of the labelled rows, one for each thousand, and rounds over them: more over few rows.
SHARDS, ROUNDS, MOST_ROUNDS, VISITS = 8, 6, 20, 20_000
RATE, DECAY, START = 0.1, 1e-5, 0.01
THRESHOLD = 0.7
#: Weight of a bin beside the words, which together have length 1.
BIN_VALUE = 0.5
AT_ONCE = 256

#: Upper bounds of the bins of shares; sizes are binned by their logarithm.
EDGES = np.array([1e-9, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 0.95])
BINS = len(EDGES) + 1
SHARE_STATS = ("upper", "digit", "blank", "line feed", "sign", "beyond ASCII", "distinct words", "most frequent word", "words that end in a sign", "words of signs")
SIZE_STATS = ("bytes", "words", "lines", "bytes a word", "bytes a line")
N_STATS = len(SHARE_STATS) + len(SIZE_STATS)

_UPPER, _LOWER, _DIGIT, _BLANK, _FEED, _SIGN, _WIDE = range(7)
KIND = np.full(256, _SIGN, np.uint8)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
KIND[BLANK] = _BLANK
KIND[10] = _FEED


@dataclass
class Rows:
    """Sparse features: those of row i are ``index[at[i]:at[i + 1]]`` with ``value`` beside; no row is without any."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def sums(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.at[:-1], axis=0)


@dataclass
class Model:
    """weights: a row for each feature, its linear weight and then its RANK factors."""

    metadata: tuple[str, ...] = ()
    bias: float = 0.0
    weights: np.ndarray | None = field(default=None, repr=False)


def size(metadata: Sequence[str]) -> int:
    """Number of features."""
    return WORDS + (N_STATS + len(metadata)) * BINS


def _size_bin(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(x + 1.0), BINS - 1).astype(np.int64)


def _metadata_bins(column: pa.Array) -> np.ndarray:
    """0: none; else by the logarithm."""
    x = column.cast(pa.float64(), safe=False).fill_null(-1).to_numpy(zero_copy_only=False)
    known = x >= 0
    return np.where(known, np.minimum(1 + _size_bin(np.where(known, x, 0)), BINS - 1), 0)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words, none over the end of a text."""
    full = ~BLANK[data]
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1]
    last[:-1] &= ~full[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] |= full[inner]
    last[inner - 1] |= full[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def features(texts: pa.Array, metadata: Sequence[pa.Array] = ()) -> Rows:
    """The features of some texts; whole texts are read, in memory of a few times their size."""
    data, offsets = _bytes_of(texts)
    n, size_of = len(texts), np.diff(offsets)
    kinds = np.zeros((n, 7), np.int64)
    for a in range(0, n, 16):  # a number for each byte, so not for too many at once
        z = min(n, a + 16)
        doc = np.repeat(np.arange(z - a, dtype=np.int32) * 7, size_of[a:z])
        kinds[a:z] = np.bincount(doc + KIND[data[offsets[a] : offsets[z]]], minlength=7 * (z - a)).reshape(-1, 7)
    starts, ends = _words(data, offsets)
    cuts = np.searchsorted(starts, offsets)
    of, n_words = np.repeat(np.arange(n), np.diff(cuts)), np.diff(cuts)
    bucket = (_word_hashes(data, starts, ends) >> np.uint64(64 - WORD_BITS)).astype(np.int64) if len(starts) else np.empty(0, np.int64)
    key, count = np.unique(of << WORD_BITS | bucket, return_counts=True)
    doc, bucket = key >> WORD_BITS, key & WORDS - 1
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc, count)
    signs = KIND[data[ends - 1]] == _SIGN if len(ends) else np.empty(0, bool)
    ended = np.bincount(of[signs], minlength=n)
    bare = np.bincount(of[signs & (KIND[data[starts]] == _SIGN)] if len(starts) else of, minlength=n)

    letters = kinds[:, _UPPER] + kinds[:, _LOWER]
    share = lambda part, whole: part / np.maximum(whole, 1)
    shares = [
        share(kinds[:, _UPPER], letters), *[share(kinds[:, k], size_of) for k in (_DIGIT, _BLANK, _FEED, _SIGN, _WIDE)],
        share(np.bincount(doc, minlength=n), n_words), share(most, n_words), share(ended, n_words), share(bare, n_words),
    ]
    lines = kinds[:, _FEED] + 1
    sizes = [size_of, n_words, lines, share(size_of, n_words), share(size_of, lines)]
    bins = [np.digitize(x, EDGES) for x in shares] + [_size_bin(x) for x in sizes] + [_metadata_bins(m) for m in metadata]
    bins = np.stack(bins, 1) + WORDS + BINS * np.arange(len(bins))

    value = np.log1p(count)
    length = np.sqrt(np.bincount(doc, value * value, minlength=n))
    per_row = np.bincount(doc, minlength=n) + bins.shape[1]
    at = np.append(0, np.cumsum(per_row))
    index, values = np.empty(at[-1], np.int64), np.full(at[-1], BIN_VALUE, np.float32)
    behind = at[:-1, None] + np.arange(bins.shape[1])
    is_bin = np.zeros(at[-1], bool)
    is_bin[behind] = True
    index[behind] = bins
    index[~is_bin], values[~is_bin] = bucket, value / length[doc]
    return Rows(at, index, values)


def margins(rows: Rows, bias: float, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of the machine for each row, weighted features, sums of them for each row)."""
    scaled = weights[rows.index] * rows.value[:, None]
    sums = rows.sums(scaled)
    pairs = 0.5 * (sums[:, 1:] ** 2 - rows.sums(scaled[:, 1:] ** 2)).sum(1)
    return bias + sums[:, 0] + pairs, scaled, sums


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def step(rows: Rows, y: np.ndarray, state: np.ndarray) -> None:
    """One step on some rows.  ``state``: weights and their summed squared gradients; the bias is its last row."""
    weights, seen = state
    z, scaled, sums = margins(rows, weights[-1, 0], weights[:-1])
    error = ((_logistic(z) - y) / len(y)).astype(np.float32)
    each = np.repeat(np.arange(len(y)), np.diff(rows.at))
    slope = np.empty_like(scaled)
    slope[:, 0] = 1
    slope[:, 1:] = sums[each, 1:] - scaled[:, 1:]
    slope *= (error[each] * rows.value)[:, None]
    order = np.argsort(rows.index, kind="stable")
    index = rows.index[order]
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    index = index[first]
    slope = np.add.reduceat(slope[order], first, axis=0) + DECAY * weights[index]
    seen[index] += slope**2
    weights[index] -= RATE * slope / np.sqrt(seen[index] + 1e-8)
    seen[-1, 0] += (g := error.sum()) ** 2
    weights[-1, 0] -= RATE * g / math.sqrt(seen[-1, 0] + 1e-8)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, metadata, y): labelled rows to learn from; the ids are broadcast, MAX_LABELS at most, about."""
    known = labels.filter("quality in (0, 1)").filter(F.col("doc_id").isNotNull()).filter(~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label of it"))
    n = known.count()
    if n > MAX_LABELS:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * MAX_LABELS / n))
    return docs.join(F.broadcast(known), "doc_id")


def _sparse(rows: DataFrame, metadata: Sequence[str]) -> DataFrame:
    def of(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(i, AT_ONCE)
                f = features(some.column(0), [some.column(1 + k) for k in range(len(metadata))])
                at = pa.array(f.at, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, pa.array(f.index, pa.int32())), pa.ListArray.from_arrays(at, pa.array(f.value, pa.float32())), some.column(some.num_columns - 2), some.column(some.num_columns - 1)], ["index", "value", "at", "y"])

    rows = rows.select("text", *[F.col(m).cast("double") for m in metadata], F.xxhash64("doc_id").alias("at"), F.col("label of it").alias("y"))
    return rows.mapInArrow(of, "index array<int>, value array<float>, at long, y int")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Rows, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, STEP_ROWS):
            some = batch.slice(i, STEP_ROWS)
            lists, values = some.column("index"), some.column("value").flatten().to_numpy()
            at = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            yield Rows(at, lists.flatten().to_numpy().astype(np.int64), values), some.column("y").to_numpy()


def learn(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = ("n_chars",)) -> Model:
    """Fit a model to the labelled rows of ``docs``; numeric ``metadata`` columns it lacks are left out."""
    spark = docs.sparkSession
    metadata = tuple(m for m in metadata if m in docs.columns)
    folder = shared_dir(spark)
    # a row goes to the shard of its id's hash and in its order there, whatever the files' order is; copies of a text are spread
    rows = _sparse(labelled(docs, labels), metadata).repartition(SHARDS, "at").sortWithinPartitions("at", F.xxhash64("index"), "y")
    rows = written(rows, f"{folder}/features")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < ones < n:
        drop(spark, folder)
        return Model(metadata, 0.0 if not n else 500.0 if ones else -500.0)
    shape = (2, size(metadata) + 1, 1 + RANK)
    state = np.zeros(shape, np.float32)
    state[0, :-1, 1:] = np.random.default_rng(7).normal(0, START, (shape[1] - 1, RANK))
    state[0, -1, 0] = math.log(ones / (n - ones))
    rows = rows.coalesce(min(SHARDS, 1 + n // 1000))
    for _ in range(max(ROUNDS, min(MOST_ROUNDS, VISITS // n))):
        shared = spark.sparkContext.broadcast(state)

        def epoch(batches, shared=shared):
            own, n = shared.value.copy(), 0
            for some, y in _chunks(batches):
                step(some, y, own)
                n += len(y)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([own.tobytes()], pa.binary())], ["n", "state"])

        total = np.zeros(shape)
        for r in rows.mapInArrow(epoch, "n long, state binary").collect():
            total += np.frombuffer(r.state, np.float32).reshape(shape) * (r.n / n)
        state = total.astype(np.float32)
        shared.destroy()
    drop(spark, folder)
    weights = np.where(state[1, :-1].any(1)[:, None], state[0, :-1], 0)  # features that no row has say nothing
    return Model(metadata, float(state[0, -1, 0]), weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted (score >= THRESHOLD) added."""
    names = docs.columns
    weights = None if model.weights is None else docs.sparkSession.sparkContext.broadcast(model.weights)
    metadata = [F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(model.metadata)]
    row = docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row"), "text", *metadata)
    bias, n_meta = model.bias, len(metadata)

    def scored(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(i, AT_ONCE)
                if weights is None:
                    z = np.full(some.num_rows, bias)
                else:
                    z = margins(features(some.column(1), [some.column(2 + k) for k in range(n_meta)]), bias, weights.value)[0]
                p = _logistic(z.astype(float))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())], ["row", "score", "predicted"])

    out = row.mapInArrow(scored, f"row {row.schema['row'].dataType.simpleString()}, score double, predicted int")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], "score", "predicted")
