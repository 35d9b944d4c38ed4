"""What the training-data operators share: scratch tables in the cluster's shared folder,
connected components, word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent on a single machine it is below a temporary folder; a
    cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-llm-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` and read it back: cuts lineage, and survives lost executors."""
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, path: str) -> DataFrame:
    """As ``written``; the shuffle files of the write are deleted with it, not when the driver next collects garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return written(df, path)
    finally:
        conf.set(name, before)


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def filesystem(path: str):
    """(pyarrow file system, path in it) for a folder given as a URI or a plain path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def put_file(path: str, data: bytes) -> None:
    """Write a whole file under a temporary name, then move it into place.

    A task that is run twice writes the same bytes twice, so either copy may win.
    """
    system, name = filesystem(path)
    part = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part, compression=None) as out:
        out.write(data)
    system.move(part, name)


def make_dir(path: str) -> str:
    system, name = filesystem(path)
    system.create_dir(name, recursive=True)
    return path


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One odd multiplier for each place in a shingle, with no small relations between them.
PLACES = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_RNG = np.random.default_rng(20240229)
#: A random number for each byte, that of a-z for A-Z also; an odd multiplier and its inverse.
BYTES = _RNG.integers(1, 2**64, 256, np.uint64)
BYTES[65:91] = BYTES[97:123]
POWER = int(_RNG.integers(1, 2**63)) * 2 + 1
INVERSE = pow(POWER, -1, 2**64)
BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
#: Bytes whose words are hashed together.
CHUNK = 1 << 20
_POWERS: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of POWER and of INVERSE, at least."""
    if len(_POWERS[0]) < n:
        for i, x in enumerate((POWER, INVERSE)):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, without regard to the case of A-Z: a polynomial in its bytes' numbers, mixed."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        at, size = int(starts[i]), int(ends[j - 1] - starts[i])
        power, inverse = _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(BYTES[data[at : at + size]] * power[:size], out=sums[1:])
        first, last = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix64((sums[last] - sums[first]) * inverse[first])
        i = j
    return out


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``size``-word shingles.

    Words are split at ASCII white space (space, tab to carriage return), A-Z taken as
    a-z.  A text with fewer words has one shingle, its whole word sequence; a text
    without words, or a null text, has none.
    """
    texts = texts.fill_null("")
    for i in range(0, len(texts), 256):
        some = texts.slice(i, 256)
        kind = np.int64 if pa.types.is_large_string(some.type) else np.int32
        offsets = np.frombuffer(some.buffers()[1], kind)[some.offset : some.offset + len(some) + 1].astype(np.int64)
        raw = some.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        offsets -= offsets[0]
        full = ~BLANK[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = ~full[:-1], ~full[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]  # where texts meet
        before[inner] = after[inner - 1] = True
        starts = np.flatnonzero(full & before)
        words = _word_hashes(data, starts, np.flatnonzero(full & after) + 1)
        n = len(words)
        rolled = np.full(max(0, n - size + 1), np.uint64(size))
        for j in range(size if len(rolled) else 0):  # word hashes are uniform, so their weighted sum is too
            rolled += words[j : n - size + 1 + j] * PLACES[j]
        rolled = mix64(rolled)
        cuts = np.searchsorted(starts, offsets).tolist()
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z - a >= size:
                s = np.sort(rolled[a : z - size + 1])
                yield s[np.append(True, s[1:] != s[:-1])]
            elif z > a:
                width = z - a
                yield mix64(np.array([(words[a:z] * PLACES[:width]).sum(dtype=np.uint64)], np.uint64) + np.uint64(width))
            else:
                yield np.empty(0, np.uint64)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """``shingle_sets`` of one text."""
    return next(shingle_sets(pa.array([text], pa.string()), size))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) of every node in ``edges(a, b)``: the smallest node reachable.

    Alternating large-star and small-star steps; each round is written out.  No
    neighbour list is ever gathered, so a hub costs its links only.  It ends when a round
    changes nothing, after a number of rounds that grows with the logarithm of the nodes;
    what a round leaves is counted and summed as it is written.
    """

    def put(e, step):
        seen = Observation()
        e = written(e.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hashes")), f"{folder}/cc{step}")
        return e, seen.get

    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    (e, state), step = put(e, 0), 0
    while True:
        step += 1
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v")  # one row a link at most
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", "m")).filter("u <> v").distinct()
        before = state
        e, state = put(small, step)
        if state == before:
            break
        drop(edges.sparkSession, f"{folder}/cc{step - 1}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
