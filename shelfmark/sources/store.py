"""Tables that jobs keep: bucketed versions for joins without a shuffle, and tables that a
batch updates by rewriting only the partitions it touches.

Both are plain Parquet folders in shared storage.  One job at a time may write a table.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def scratch(spark: SparkSession, kind: str = "files") -> str:
    """A new folder name in the shared folder of the cluster; a temporary one where a single machine names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-files-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: later plans start from the files, whatever executor is lost."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of what a folder holds, by name; a file is its own only child."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(where))


# Bucketed versions


@dataclass(frozen=True)
class Versions:
    """Versions of a table below ``path``, each bucketed and sorted by the column ``by``.

    A join or a grouping by that column needs no exchange on this table's side.  A version
    counts once it is written whole, so a killed writer leaves the one before in force.
    """

    path: str
    by: str
    buckets: int = 8

    def _name(self, version: int) -> str:
        return f"versions_{hashlib.md5(self.path.encode()).hexdigest()}_{version}"

    def numbers(self, spark: SparkSession) -> list[int]:
        """The whole versions, oldest first."""
        found = [int(name[2:]) for name, _, _ in children(spark, self.path) if name.startswith("v=")]
        return sorted(v for v in found if exists(spark, f"{self.path}/v={v}/_SUCCESS"))

    def write(self, df: DataFrame) -> int:
        """Write another version of the table, one file a bucket; its number."""
        spark = df.sparkSession
        taken = [int(name[2:]) for name, _, _ in children(spark, self.path) if name.startswith("v=")]
        version = max(taken, default=0) + 1
        rows = df.repartition(self.buckets, self.by)
        rows.write.bucketBy(self.buckets, self.by).sortBy(self.by).option("path", f"{self.path}/v={version}").saveAsTable(self._name(version))
        return version

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """A version, the newest unless one is named; in any session, also one that didn't write it."""
        if version is None:
            numbers = self.numbers(spark)
            if not numbers:
                raise FileNotFoundError(f"no version of {self.path}")
            version = numbers[-1]
        name = self._name(version)
        if not spark.catalog.tableExists(name):
            at = f"{self.path}/v={version}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(at).schema)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.by}`) SORTED BY (`{self.by}`) INTO {self.buckets} BUCKETS LOCATION '{at}'")
        return spark.table(name)

    def drop_before(self, spark: SparkSession, version: int) -> None:
        """Delete versions older than one; readers of those must have ended."""
        for v in self.numbers(spark):
            if v < version:
                spark.sql(f"DROP TABLE IF EXISTS {self._name(v)}")
                remove(spark, f"{self.path}/v={v}")


# Tables that batches update


@dataclass(frozen=True)
class Kept:
    """A table below ``path``, in ``parts`` partitions by the hash of its ``keys``.

    A batch reads and rewrites the partitions of its own keys only.  Their new content is
    written whole to a pending folder before it replaces the old, partition by partition; a
    run that was killed in between is ended by the next one before it reads anything, and a
    run that was killed before has changed nothing.  A merge that is told the same batch
    twice must give the same rows; then a batch can be applied again at any time.
    """

    path: str
    keys: tuple[str, ...]
    parts: int = 64

    @property
    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    @property
    def pending(self) -> str:
        return f"{self.path}/_pending"

    def _put(self, df: DataFrame, path: str) -> None:
        """Write rows: in the table over the partitions that they are in, elsewhere as a whole, which leaves a mark."""
        mode = "dynamic" if path == self.path else "static"
        rows = df.withColumn("part", self.part).repartition(self.parts, "part")
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(path)

    def create(self, df: DataFrame) -> None:
        """Write the table's first rows; an existing table is an error."""
        if exists(df.sparkSession, self.path):
            raise FileExistsError(self.path)
        df.limit(0).coalesce(1).write.parquet(f"{self.path}/_schema")
        self._put(df, self.path)

    def recover(self, spark: SparkSession) -> None:
        """End the last batch of a killed run, if its new content was whole; else forget it."""
        if exists(spark, f"{self.pending}/_SUCCESS"):
            self._replace(spark)
        elif exists(spark, self.pending):
            remove(spark, self.pending)

    def _rows(self, spark: SparkSession, path: str) -> DataFrame:
        kind = spark.read.parquet(f"{self.path}/_schema").schema
        return spark.read.schema(kind.add("part", "integer")).parquet(path)

    def _replace(self, spark: SparkSession) -> None:
        self._put(self._rows(spark, self.pending).drop("part"), self.path)
        remove(spark, self.pending)

    def read(self, spark: SparkSession, of: DataFrame | None = None) -> DataFrame:
        """The table; with ``of``, only the partitions of the keys of those rows, which are pruned."""
        self.recover(spark)
        rows = self._rows(spark, self.path)
        if of is not None:
            touched = [r.part for r in of.select(self.part.alias("part")).distinct().collect()]  # as many as there are parts, at most
            rows = rows.filter(F.col("part").isin(touched))
        return rows.drop("part")

    def apply(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Replace the partitions of ``batch``'s keys by ``merge(their rows, batch)``.

        What ``merge`` gives must have the table's columns, and no key of another partition.
        """
        spark = batch.sparkSession
        held = self.read(spark, batch)
        self._put(merge(held, batch).select(*held.columns), self.pending)
        self._replace(spark)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Names, sizes and times of the files of some inputs: the same as long as nobody rewrites them."""
    return hashlib.md5(repr([(p, children(spark, p)) for p in paths]).encode()).hexdigest()
