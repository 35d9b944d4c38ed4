"""The published catalogue as files: nested rows of a bounded size, by name, with a manifest.

A maker's children are ranked over the cluster and cut into pieces of ``piece`` of a
section, so a row never holds more, whatever a maker has.  Pieces are placed by name: their
sizes, one small row a piece, are summed up in the order of names, and a file ends when it
has ``file_rows`` children or pieces.  Only then are the pieces gathered, each in its file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import Sort, down, ranked, running, up, up_nulls_last
from .store import scratch, written

SECTIONS = ("name_history", "instruments", "relations", "logos")


def _logo_order() -> list[Sort]:
    review = F.when(F.col("review_status") == "approved", 0).when(F.col("review_status") == "outdated", 2).otherwise(1)
    return [up(review), up(F.col("end_year").isNotNull()), down("start_year"), down("id")]


def _sections(makers: DataFrame, names: DataFrame, products: DataFrame, relations: DataFrame, logos: DataFrame) -> dict[str, tuple[DataFrame, Sequence[str], Sequence[Sort]]]:
    """section -> (rows, columns published, order)."""
    related = relations.join(makers.select(F.col("id").alias("related_id"), F.col("canonical_name").alias("related_name")), "related_id", "left")
    return {
        "name_history": (names, ("name", "start_year", "end_year"), [up_nulls_last("start_year"), up("name"), up("end_year")]),
        "instruments": (products, ("id", "name", "year", "category"), [up_nulls_last("year"), up("name"), up("id")]),
        "relations": (related, ("related_id", "related_name", "relation_type", "year"), [up_nulls_last("year"), up("related_name"), up("relation_type"), up("related_id")]),
        "logos": (logos, ("id", "start_year", "end_year", "review_status"), _logo_order()),
    }


def publish_files(path: str, makers: DataFrame, names: DataFrame, products: DataFrame, relations: DataFrame, logos: DataFrame, piece: int = 1000, file_rows: int = 100_000) -> None:
    """Write the catalogue of ``makers`` below ``path``: ``files`` and ``manifest``, both JSON.

    A row of ``files`` is a maker's header (all columns of ``makers``), its piece from 0 on,
    how many pieces it has, and the piece of each section as an ordered array (null: none).
    Children without a maker, or whose maker isn't there, are left out.  ``manifest`` has a
    row a file: its number, rows, children, first and last name; it is written last, so a
    catalogue without one isn't whole.
    """
    spark = makers.sparkSession
    cut = []
    for section, (rows, columns, order) in _sections(makers, names, products, relations, logos).items():
        item = F.struct(*[F.col(c) for c in columns])
        rows = ranked(rows.filter("maker_id is not null"), "maker_id", order, "_place").withColumn("_piece", F.floor((F.col("_place") - 1) / piece).cast("int"))
        rows = rows.groupBy("maker_id", "_piece").agg(F.sort_array(F.collect_list(F.struct("_place", item.alias("item")))).alias("items"))
        cut.append(rows.select("maker_id", "_piece", F.col("items.item").alias(section)))
    pieces = makers.select(F.col("id").alias("maker_id"), F.lit(0).alias("_piece"))
    for part in cut:
        pieces = pieces.join(part, ["maker_id", "_piece"], "full_outer")
    pieces = written(pieces, scratch(spark, "pieces"))
    weight = F.lit(1).cast("long")
    for section in SECTIONS:
        weight = weight + F.coalesce(F.size(section), F.lit(0))
    headers = makers.withColumnRenamed("id", "maker_id")
    slim = pieces.select("maker_id", "_piece", weight.alias("_weight")).join(headers.select("maker_id", F.lower("canonical_name").alias("_name")), "maker_id")
    placed = running(slim, [up("_name"), up("maker_id"), up("_piece")], "_weight", "_upto")
    placed = placed.select("maker_id", "_piece", "_upto", F.floor(F.col("_upto") / file_rows).cast("int").alias("file"))
    placed = written(placed, scratch(spark, "placed"))
    counts = placed.groupBy("maker_id").agg(F.count("*").cast("int").alias("pieces"))
    rows = pieces.join(placed, ["maker_id", "_piece"]).join(counts, "maker_id").join(headers, "maker_id").withColumnRenamed("_piece", "piece")
    rows = rows.repartition("file").sortWithinPartitions("file", "_upto").drop("_upto")
    rows.write.partitionBy("file").json(f"{path}/files")
    back = spark.read.schema(rows.schema).json(f"{path}/files")
    n_children: Column = F.lit(0).cast("long")
    for section in SECTIONS:
        n_children = n_children + F.coalesce(F.size(section), F.lit(0))
    manifest = back.groupBy("file").agg(
        F.count("*").alias("rows"), F.sum(n_children).alias("children"),
        F.min(F.struct(F.lower("canonical_name").alias("k"), "canonical_name")).alias("a"), F.max(F.struct(F.lower("canonical_name").alias("k"), "canonical_name")).alias("z"),
    )
    manifest.select("file", "rows", "children", F.col("a.canonical_name").alias("first"), F.col("z.canonical_name").alias("last")).coalesce(1).write.json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file int, rows long, children long, first string, last string").json(f"{path}/manifest")


def read_catalogue(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a published catalogue; ``schema`` is that of its rows, file and piece among them."""
    return spark.read.schema(schema).json(f"{path}/files")
