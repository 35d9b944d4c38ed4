"""Categories and families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import is_blank, split_axes


def build_categories(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(categories by name with axes, membership by name) from free text; membership is primary."""
    rows = products.filter(~is_blank("category")).select(F.col("id").alias("product_id"), F.trim("category").alias("name"))
    axes = split_axes("name")
    return rows.select("name").distinct().withColumns({"form": axes["form"], "function": axes["function"]}), rows.distinct().withColumn("is_primary", F.lit(1))


def category_counts(categories: DataFrame, membership: DataFrame) -> DataFrame:
    """(name, n), categories without products too."""
    counts = membership.groupBy("category_id").agg(F.count("*").alias("n"))
    rows = categories.join(counts, F.col("id") == F.col("category_id"), "left")
    return rows.select("name", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), "name")


def uncategorised(products: DataFrame, membership: DataFrame) -> DataFrame:
    """Products without a category."""
    return products.join(membership.select(F.col("product_id").alias("id")).distinct(), "id", "left_anti")


def by_function(products: DataFrame, makers: DataFrame, categories: DataFrame, membership: DataFrame, function: str) -> DataFrame:
    """T4: (maker, name, form) of products with a function, whatever their form."""
    own = categories.filter(F.lower("function") == function.lower()).select(F.col("id").alias("category_id"), "form")
    rows = membership.join(own, "category_id").join(products.select(F.col("id").alias("product_id"), "maker_id", "name"), "product_id")
    rows = rows.join(makers.select(F.col("id").alias("maker_id"), F.col("canonical_name").alias("maker")), "maker_id")
    return rows.select("maker", "name", "form").distinct().orderBy("maker", "name", "form")


def assign(membership: DataFrame, changes: DataFrame) -> DataFrame:
    """T5: membership after ``changes`` (product_id, category_id, action add|primary|remove); a new primary demotes others."""
    keys = ["product_id", "category_id"]
    act = changes.groupBy(*keys).agg(F.max(F.when(F.col("action") == "remove", 2).when(F.col("action") == "primary", 1).otherwise(0)).alias("_a"))
    first = act.filter("_a = 1").groupBy("product_id").agg(F.min("category_id").alias("_first"))
    rows = membership.join(act, keys, "full_outer").join(first, "product_id", "left").filter("_a is null or _a < 2")
    primary = F.when(F.col("_first").isNotNull(), (F.col("category_id") == F.col("_first")).cast("int")).otherwise(F.coalesce("is_primary", F.lit(0)))
    return rows.select(*keys, primary.alias("is_primary"))


def merge_category(categories: DataFrame, membership: DataFrame, source: int, target: int) -> tuple[DataFrame, DataFrame]:
    """``source``'s members move to ``target``, whose own membership stays; ``source`` is dropped."""
    moved = membership.withColumn("_own", F.col("category_id") != source).withColumn("category_id", F.when(F.col("category_id") == source, F.lit(target)).otherwise(F.col("category_id")))
    kept = moved.groupBy("product_id", "category_id").agg(F.max_by("is_primary", F.struct("_own", "is_primary")).alias("is_primary"))
    return categories.filter(F.col("id") != source), kept


def rename_category(categories: DataFrame, old: str, new: str) -> DataFrame:
    """Renamed where no category has the new name yet; else unchanged."""
    taken = categories.agg(F.coalesce(F.max(F.col("name") == new), F.lit(False)).alias("_taken"))
    rows = categories.join(F.broadcast(taken))
    return rows.withColumn("name", F.when((F.col("name") == old) & ~F.col("_taken"), new).otherwise(F.col("name"))).drop("_taken")


def sync_primary(products: DataFrame, categories: DataFrame, membership: DataFrame) -> DataFrame:
    """Products with ``category`` the name of their primary category (lowest id), or null."""
    first = membership.filter("is_primary = 1").groupBy("product_id").agg(F.min("category_id").alias("_c"))
    names = categories.select(F.col("id").alias("_c"), F.col("name").alias("_name"))
    rows = products.join(first, F.col("id") == F.col("product_id"), "left").drop("product_id").join(names, "_c", "left")
    return rows.withColumn("category", F.col("_name")).drop("_c", "_name")


def with_family(products: DataFrame, families: DataFrame) -> DataFrame:
    """Products with family name and variant label."""
    rows = products.join(families.select(F.col("id").alias("family_id"), F.col("name").alias("family")), "family_id", "left")
    return rows.select("id", "name", "family", "variant_label")
