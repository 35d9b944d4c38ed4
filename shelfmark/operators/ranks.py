"""Ranks and running sums over keys of any size.

A window gathers a key in one task.  Where a key has more than TASK_ROWS, rows are dealt by
ranges of key and order instead, so a famous key is spread over as many tasks as its rows
fill, and the places in each range are shifted by what the ranges before it hold.  Both ways
give the same places; a count of the keys decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import scratch, written

#: Rows of a key that one task may sort.
TASK_ROWS = 1_000_000
#: Items of a key that one list may hold before it is cut.
LIST_ITEMS = 10_000
_SHIFT = 33  # Spark numbers the rows of partition p from p << 33


class Sort:
    """A column and the direction that Spark is to sort it in."""

    def __init__(self, column: Column, how: str):
        self.column, self.how = column, how


def up(c: Column | str) -> Sort:
    """Ascending, nulls first."""
    return Sort(F.col(c) if isinstance(c, str) else c, "asc_nulls_first")


def up_nulls_last(c: Column | str) -> Sort:
    return Sort(F.col(c) if isinstance(c, str) else c, "asc_nulls_last")


def down(c: Column | str) -> Sort:
    """Descending, nulls last."""
    return Sort(F.col(c) if isinstance(c, str) else c, "desc_nulls_last")


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in ranges of ``order``, with _at (ascending in that order) and its range _range, written."""
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    named = df.select("*", *[o.column.alias(f"_o{i}") for i, o in enumerate(order)])
    sorts = [getattr(k, o.how)() for o, k in zip(order, keys, strict=True)]
    rows = named.repartitionByRange(*sorts).sortWithinPartitions(*sorts).drop(*[f"_o{i}" for i in range(len(order))])
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    rows = written(rows, scratch(df.sparkSession, "ranks"))
    return rows.withColumn("_range", F.shiftright("_at", _SHIFT))


def _largest(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest key."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def ranked(df: DataFrame, by: str, order: Sequence[Sort], name: str = "rank") -> DataFrame:
    """``df`` with the place (from 1) of each row among those with its ``by``, in ``order``.

    The order must tell rows of a key apart; null is a key of its own.
    """
    if _largest(df, [by]) <= TASK_ROWS:
        place = F.row_number().over(Window.partitionBy(by).orderBy(*[getattr(o.column, o.how)() for o in order]))
        return df.withColumn(name, place.cast("long"))
    rows = _dealt(df, [up(by), *order])
    ranges = rows.groupBy(F.col(by).alias("_by"), F.col("_range").alias("_r")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # one row for each key and range that has it: as many as there are keys and ranges, at most
    before = Window.partitionBy("_by").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_by", "_r", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = rows.join(ranges, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_r")))
    return out.withColumn(name, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long")).select(*df.columns, name)


def running(df: DataFrame, order: Sequence[Sort], weight: str, name: str = "upto") -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows before each one, in ``order`` over all rows."""
    rows = _dealt(df, order)
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(F.col("_range").alias("_r")).agg(F.sum(weight).alias("_sum"))  # a row a range
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_r", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    out = rows.withColumn("_within", F.coalesce(F.sum(weight).over(within), F.lit(0))).join(F.broadcast(sums), F.col("_range") == F.col("_r"))
    return out.withColumn(name, F.col("_within") + F.col("_before")).select(*df.columns, name)


def first_of(df: DataFrame, by: Sequence[str], item: Column, most: int, distinct: bool = True) -> DataFrame:
    """``by``, ``n`` (how many items, different ones unless not ``distinct``) and ``items``: the first ``most`` in order.

    Where a key has more than LIST_ITEMS, each task sends the first ``most`` of a key at
    most, and counts, so no list grows with its key; the result is the same.
    """
    rows = df.select(*by, item.alias("_item")).filter(F.col("_item").isNotNull())
    if distinct:
        rows = rows.distinct()
    if _largest(rows, by) <= LIST_ITEMS:
        items = F.sort_array(F.collect_list("_item"))
        return rows.groupBy(*by).agg(F.count("*").alias("n"), F.slice(items, 1, most).alias("items"))
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_item"))
    first = rows.withColumn("_place", place).filter(F.col("_place") <= most)
    items = first.groupBy(*by).agg(F.sort_array(F.collect_list("_item")).alias("items"))
    return counts.join(items, list(by)).select(*by, "n", "items")
