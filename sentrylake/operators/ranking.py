"""Order over a whole table without one task that holds it; joins that a hot key does not fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.session import materialise

#: Keys with more than one row in so many are hot: there are never more hot keys than this.
HOT_KEYS = 1000
#: So many narrow rows of one key may meet in a task.
NARROW_ROWS = 100_000
#: A table of at most so many rows, which are narrow, may be broadcast.
BROADCAST_ROWS = 500_000


def running_total(rows: DataFrame, weight: Column, *order: str) -> DataFrame:
    """``rows`` with ``total``: the weights of all rows up to and with this one in the given order.

    The table is range-partitioned by the order and written; each partition is summed by itself, and a
    table of one row a partition carries the sums of those before. The order must tell rows apart.
    """
    placed = rows.withColumn("__w", weight.cast("bigint")).repartitionByRange(*order).withColumn("__p", F.spark_partition_id())
    placed = materialise(placed, "ranges")
    sums = placed.groupBy("__p").agg(F.sum("__w").alias("__s"))
    before = F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("__p", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.sum("__w").over(Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("total", local).join(F.broadcast(offsets), "__p").withColumn("total", F.col("total") + F.col("__before")).drop("__p", "__w", "__before")


def join_hot(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, how: str = "inner", bound: int = 0) -> DataFrame:
    """``rows`` joined to ``table``, which has one row a key, and in ``count`` how many of ``rows`` have it.

    Keys of more than one row in HOT_KEYS (of ``total``) are broadcast, at most HOT_KEYS of them whatever
    the input; their rows stay where they are. The other keys' rows are shuffled, and none fills a task.
    ``rows`` is read twice. How: inner, or left (rows with a null key are met like keys of no match).
    Of at most ``bound`` rows in all no key can fill a task, and a plain join is made.
    """
    if total <= bound:
        return rows.join(table, key, how)
    hot = table.where(F.col(count) * HOT_KEYS > total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    near = rows.join(F.broadcast(hot), key)
    return near.unionByName(rest.join(table.where(F.col(count) * HOT_KEYS <= total), key, how))


def is_small(table: DataFrame) -> bool:
    """Whether a table has at most BROADCAST_ROWS rows, by counting so many; it should be written out before."""
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def if_small(table: DataFrame) -> DataFrame:
    """``table``, marked to be broadcast where it has been counted to be small; it should be written out before."""
    return F.broadcast(table) if is_small(table) else table
