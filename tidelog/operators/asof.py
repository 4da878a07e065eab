"""As-of values along a feed, without sorting the feed in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Messages in a stretch of the feed that is put in order at once.
STRETCH = 1 << 16


def as_of(rows: DataFrame, keys: list[str], mark: Column, value: Column, name: str, order: str = "seq") -> DataFrame:
    """Adds ``name``: ``value`` of the last row at or before each one, with equal ``keys``, for which ``mark`` holds.

    The feed is cut into stretches by its order. Each hands its last mark on to the
    later ones (a row a stretch), and rows are only sorted inside their own, so a
    busy table, or a feed of one table, is spread over all tasks.
    """
    cut = rows.withColumn("stretch_", F.floor(F.col(order) / F.lit(STRETCH)).cast("bigint")).withColumn("mark_", F.when(mark, value))
    ends = cut.groupBy(*keys, "stretch_").agg(F.max_by("mark_", F.when(mark, F.col(order))).alias("end_"))
    before = Window.partitionBy(*keys).orderBy("stretch_").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "stretch_", F.last("end_", ignorenulls=True).over(before).alias("carried_"))
    inside = F.last("mark_", ignorenulls=True).over(Window.partitionBy(*keys, "stretch_").orderBy(order))
    out = cut.join(carried, [*keys, "stretch_"]).withColumn(name, F.coalesce(inside, F.col("carried_")))
    return out.select(*rows.columns, name)
