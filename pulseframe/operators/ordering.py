"""Positions along a global order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_index(df: DataFrame, order: list[str], out: str, share: Column, keys: list[str] | None = None) -> DataFrame:
    """df with its row number from 0 along `order`, within `keys`. `share` is a coarse ascending function of the first
    order column (such as a file's first pulse): rows are numbered share by share, and the small table of shares, one row
    each, gives what goes before."""
    keys = keys or []
    df = df.withColumn("_share", share)
    counts = df.groupBy(*keys, "_share").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "_share", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).cast("bigint").alias("_ahead"))
    own = F.row_number().over(Window.partitionBy(*keys, "_share").orderBy(*order)) - 1
    return df.withColumn("_own", own).join(counts, [*keys, "_share"]).withColumn(out, F.col("_own") + F.col("_ahead")).drop("_share", "_own", "_ahead")


def row_before(df: DataFrame, columns: list[str], out: str, share: Column, order: str = "seq", keys: list[str] | None = None) -> DataFrame:
    """df with `out`, a struct of `columns` of the row before along `order`, within `keys`; null for the first. Inside a
    share by a window; the first row of a share takes the last row of the share before from a table with one row for each
    share. df also has `_share` then, by which it is dealt out."""
    keys = keys or []
    df = df.withColumn("_share", share)
    held = F.struct(*columns)
    last = df.groupBy(*keys, "_share").agg(F.max_by(held, order).alias("_last"))
    last = last.select(*keys, "_share", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_share")).alias("_carried"))
    own = F.lag(held).over(Window.partitionBy(*keys, "_share").orderBy(order))
    return df.withColumn(out, own).join(last, [*keys, "_share"]).withColumn(out, F.coalesce(out, "_carried")).drop("_carried")


def running_sum(df: DataFrame, value: str, out: str, order: str = "seq", keys: list[str] | None = None) -> DataFrame:
    """df, which has `_share`, with the sum of `value` up to the row, this one included, along `order` within `keys`."""
    keys = keys or []
    sums = df.groupBy(*keys, "_share").agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_share", F.coalesce(F.sum("_sum").over(ahead), F.lit(0).cast("bigint")).alias("_ahead"))
    upto = Window.partitionBy(*keys, "_share").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_own", F.sum(value).over(upto)).join(sums, [*keys, "_share"]).withColumn(out, F.col("_own") + F.col("_ahead")).drop("_own", "_ahead")
