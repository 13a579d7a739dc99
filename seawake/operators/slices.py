"""Ordered work on keys of any size.

A window over a whole key puts the key in one task, however long it is.  The
operators here cut each key into time slices first.  Rows are only ever
gathered per (key, slice); what a slice must know about earlier slices travels
as one summary row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "time_slice"


def time_slice(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds)


def rows_in_slice(key: str, order: str):
    return Window.partitionBy(key, SLICE).orderBy(order)


def slices_of(key: str):
    """Summaries of one key in time order."""
    return Window.partitionBy(key).orderBy(SLICE)


def lag_within_key(
    df: DataFrame, key: str, order: str, columns: dict[str, str], seconds: int
) -> DataFrame:
    """Add ``columns`` (new name -> source column) from the previous row of the key.

    Equal to ``lag(...) over (partition by key order by order)``.
    """
    sliced = df.withColumn(SLICE, time_slice(F.col(order), seconds))
    fields = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    before = (
        sliced.groupBy(key, SLICE)
        .agg(F.max_by(fields, F.col(order)).alias("closing"))
        .select(key, SLICE, F.lag("closing").over(slices_of(key)).alias("carried"))
    )
    inside = sliced.withColumn("inside", F.lag(fields).over(rows_in_slice(key, order)))
    joined = inside.join(before, [key, SLICE])
    previous = F.coalesce(F.col("inside"), F.col("carried"))
    return joined.select(*df.columns, *[previous[name].alias(name) for name in columns])


def with_group_max(
    df: DataFrame, keys: list[str], order: str, outputs: dict[str, Column], seconds: int
) -> DataFrame:
    """Add maxima over groups that may be arbitrarily large.

    Equal to ``max(...) over (partition by keys)`` for non-null keys.
    """
    sliced = df.withColumn(SLICE, time_slice(F.col(order), seconds))
    whole = Window.partitionBy(*keys)
    names = list(outputs)
    maxima = (
        sliced.groupBy(*keys, SLICE)
        .agg(*[F.max(value).alias(name) for name, value in outputs.items()])
        .select(*keys, SLICE, *[F.max(name).over(whole).alias(name) for name in names])
    )
    kept = [c for c in df.columns if c not in names]
    return sliced.select(*kept, SLICE).join(maxima, [*keys, SLICE]).select(*kept, *names)
