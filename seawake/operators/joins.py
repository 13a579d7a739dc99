"""Join shapes Spark has no single operator for."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_SECONDS = 30 * 86_400
# Buckets outside these times are folded into the outermost ones, which keeps
# open intervals finite and the result the same.
FIRST_BUCKET_TIME = datetime(2012, 1, 1)
LAST_BUCKET_TIME = datetime(2040, 1, 1)


def semi(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose values in the columns of keys occur there."""
    return df.join(keys, keys.columns, "left_semi")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equality join in which null equals null; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, matches, how).drop(*[f"__{k}" for k in keys])


def _bucket(ts: Column) -> Column:
    seconds = [int((t - datetime(1970, 1, 1)).total_seconds()) for t in (FIRST_BUCKET_TIME, LAST_BUCKET_TIME)]
    first, last = (s // BUCKET_SECONDS for s in seconds)
    number = F.floor(F.unix_seconds(ts.cast("timestamp")) / BUCKET_SECONDS)
    # greatest and least skip nulls, a missing time must stay missing
    return F.when(number.isNotNull(), F.greatest(F.lit(first), F.least(F.lit(last), number)))


def range_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    at: str,
    low: str,
    high: str,
    condition: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """Rows of left whose time ``at`` lies in ``[low, high]`` of right, with equal keys.

    A null bound is open.  Time buckets join the equality keys, so that a key
    with many rows on both sides is not compared all with all: an interval is
    repeated for each bucket it meets, a row of left is in one bucket only, and
    every pair is found once.  ``condition`` narrows the match further.
    """
    first = F.coalesce(_bucket(F.col(low)), _bucket(F.lit(FIRST_BUCKET_TIME)))
    last = F.coalesce(_bucket(F.col(high)), _bucket(F.lit(LAST_BUCKET_TIME)))
    spread = right.withColumn("bucket", F.explode(F.when(first <= last, F.sequence(first, last)))).alias("r")
    placed = left.withColumn("bucket", _bucket(F.col(at))).alias("l")
    l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    match = reduce(lambda a, b: a & b, [l(k) == r(k) for k in [*keys, "bucket"]])
    match = match & (r(low).isNull() | (l(at) >= r(low))) & (r(high).isNull() | (l(at) <= r(high)))
    if condition is not None:
        match = match & condition
    extra = [c for c in right.columns if c not in left.columns]
    return placed.join(spread, match, how).select(*[l(c) for c in left.columns], *[r(c) for c in extra])
