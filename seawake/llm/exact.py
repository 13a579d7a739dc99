"""Exact deduplication with a two-pass Bloom filter.

Pass one hashes each text and finds, in a Bloom filter of bounded size, the
hashes that may occur again.  In pass two only rows with such a hash are
shuffled and compared by the SHA-256 of the whole text; all others pass
straight through as single rows.

Defined cases: a null text counts as empty; empty texts are equal to each
other; a null id loses to any other id; rows that repeat in id and text are
members of their group, and :func:`without_copies` keeps one of them.  Further
columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import ascii_lower, stored
from seawake.llm.repeats import filter_bits, marked, repeated_keys

BITS_PER_ROW = 32
HASHES = 3


def _flag(hashed: DataFrame):
    """A test for rows whose text may occur again; ``hashed`` has their hashes as ``h``."""
    bits = filter_bits(hashed.count(), BITS_PER_ROW)
    plane = repeated_keys(hashed.select("h"), bits, HASHES)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(marked(h.to_numpy(), plane.value, bits, HASHES))

    return maybe


def _sha(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


def _groups(hashed: DataFrame, maybe) -> tuple[DataFrame, DataFrame]:
    """Rows that may have copies, and the stored groups of their hashes."""
    rows = hashed.filter(maybe("h"))
    groups = rows.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows, stored(groups, "exact-groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id (largest id of equal texts), group_size, kept, text_sha256."""
    normal = ascii_lower(F.col(text_col))
    hashed = stored(docs.select(F.col(id_col).alias("id"), _sha(normal).alias("sha"), F.xxhash64(normal).alias("h")), "exact-hashes")
    maybe = _flag(hashed)
    rows, groups = _groups(hashed, maybe)
    several = rows.join(groups, "sha").select("id", "keep_id", "group_size", "sha")
    single = hashed.filter(~maybe("h")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    return single.unionByName(several).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with one row left of each group of equal texts; columns unchanged."""
    normal = ascii_lower(F.col(text_col))
    hashed = stored(docs.select(F.col(id_col).alias("id"), _sha(normal).alias("sha"), F.xxhash64(normal).alias("h")), "exact-hashes")
    maybe = _flag(hashed)
    _, groups = _groups(hashed, maybe)
    # columns of the input travel in a struct, so that no name can clash
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(normal).alias("h"), normal.alias("normal"))
    single = rows.filter(~maybe("h")).select("row.*")
    several = rows.filter(maybe("h")).select("row", F.col("id").alias("keep_id"), _sha(F.col("normal")).alias("sha"))
    best = groups.select(F.col("sha").alias("g_sha"), F.col("keep_id").alias("g_id"))
    winners = several.join(best, (F.col("sha") == F.col("g_sha")) & F.col("keep_id").eqNullSafe(F.col("g_id")), "left_semi")
    return single.unionByName(winners.dropDuplicates(["sha"]).select("row.*"))
