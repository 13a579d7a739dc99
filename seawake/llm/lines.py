"""Line deduplication that can be taken back: reference counts of lines behind sharded cuckoo filters.

The index holds, for each key (a long enough line, stripped and lower-cased),
in how many documents it occurs and the smallest of their ids, exactly and by
128 bits of a cryptographic hash.  Its tables only grow by rows with a version:

* ``refs``: which document holds which key; ``removed``: documents that went.
* ``counts``: number of documents and smallest id of a key; its newest row holds.
* ``filters``: a cuckoo filter of the held keys for each shard of the key space.

An insertion sums the keys of its documents and meets them with the filters,
a byte or two for each held key.  A key that no filter knows is new, and its
row is appended without any reading of the counts; only the others are looked
up.  A deletion lowers the counts of a document's keys, elects another smallest
id where that document was it, and takes keys without documents out of the
filters.  So inserting and deleting in any order gives the index of the
documents that are left.  Shards are as many as the number of keys asks for;
a shard that is full is built anew from the counts.

:func:`line_digests` and :func:`without_repeated_lines` drop the lines of
repeated keys from all documents but the one with the smallest id.

Defined cases: null and empty texts have one empty line; a null id counts as
the largest id; rows of one id are one document, whose lines all stay where it
is the smallest, and repeats of a line within a document are no reason to drop
it; inserting an id that is held changes nothing, as does deleting one that is
not; documents the index does not hold stay whole; empty tables give an empty
index and no rows; texts of any length are read whole, line by line; further
columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm.common import batch, prepare_workers, stored, strings
from seawake.llm.cuckoo import Cuckoo

SPACE = b" \t\n\x0b\x0c\r"
LEAST_POINTS = 10
#: Keys of a shard, on the average; a shard is a task's work.
SHARD_KEYS = 1 << 16
LAST_ID = (1 << 63) - 1
#: Increments that the whole-table query loads one after the other.
INCREMENTS = 2


def line_key(line: bytes) -> bytes | None:
    """Hash of a line as it is compared; None if it is too short to be dropped."""
    plain = line.strip(SPACE).lower()
    if len(plain) < LEAST_POINTS or len(plain) < 4 * LEAST_POINTS and len(plain.decode("utf-8", "replace")) < LEAST_POINTS:
        return None
    return hashlib.blake2b(plain, digest_size=16).digest()


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``key``: each key of each document once."""
    schema = pa.schema([("doc", pa.int64()), ("key", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = [], []
            for doc, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                own = set(map(line_key, set(text.encode().split(b"\n"))))
                own.discard(None)
                ids += [doc] * len(own)
                keys += own
            yield batch(schema, ids, keys)

    rows = docs.select(_doc(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(of, "doc long, key binary").distinct()


def _numbers(keys: pd.Series) -> np.ndarray:
    """64 bits of each key for the filters."""
    return np.frombuffer(b"".join(map(bytes, keys)), "<u8").reshape(-1, 2)[:, 1]


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


@dataclass(frozen=True)
class LineIndex:
    """The index after some insertions and deletions; each of these returns a new one."""

    refs: DataFrame
    removed: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int = 1
    version: int = 0

    @classmethod
    def empty(cls, spark: SparkSession) -> LineIndex:
        prepare_workers(spark)
        none = spark.range(0)
        return cls(
            none.selectExpr("id AS doc", "CAST(NULL AS binary) AS key", "0 AS version"),
            none.selectExpr("id AS doc", "0 AS version"),
            none.selectExpr("CAST(NULL AS binary) AS key", "id AS documents", "id AS first", "0 AS version"),
            none.selectExpr("0 AS shard", "CAST(NULL AS binary) AS filter"),
        )

    def save(self, folder: str) -> None:
        """Write all tables below a folder; the number of shards and the version are in ``about``."""
        for name in ("refs", "removed", "counts", "filters"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/{name}")
        about = self.refs.sparkSession.createDataFrame([(self.shards, self.version)], "shards int, version int")
        about.coalesce(1).write.mode("overwrite").parquet(f"{folder}/about")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> LineIndex:
        prepare_workers(spark)
        about = spark.read.parquet(f"{folder}/about").first()
        tables = [spark.read.parquet(f"{folder}/{name}") for name in ("refs", "removed", "counts", "filters")]
        return cls(*tables, about["shards"], about["version"])

    def current(self) -> DataFrame:
        """``key``, ``documents``, ``first`` of each key that was ever held; 0 documents where all went."""
        newest = self.counts.groupBy("key").agg(F.max_by(F.struct("documents", "first"), "version").alias("now"))
        return newest.select("key", "now.documents", "now.first")

    def held(self) -> DataFrame:
        """References of the documents that are held."""
        return self.refs.alias("r").join(
            self.removed.alias("x"), (F.col("r.doc") == F.col("x.doc")) & (F.col("r.version") < F.col("x.version")), "left_anti"
        )

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with further documents; ids that are held already are left out."""
        version = self.version + 1
        refs = references(docs, id_col, text_col)
        if self.version:
            refs = refs.join(self.held().select("doc").distinct(), "doc", "left_anti")
        refs = stored(refs.withColumn("version", F.lit(version)), "line-refs")
        fresh = stored(refs.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.min("doc").alias("first")), "line-keys")
        keys = fresh.count() + (self.counts.count() if self.version else 0)
        index = self if keys <= 4 * SHARD_KEYS * self.shards else self._dealt(-(-keys // SHARD_KEYS))
        known = stored(index._probed(fresh), "line-probed")
        old = index.current().withColumnsRenamed({"documents": "old_documents", "first": "old_first"})
        # only keys that a filter knows are looked up
        met = known.filter("known").join(old, "key", "left")
        met = met.select(
            "key",
            (F.col("documents") + F.coalesce("old_documents", F.lit(0))).alias("documents"),
            # the smallest id of a key without documents is of no use
            F.when(F.coalesce("old_documents", F.lit(0)) > 0, F.least("first", "old_first")).otherwise(F.col("first")).alias("first"),
            (F.coalesce("old_documents", F.lit(0)) == 0).alias("new"),
        )
        rows = known.filter(~F.col("known")).select("key", "documents", "first", F.lit(True).alias("new")).unionByName(met)
        rows = stored(rows.withColumn("version", F.lit(version)), "line-counts")
        grown = replace(
            index,
            refs=index.refs.unionByName(refs),
            counts=index.counts.unionByName(rows.drop("new")),
            version=version,
        )
        return grown._filtered(rows.filter("new").select("key", F.lit(True).alias("enters")))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids."""
        version = self.version + 1
        gone = ids.select(_doc(id_col).alias("doc")).distinct()
        gone = stored(gone.join(self.held().select("doc").distinct(), "doc", "left_semi").withColumn("version", F.lit(version)), "line-removed")
        lost = self.held().join(gone.select("doc"), "doc").groupBy("key").agg(F.count(F.lit(1)).alias("lost"), F.min("doc").alias("lost_first"))
        left = stored(
            lost.join(self.current(), "key").select(
                "key", (F.col("documents") - F.col("lost")).alias("documents"), "first", (F.col("first") == F.col("lost_first")).alias("elect")
            ),
            "line-left",
        )
        after = replace(self, removed=self.removed.unionByName(gone), version=version)
        open_keys = left.filter("elect AND documents > 0").select("key")
        elected = after.held().join(open_keys, "key", "left_semi").groupBy("key").agg(F.min("doc").alias("elected"))
        rows = left.join(elected, "key", "left").select("key", "documents", F.coalesce("elected", "first").alias("first"))
        rows = stored(rows.withColumn("version", F.lit(version)), "line-counts")
        after = replace(after, counts=self.counts.unionByName(rows))
        return after._filtered(rows.filter("documents = 0").select("key", F.lit(False).alias("enters")))

    def _probed(self, fresh: DataFrame) -> DataFrame:
        """The rows with ``known``: whether their shard's filter may hold the key."""

        def probe(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            known = np.zeros(len(rows), bool)
            if len(filters) and len(rows):
                known = Cuckoo.from_bytes(filters["filter"].iloc[0]).contains(_numbers(rows["key"]))
            return rows.drop(columns="shard").assign(known=known)

        groups = fresh.withColumn("shard", _shard(self.shards)).groupBy("shard").cogroup(self.filters.groupBy("shard"))
        return groups.applyInPandas(probe, "key binary, documents long, first long, known boolean")

    def _filtered(self, changes: DataFrame) -> LineIndex:
        """The index with filters that hold entering keys and no leaving ones (``enters``)."""

        def change(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            shard = (rows if len(rows) else filters)["shard"].iloc[0]
            if not len(rows):
                return filters[["shard", "filter"]]
            whole = None
            if len(filters):
                held = Cuckoo.from_bytes(filters["filter"].iloc[0])
                held.remove(_numbers(rows["key"][~rows["enters"]]))
                enters = _numbers(rows["key"][rows["enters"]])
                if held.has_room(len(enters)) and held.insert(enters):
                    whole = held.to_bytes()
            return pd.DataFrame({"shard": [shard], "filter": [whole]})

        groups = changes.withColumn("shard", _shard(self.shards)).groupBy("shard").cogroup(self.filters.groupBy("shard"))
        filters = stored(groups.applyInPandas(change, "shard int, filter binary"), "line-filters")
        full = filters.filter("filter IS NULL").select("shard")
        if not full.isEmpty():
            filters = stored(filters.filter("filter IS NOT NULL").unionByName(self._built(full)), "line-filters")
        return replace(self, filters=filters)

    def _built(self, shards: DataFrame | None = None) -> DataFrame:
        """Filters made from the counts, of some shards or all."""

        def build(rows: pd.DataFrame) -> pd.DataFrame:
            keys, room = _numbers(rows["key"]), 2 * len(rows)
            while not (made := Cuckoo.sized(room)).insert(keys):
                room *= 2
            return pd.DataFrame({"shard": rows["shard"].iloc[:1], "filter": [made.to_bytes()]})

        keys = self.current().filter("documents > 0").select(_shard(self.shards), "key")
        if shards is not None:
            keys = keys.join(shards, "shard", "left_semi")
        return keys.groupBy("shard").applyInPandas(build, "shard int, filter binary")

    def _dealt(self, shards: int) -> LineIndex:
        """The index with another number of shards."""
        dealt = replace(self, shards=shards)
        return replace(dealt, filters=stored(dealt._built(), "line-filters")) if self.version else dealt


def dropped_keys(index: LineIndex) -> DataFrame:
    """``doc``, ``keys``: the keys whose lines go, for each document that loses any."""
    shared = index.current().filter("documents > 1").select("key", "first")
    gone = index.held().select("doc", "key").join(shared, "key").filter("doc <> first")
    return gone.groupBy("doc").agg(F.collect_list("key").alias("keys"))


def kept_lines(text: str, keys: list[bytes] | None) -> tuple[list[bytes], int]:
    """The lines that stay, and how many there were."""
    lines = text.encode().split(b"\n")
    if not keys:
        return lines, len(lines)
    gone = set(keys)
    return [x for x in lines if line_key(x) not in gone], len(lines)


def line_digests(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_lines, n_dropped and the SHA-256 of the lines that stay, for each document."""
    schema = pa.schema([("id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [kept_lines(t, k) for t, k in zip(strings(b.column(1)), b.column(2).to_pylist(), strict=True)]
            sha = [hashlib.sha256(b"\n".join(kept)).hexdigest() for kept, _ in found]
            yield batch(schema, b.column(0), [n for _, n in found], [n - len(kept) for kept, n in found], sha)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), _doc(id_col).alias("doc"))
    rows = rows.join(dropped_keys(index), "doc", "left").select("id", "text", "keys")
    return rows.mapInArrow(of, "id long, n_lines long, n_dropped long, kept_sha256 string").withColumnRenamed("id", id_col)


def without_repeated_lines(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their repeated lines; other columns unchanged, null texts stay null."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series([b"\n".join(kept_lines(t, None if k is None else map(bytes, k))[0]).decode() for t, k in zip(text, keys, strict=True)])

    # columns of the input travel in a struct, so that no name can clash
    rows = docs.select(F.struct("*").alias("row"), _doc(id_col).alias("doc")).join(dropped_keys(index), "doc", "left")
    text = F.when(F.col("keys").isNull(), F.col(f"row.`{text_col}`")).otherwise(cut(F.col(f"row.`{text_col}`"), F.col("keys")))
    return rows.select(F.col("row").withField(f"`{text_col}`", text).alias("row")).select("row.*")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", increments: int = INCREMENTS) -> LineIndex:
    """An index of all documents, loaded in increments by the hash of their ids."""
    index = LineIndex.empty(docs.sparkSession)
    for n in range(increments):
        index = index.insert(docs.filter(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(increments)) == n), id_col, text_col)
    return index
