"""Helpers that the corpus operators share: stored tables, Arrow batches, session values."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GOLDEN = 0x9E3779B97F4A7C15


#: Rows in an Arrow batch: texts are long, and a worker holds a batch several times over.
BATCH_ROWS = 2000


def prepare_workers(spark: SparkSession) -> None:
    """Small Arrow batches; workers import this package from where the driver has it, whatever their working folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors share."""
    prepare_workers(spark)
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, so that a lost executor costs a few tasks and a
    frame that is used twice is computed once.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Values of a string column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def in_pieces(schema: pa.Schema, columns: list[np.ndarray], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from long columns."""
    for at in range(0, len(columns[0]), rows):
        yield batch(schema, *(c[at : at + rows] for c in columns))


def runs(batches: Iterable[pa.RecordBatch], key: str, most: int = 1 << 62) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
    """Numeric columns of sorted batches, cut so that no run of equal keys is split.

    A run of over ``most`` rows comes on its own, in pieces marked True, so
    that no more than a batch and ``most`` rows are held.
    """
    held: list[dict[str, np.ndarray]] = []
    size, long = 0, None
    for b in batches:
        now = {n: b.column(n).to_numpy(zero_copy_only=False) for n in b.schema.names}
        while len(now[key]):
            open_key = held[-1][key][-1] if held else long
            if open_key is not None and now[key][0] == open_key:
                cut = int(np.searchsorted(now[key], open_key, "right"))
                held.append({n: v[:cut] for n, v in now.items()})
                now = {n: v[cut:] for n, v in now.items()}
                size += cut
                if long is not None or size > most:
                    yield _joined(held), True
                    held, size, long = [], 0, open_key
                continue
            if held:
                yield _joined(held), False
            held, size, long = [], 0, None
            cut = int(np.searchsorted(now[key], now[key][-1]))
            if cut:
                starts = np.flatnonzero(np.r_[True, now[key][1:cut] != now[key][: cut - 1]])
                sizes = np.diff(np.r_[starts, cut])
                many = np.repeat(sizes > most, sizes)
                for flag in (False, True):
                    if (many == flag).any():
                        yield {n: v[:cut][many == flag] for n, v in now.items()}, flag
            held = [{n: v[cut:] for n, v in now.items()}]
            size = len(held[0][key])
            now = {n: v[:0] for n, v in now.items()}
            if size > most:
                long = held[0][key][-1]
                yield held.pop(), True
                size = 0
    if held:
        yield _joined(held), False


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that close values give unrelated ones."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
