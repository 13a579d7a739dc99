"""Continuous loads: a stream of messages keeps the state up to date.

Each batch is first kept as files of its own, by day, so that a load finds the
days around it as well.  The state is then loaded from the first day the batch
has messages of to the last day known so far: late messages reload what came
after them, and the result is that of one load of all messages.

A table property of the state names the last batch that is in it.  A batch
that is delivered again after a restart overwrites its own files, and is not
loaded if the state has it; one that was interrupted in between is loaded
again, which changes nothing that was right (see :func:`load_increment`).
"""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from seawake.sources.schemas import STATE_SCHEMA
from seawake.sources.tables import ensure_table, set_table_property, table_property
from seawake.streaming.incremental import MONTH, load_increment

DAY, BATCH = "message_day", "message_batch"


def progress(spark: SparkSession, state_table: str, stream: str) -> tuple[int, date | None]:
    """The last batch of a stream that the state has, and the end of the days loaded so far."""
    found = table_property(spark, state_table, f"seawake.stream.{stream}")
    if found is None:
        return -1, None
    known = json.loads(found)
    return known["batch"], date.fromisoformat(known["until"]) if known["until"] else None


def keep_batch(batch: DataFrame, batch_id: int, store: str) -> None:
    """Keep the messages of a batch in partitions of their own, which a repetition replaces."""
    placed = batch.withColumns({DAY: F.to_date("timestamp"), BATCH: F.lit(batch_id).cast("long")})
    order = [DAY, "seg_id", "timestamp"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY, BATCH).parquet(store)


def load_batch(
    batch: DataFrame,
    batch_id: int,
    store: str,
    state_table: str,
    score_field: str,
    stream: str = "messages",
    max_gap_hours: float = 2,
) -> None:
    """Keep a batch and load the days it changes; a batch that the state has is left out.

    Messages without a time are kept and never loaded; a batch without messages
    changes the recorded progress only.
    """
    spark = batch.sparkSession
    ensure_table(spark, state_table, STATE_SCHEMA, MONTH)
    loaded, until = progress(spark, state_table, stream)
    if batch_id <= loaded:
        return
    keep_batch(batch, batch_id, store)
    schema = StructType([*batch.schema, StructField(DAY, DateType()), StructField(BATCH, LongType())])
    messages = spark.read.schema(schema).parquet(store)
    first, last = messages.filter(F.col(BATCH) == batch_id).agg(F.min(DAY), F.max(DAY)).first()
    if first is not None:
        end = last + timedelta(days=1)
        until = end if until is None else max(until, end)
        # partitions of other days are not listed for the scan
        near = messages.filter((F.col(DAY) >= first - timedelta(days=1)) & (F.col(DAY) < until))
        load_increment(spark, near.drop(DAY, BATCH), state_table, first, until, score_field, max_gap_hours)
    known = {"batch": batch_id, "until": until.isoformat() if until else None}
    set_table_property(spark, state_table, f"seawake.stream.{stream}", json.dumps(known))


def load_stream(
    messages: DataFrame,
    store: str,
    state_table: str,
    score_field: str,
    offsets: str,
    stream: str = "messages",
    max_gap_hours: float = 2,
) -> StreamingQuery:
    """Load all that a stream of messages has now, batch by batch; start it again for what comes later.

    ``store`` and ``offsets`` are folders that all executors share.  Batches are
    numbered by the offsets, so other offsets need another name of the stream.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, store, state_table, score_field, stream, max_gap_hours)

    return messages.writeStream.foreachBatch(load).option("checkpointLocation", offsets).trigger(availableNow=True).start()
