"""Reading, writing and publishing tables.

All tables are partitioned by month and written in key order, so that both
partitions and Parquet statistics prune.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seawake.sources.schemas import EVENTS_SCHEMA, conform

MONTH = "event_start_month"
#: Table property that names a replacement of months which is written but not yet in place.
PENDING = "seawake.pending"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def ensure_table(spark: SparkSession, name: str, schema: StructType, month_column: str) -> None:
    """Create an empty month-partitioned table unless it exists."""
    if spark.catalog.tableExists(name):
        return
    layout = [(f.name, f.dataType.simpleString()) for f in schema] + [(month_column, "string")]
    columns = ", ".join(f"`{column}` {kind}" for column, kind in layout)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({month_column})")


def partitions(spark: SparkSession, name: str) -> list[str]:
    """Month values of a table's partitions, from the catalog."""
    return [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def change_catalog(spark: SparkSession, statement: str) -> None:
    """One statement that changes the catalog; such statements are the steps of a replacement."""
    spark.sql(statement)


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == key).collect()
    return found[0]["value"] if found else None


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    change_catalog(spark, f"ALTER TABLE {name} SET TBLPROPERTIES ({_literal(key)} = {_literal(value)})")


def _literal(text: str) -> str:
    """A text as a literal of a statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _location(spark: SparkSession, name: str, partition: str = "") -> str:
    """Folder of a table or partition; columns may be called Location, so it is looked for behind the column list."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect()]
    heading = "# Detailed Partition Information" if partition else "# Detailed Table Information"
    details = rows[[r[0] for r in rows].index(heading) + 1 :]
    return next(value for key, value in details if key == "Location")


def finish_replacement(spark: SparkSession, name: str) -> bool:
    """Complete a replacement of months that was interrupted; was there one?

    A replacement that was not announced in the table's properties has changed
    nothing, and its files are never read.
    """
    found = table_property(spark, name, PENDING)
    if found is None:
        return False
    plan = json.loads(found)
    column, present = plan["column"], set(partitions(spark, name))
    for month in plan["written"]:
        partition, place = f"PARTITION ({column} = {_literal(month)})", _literal(f"{plan['folder']}/{column}={month}")
        if month in present:
            change_catalog(spark, f"ALTER TABLE {name} {partition} SET LOCATION {place}")
        else:
            change_catalog(spark, f"ALTER TABLE {name} ADD {partition} LOCATION {place}")
    for month in plan["emptied"]:
        change_catalog(spark, f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {_literal(month)})")
    change_catalog(spark, f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    spark.catalog.refreshTable(name)
    return True


def replace_months(df: DataFrame, name: str, month_column: str, months: list[str]) -> None:
    """Let ``df`` take the place of some months, and of any others it has rows of.

    The new months are written to a folder of their own, which no reader looks
    into.  One change of the table's properties then announces them, and the
    catalog's partitions are pointed to them one by one; months left without
    rows are dropped last.  Files that are being read are never written over.
    Until the announcement an interruption changes nothing; after it,
    :func:`finish_replacement` (which every replacement calls first) completes
    the work.  Files of replaced months stay until :func:`clean_replaced`.
    """
    spark = df.sparkSession
    finish_replacement(spark, name)
    folder = f"{_location(spark, name)}/_replaced_{uuid.uuid4().hex}"
    columns = spark.table(name).schema
    df.select(*columns.names).write.partitionBy(month_column).parquet(folder)
    try:
        written = spark.read.schema(columns).parquet(folder).select(month_column).distinct().collect()
    except AnalysisException:  # nothing was written at all
        written = []
    new = sorted(row[0] for row in written)
    plan = {"column": month_column, "folder": folder, "written": new, "emptied": sorted(set(months) - set(new))}
    set_table_property(spark, name, PENDING, json.dumps(plan))
    finish_replacement(spark, name)


def clean_replaced(spark: SparkSession, name: str, month_column: str, min_age_hours: float = 7 * 24) -> list[str]:
    """Delete the files of months that were replaced or dropped; the folders that went.

    A replacement that was announced is completed first.  All folders of months
    are then compared with those that the catalog's partitions name, and the
    others go if nothing in them has changed for so many hours: long enough for
    readers that began before the replacement, and for a load that has written
    its files but not announced them.  An interrupted clean-up can be repeated.
    """
    finish_replacement(spark, name)
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(_location(spark, name))
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []

    def inner(path) -> list:
        return [f for f in system.listStatus(path) if f.isDirectory()]

    used = {
        hadoop.Path(_location(spark, name, f"PARTITION ({month_column} = {_literal(month)})")).toUri().getPath() for month in partitions(spark, name)
    }
    newest = spark._jvm.System.currentTimeMillis() - min_age_hours * 3_600_000
    gone = []
    for folder in inner(root):
        loads = folder.getPath().getName().startswith("_replaced_")
        months = inner(folder.getPath()) if loads else [folder]
        for month in months:
            path = month.getPath()
            if path.getName().startswith(f"{month_column}=") and path.toUri().getPath() not in used:
                changed = [month.getModificationTime(), *(f.getModificationTime() for f in system.listStatus(path))]
                if max(changed) <= newest and system.delete(path, True):
                    gone.append(path.toUri().getPath())
        if loads and folder.getModificationTime() <= newest and not inner(folder.getPath()):
            system.delete(folder.getPath(), True)
    return gone


def overwrite(df: DataFrame, name: str, partitions: str) -> None:
    """Replace all partitions (``static``) or only those with new rows (``dynamic``).

    The session setting decides, an option of the writer does not reach an insert.
    """
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, partitions)
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(name)


def write(
    df: DataFrame,
    name: str,
    mode: str = "append",
    month_source: str = "event_start",
    month_column: str = MONTH,
    order: tuple[str, ...] = ("seg_id", "event_start"),
) -> None:
    """Append to a month-partitioned table, or replace its whole content.

    Ranges over month and order keep a month in few files, and split one that
    is too large for a task.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    ensure_table(spark, name, df.schema, month_column)
    placed = (
        df.withColumn(month_column, month_of(F.col(month_source)))
        .repartitionByRange(month_column, *order)
        .sortWithinPartitions(month_column, *order)
    )
    if mode == "overwrite":
        overwrite(placed, name, "static")
    else:
        placed.write.insertInto(name)
        spark.catalog.refreshTable(name)


def _rewrite_months(spark: SparkSession, name: str, month_column: str, months: list[str], doomed: Column) -> None:
    """Delete rows from some months; the other months are not read."""
    rows = spark.table(name).filter(F.col(month_column).isin(months))
    kept = rows.filter(~F.coalesce(doomed, F.lit(False)))
    order = [c for c in ("seg_id", "event_start") if c in kept.columns]
    replace_months(kept.repartitionByRange(month_column, *order), name, month_column, months)


def in_range(column: str, first: str | date, last: str | date, inclusive: str = "both") -> Column:
    """``both``: time between the two midnights, ends included; ``left``: days of ``[first, last)``."""
    ts = F.col(column)
    low, high = F.lit(str(first)).cast("timestamp"), F.lit(str(last)).cast("timestamp")
    if inclusive == "both":
        return (ts >= low) & (ts <= high)
    if inclusive == "left":
        return (ts >= low) & (ts < high)
    raise ValueError(f"inclusive must be both or left, not {inclusive!r}")


def delete_range(df: DataFrame, column: str, first: str | date, last: str | date, inclusive: str = "both") -> DataFrame:
    """Rows outside a time range (rows without a time stay)."""
    return df.filter(~F.coalesce(in_range(column, first, last, inclusive), F.lit(False)))


def delete_range_from_table(
    spark: SparkSession,
    name: str,
    column: str,
    first: str | date,
    last: str | date,
    inclusive: str = "both",
    month_column: str = MONTH,
) -> None:
    """``delete_range`` on a stored table; ``column`` is the one its months come from."""
    finish_replacement(spark, name)
    months = [m for m in partitions(spark, name) if str(first)[:7] <= m <= str(last)[:7]]
    if months:
        _rewrite_months(spark, name, month_column, months, in_range(column, first, last, inclusive))


def version_names(dest: str, day: str | date) -> tuple[str, str]:
    """Names of the version of a day and of the day before."""
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return f"{dest}_v{day:%Y%m%d}", f"{dest}_v{day - timedelta(days=1):%Y%m%d}"


def dated_name(dest: str, day: str | date) -> str:
    """Name used by the fishing products: destination and date, without separator."""
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return f"{dest}{day:%Y%m%d}"


def publish_view(spark: SparkSession, name: str, target: str, schema: StructType = EVENTS_SCHEMA) -> None:
    columns = ", ".join(f"`{c}`" for c in schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {target}")


def drop_version(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def publish_versioned(
    df: DataFrame,
    name: str,
    day: str | date,
    view: str | None = None,
    drop_previous: bool = True,
    schema: StructType = EVENTS_SCHEMA,
    optional: tuple[str, ...] = ("seg_id",),
) -> str:
    """Write the version of a day, move the view to it, then drop the version before.

    Publishing a day again replaces its version.  With a view of its own name
    the table is called ``name + date`` and older versions stay.
    """
    spark = df.sparkSession
    current, previous = version_names(name, day) if view is None else (dated_name(name, day), None)
    write(conform(df, schema, optional), current, mode="overwrite")
    publish_view(spark, view or name, current, schema)
    if drop_previous and previous:
        drop_version(spark, previous)
    return current
