import pytest
from pyspark.sql import functions as F

from seawake.plans.fishing import publish_fishing
from seawake.sources import tables
from seawake.sources.schemas import EVENTS_SCHEMA, conform
from tests.helpers import at


def events(spark, *starts):
    rows = [(f"e{i}", at(s)) for i, s in enumerate(starts)]
    df = spark.createDataFrame(rows, "event_id string, event_start timestamp")
    return conform(df, EVENTS_SCHEMA, optional=tuple(EVENTS_SCHEMA.names))


def ids(spark, name):
    return sorted(r.event_id for r in spark.table(name).collect())


def test_version_names():
    assert tables.version_names("p.d.t", "2024-01-01") == ("p.d.t_v20240101", "p.d.t_v20231231")
    assert tables.dated_name("t", "2024-01-01") == "t20240101"


def test_publishing_swaps_the_view_and_drops_the_day_before(spark):
    tables.publish_versioned(events(spark, "2024-01-01 00:00:00"), "swap", "2024-03-09")
    tables.publish_versioned(events(spark, "2024-01-01 00:00:00", "2024-02-01 00:00:00"), "swap", "2024-03-10")
    assert ids(spark, "swap") == ["e0", "e1"] and spark.table("swap").schema.names == EVENTS_SCHEMA.names
    assert spark.catalog.tableExists("swap_v20240310") and not spark.catalog.tableExists("swap_v20240309")
    assert tables.partitions(spark, "swap_v20240310") == ["2024-01", "2024-02"]
    # publishing a day again replaces it
    tables.publish_versioned(events(spark, "2024-05-01 00:00:00"), "swap", "2024-03-10")
    assert ids(spark, "swap") == ["e0"]
    assert tables.partitions(spark, "swap_v20240310") == ["2024-05"]


def test_fishing_tables_keep_older_versions(spark):
    for day in ("2024-03-09", "2024-03-10"):
        publish_fishing(events(spark, "2024-01-01 00:00:00"), "fish", day, "fish_view")
    assert spark.catalog.tableExists("fish20240309") and spark.catalog.tableExists("fish20240310")
    assert ids(spark, "fish_view") == ["e0"]


def test_append_and_delete(spark):
    tables.write(events(spark, "2024-01-31 00:00:00", "2024-02-01 00:00:00"), "logs")
    tables.write(events(spark, "2024-03-01 00:00:00"), "logs")
    assert spark.table("logs").count() == 3
    tables.delete_range_from_table(spark, "logs", "event_start", "2024-02-01", "2024-03-01", "left")
    assert tables.partitions(spark, "logs") == ["2024-01", "2024-03"]
    tables.delete_range_from_table(spark, "logs", "event_start", "2024-02-01", "2024-03-01")
    assert tables.partitions(spark, "logs") == ["2024-01"]
    with pytest.raises(ValueError):
        tables.write(events(spark, "2024-01-31 00:00:00"), "logs", mode="upsert")


def test_conform(spark):
    with pytest.raises(ValueError, match="seg_id"):
        conform(spark.range(1).select(F.lit("x").alias("event_id")), EVENTS_SCHEMA)
    assert tables.read_table(spark, "logs").count() == 1


def test_files_of_replaced_months_are_cleaned(spark):
    from seawake.sources import tables

    spark.sql("DROP TABLE IF EXISTS cleaned")
    # a column that is called as the catalog calls the table's folder
    spark.sql("CREATE TABLE cleaned (id INT, Location STRING, month STRING) USING parquet PARTITIONED BY (month)")
    rows = spark.createDataFrame([(1, "it's", "2024-01"), (2, "b", "2024-02")], "id int, Location string, month string")
    tables.replace_months(rows, "cleaned", "month", ["2024-01", "2024-02"])
    tables.replace_months(rows.withColumn("id", F.col("id") + 10), "cleaned", "month", ["2024-01", "2024-02"])
    tables.replace_months(rows.filter("month = '2024-02'").withColumn("id", F.lit(22)), "cleaned", "month", ["2024-02"])
    want = [(11, "2024-01"), (22, "2024-02")]

    def held():
        return sorted((r["id"], r["month"]) for r in spark.table("cleaned").collect())

    assert held() == want
    assert tables.clean_replaced(spark, "cleaned", "month") == []  # too young
    gone = tables.clean_replaced(spark, "cleaned", "month", min_age_hours=0)
    assert sorted(x.rsplit("/", 1)[1] for x in gone) == ["month=2024-01", "month=2024-02", "month=2024-02"]
    assert held() == want and tables.clean_replaced(spark, "cleaned", "month", min_age_hours=0) == []
    # an announced replacement is completed before anything goes
    steps = []

    def interrupted(session, statement):
        steps.append(statement)
        if len(steps) > 1:
            raise RuntimeError
        session.sql(statement)

    plain = tables.change_catalog
    tables.change_catalog = interrupted
    try:
        tables.replace_months(rows.withColumn("id", F.lit(5)), "cleaned", "month", ["2024-01", "2024-02"])
    except RuntimeError:
        pass
    finally:
        tables.change_catalog = plain
    tables.clean_replaced(spark, "cleaned", "month", min_age_hours=0)
    assert held() == [(5, "2024-01"), (5, "2024-02")]
    spark.sql("DROP TABLE cleaned")
