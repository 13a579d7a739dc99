"""What port visits shuffle."""

from pyspark.sql import functions as F

from seawake.plans.port_visits import first_ranked, ranked_in_row
from seawake.sources import samples


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_visits_meet_their_lines_on_the_key_the_lines_are_grouped_by(spark, tmp_path):
    events = [(1, "2024-01-01 00:00:10", 1, "view", 5.0, None)]
    spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, "S0", 0), (1, "S1", 1)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(7, 3), (8, 3), (None, 3)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(7, 2, 20, 0, 1.0), (7, 1, 21, 1, 2.0), (7, 1, 21, 1, 1.0), (9, 1, 1, 1, 1.0), (None, 1, 1, 1, 1.0)]
    layout = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"
    spark.createDataFrame(lines, layout).write.parquet(f"{tmp_path}/lineitem.parquet")
    visits = samples.port_visits(spark, str(tmp_path))
    got = {r["visit_id"]: [(e["seg_id"], e["anchorage_id"]) for e in r["events"]] for r in visits.collect()}
    assert got == {"pv7": [("s6", "a1"), ("s6", "a1"), ("s5", "a0")], "pv8": []}
    assert "hashpartitioning(visit_id" not in plan(visits)


def test_nested_events_stay_behind_once_the_first_is_chosen(spark):
    visits = spark.sql(
        "SELECT 'v' AS visit_id, 'a' AS vessel_id, array(named_struct('event_type', 'PORT_STOP_BEGIN', 'timestamp',"
        " timestamp'2024-01-01', 'anchorage_id', 'x', 'seg_id', 's')) AS events"
    )
    assert ranked_in_row(visits, "vessel_id").columns == ["visit_id", "vessel_id", "best"]
    assert first_ranked(visits).select("event_anchorage_id").collect()[0][0] == "x"
