"""Grants as interval unions: existence equals that of any single grant, one row per event."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from seawake.operators.authorization import authorization_join, grant_intervals

DAY = timedelta(days=1)
BASE = datetime(2020, 1, 1)
GRANTS = "vessel_id string, registry_rfmo string, registry_authorized_from timestamp, registry_authorized_to timestamp"


def test_grants_merge_where_they_overlap_and_not_where_they_touch(spark):
    days = [(0, 5), (3, 9), (9, 12), (9, 9), (20, 21), (4, 4), (30, 25), (0, 5)]
    grants = spark.createDataFrame([("v", "ICCAT", BASE + a * DAY, BASE + b * DAY) for a, b in days], GRANTS)
    (row,) = grant_intervals(grants).collect()
    assert [(b - BASE).days for b in row["begins"]] == [0, 9, 9, 20]
    assert [(e - BASE).days for e in row["ends"]] == [9, 9, 12, 21]
    assert [((g["begin"] - BASE).days, (g["end"] - BASE).days) for g in row["backward"]] == [(30, 25)]


def test_events_meet_the_lists_as_they_meet_the_grants(spark):
    rng = random.Random(1)
    grants = []
    for vessel in range(12):
        for _ in range(rng.randrange(0, 9)):
            a = rng.randrange(40)
            grants.append((f"v{vessel}", rng.choice(["ICCAT", "IOTC"]), BASE + a * DAY, BASE + (a + rng.randrange(-3, 9)) * DAY))
    events = []
    for i in range(300):
        a = rng.randrange(45)
        events.append((i, rng.choice([f"v{i % 12}", None]), rng.choice(["ICCAT", "IOTC", "NPFC"]), BASE + a * DAY, BASE + (a + rng.randrange(0, 6)) * DAY))
    rows = spark.createDataFrame(events, "n int, vessel string, rfmo string, start timestamp, finish timestamp")
    joined = authorization_join(rows, spark.createDataFrame(grants, GRANTS), "vessel", "start", "finish", "authorized")
    got = {r["n"]: r["authorized"] for r in joined.collect()}
    want = {n: any(v == g[0] and x == g[1] and a < g[3] and b > g[2] for g in grants) for n, v, x, a, b in events}
    assert joined.count() == len(events) and got == want


def test_a_vessel_of_many_grants_and_events(spark):
    grants = spark.range(10_000).select(
        F.lit("v").alias("vessel_id"),
        F.lit("ICCAT").alias("registry_rfmo"),
        F.timestamp_seconds(F.col("id") * 100).alias("registry_authorized_from"),
        F.timestamp_seconds(F.col("id") * 100 + 50).alias("registry_authorized_to"),
    )
    rows = spark.range(10_000).select(
        "id", F.lit("v").alias("vessel"), F.lit("ICCAT").alias("rfmo"),
        F.timestamp_seconds(F.col("id") * 100 + 10 + F.col("id") % 2 * 45).alias("start"),
        F.timestamp_seconds(F.col("id") * 100 + 20 + F.col("id") % 2 * 45).alias("finish"),
    )
    joined = authorization_join(rows, grants, "vessel", "start", "finish", "authorized")
    assert joined.groupBy("authorized").count().collect().__len__() == 2
    assert joined.filter("authorized = (id % 2 = 0)").count() == 10_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" not in plan and "Aggregate" not in plan.split("Join")[0]
