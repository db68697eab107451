"""Session columns against a brute-force walk, with and without time chunks."""

import random

import pytest
from pyspark.sql import functions as F

from funnelwright.functions.times import DayRange
from funnelwright.operators.sessions import session_columns
from funnelwright.queries.inputs import EVENT_DAYS, web_events
from funnelwright.queries.registry import Tables
from funnelwright.plans.funnel import session_funnel

SCHEMA = "s string, t bigint, name string, v string, page string, n int"


def events(seed, size):
    rng = random.Random(seed)
    sessions = [None, None, "", "a", "b", "c"]
    return list(
        {
            (
                rng.choice(sessions),
                rng.randrange(0, 600),
                f"e{i}",
                rng.choice([None, None, f"v{i}"]),
                rng.choice([None, f"p{i}"]),
                rng.randrange(0, 3),
            )
            for i in range(size)
        }
    )


def brute_force(rows):
    result = []
    for s, t, name, v, page, n in rows:
        session = sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2]))
        seen = [r[3] for r in session if r[1] <= t and r[3] is not None]
        result.append((s, t, name, seen[-1] if seen else None, session[0][4], max(r[5] for r in session)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("hot_rows", [10**6, 0, 1, 7, 40])
def test_matches_brute_force(spark, rows, hot_rows):
    data = events(hot_rows, 200)
    df = spark.createDataFrame(data, SCHEMA).withColumn("at", F.timestamp_seconds("t"))
    result = session_columns(
        df.repartition(5), "s", "at", ["name"], {"v": "v"}, {"first": "page"}, {"top": "n"}, hot_rows
    )
    assert rows(result, "s", "t", "name", "v", "first", "top") == brute_force(data)


def test_chunks_do_not_change_the_funnel(spark, rows):
    t = Tables(spark, "/root/testdata/sf0.001")
    plain = rows(session_funnel(web_events(t), EVENT_DAYS))
    assert rows(session_funnel(web_events(t), EVENT_DAYS, hot_rows=1)) == plain
    doubled = web_events(t).unionByName(web_events(t))
    assert rows(session_funnel(doubled, EVENT_DAYS)) == plain


def test_only_the_days_are_read(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    web_events(t).write.partitionBy("event_date").parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events")).withColumn("event_date", F.col("event_date").cast("string"))
    days = DayRange(EVENT_DAYS.first, EVENT_DAYS.first)
    plan = session_funnel(stored, days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "Python" not in plan
    assert session_funnel(stored, days).select("id_date").distinct().count() <= 2  # the zone shift crosses midnight


def test_closing_distinct_needs_no_shuffle(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    df = session_funnel(web_events(t), EVENT_DAYS)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    above_windows, below = plan.split("Window [", 1)
    assert "Exchange" not in above_windows
    assert below.index("Exchange hashpartitioning(_sid") < below.index("Exchange hashpartitioning(referral_code")


def test_hot_session_is_cut(spark):
    data = [(None, i, f"e{i}", None, None, 0) for i in range(1000)] + [("a", 1, "x", None, None, 0)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("at", F.timestamp_seconds("t"))
    result = session_columns(df, "s", "at", ["name"], {"v": "v"}, hot_rows=100, keep_layout=True)
    sizes = result.groupBy("_sid", "_no_sid", "_chunk").count()
    assert sizes.where("_no_sid").count() == 10
    assert sizes.agg(F.max("count")).first()[0] <= 110


@pytest.mark.parametrize("kind", ["outlier", "burst"])
def test_chunks_hold_equal_numbers_of_rows(spark, kind):
    times = [*range(1_000_000, 1_010_000)] if kind == "outlier" else [i if i < 1000 else 500 + i / 10_000 for i in range(10_000)]
    times += [0, 10**9]
    df = spark.createDataFrame([(None, float(t), "e") for t in times], "s string, t double, name string")
    df = df.withColumn("at", F.timestamp_seconds("t")).drop("t")
    result = session_columns(df, "s", "at", ["name"], {"n": "name"}, hot_rows=500, keep_layout=True)
    sizes = [r["count"] for r in result.groupBy("_chunk").count().collect()]
    assert sum(sizes) == len(times) and max(sizes) <= 1000


def test_no_forced_broadcast(spark):
    df = spark.createDataFrame([("a", 1, "e", None, None, 0)], SCHEMA).withColumn("at", F.timestamp_seconds("t"))
    text = session_columns(df, "s", "at", ["name"], {"v": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in text.lower()


def test_chunks_stay_small_however_many_they_are(spark):
    df = spark.range(1_000_000).select(
        F.lit(None).cast("string").alias("s"),
        F.timestamp_micros(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") * F.lit(10**9))).alias("at"),
        F.col("id").cast("string").alias("name"),
    )
    result = session_columns(df, "s", "at", ["name"], {"n": "name"}, hot_rows=100, keep_layout=True)
    sizes = result.groupBy("_chunk").count()
    assert sizes.agg(F.max("count"), F.count("*"), F.sum("count")).first()[0] <= 200
    assert sizes.count() >= 8000 and sizes.agg(F.sum("count")).first()[0] == 1_000_000


def test_running_values_over_many_chunks(spark):
    df = spark.range(20_000).select(
        F.lit("one").alias("s"),
        F.timestamp_seconds("id").alias("at"),
        F.col("id").cast("string").alias("name"),
        F.when(F.col("id") % 700 == 0, F.col("id")).alias("v"),
        (-F.col("id")).alias("n"),
    )
    result = session_columns(df, "s", "at", ["name"], {"last": "v"}, {"first": "name"}, {"top": "n"}, hot_rows=10)
    wrong = ~((F.col("last") == F.col("name").cast("long") - F.col("name").cast("long") % 700) & (F.col("first") == "0") & (F.col("top") == 0))
    assert result.count() == 20_000 and result.where(wrong).count() == 0
