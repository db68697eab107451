import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from funnelwright.functions.keys import joined
from funnelwright.operators.counts import measures_by_channel
from funnelwright.operators.joins import candidate_full_join, full_join_chain, keyed_join, not_in
from funnelwright.plans.conversion import with_search_cost


def parts(rng):
    return rng.choice([None, "", "a", "b", "ab"])


@pytest.mark.parametrize("seed", range(4))
def test_candidate_join_equals_or_join(spark, rows, seed):
    rng = random.Random(seed)
    left = [(rng.choice(["x", "y", None]), parts(rng), parts(rng), parts(rng), i % 7) for i in range(40)]
    right = [(rng.choice(["x", "y", None]), rng.choice([None, "", "ab", "aab", "ba"]), parts(rng), i) for i in range(40)]
    l = spark.createDataFrame(left, "k string, a string, b string, c string, n int")
    r = spark.createDataFrame(right, "rk string, h string, h1 string, m int")
    texts = [joined("a", "b", "c"), joined("a", "c", "b")]
    either = F.lit(False)
    for text, hash_ in itertools.product(texts, (F.col("h"), F.col("h1"))):
        either = either | (text == hash_)
    expected = rows(l.join(r, (F.col("k") == F.col("rk")) & either, "full"))
    assert rows(candidate_full_join(l, r, [("k", "rk")], texts, [F.col("h"), F.col("h1")])) == expected


def test_null_keys_match_nothing(spark, rows):
    l = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, v string")
    r = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert rows(not_in(l, r, ["k"])) == [(2, "c"), (None, "b"), (None, "b")]
    assert rows(keyed_join(l, r, ["k"], "left_semi"), "k", "v") == [(1, "a")]
    with pytest.raises(ValueError):
        keyed_join(l, r, ["k"], "full")


def test_null_keys_are_spread(spark):
    l = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    r = spark.range(100).select(F.when(F.col("id") > 5, F.col("id")).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = not_in(l, r, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert len(by) == 2 and all("k#" in b and "_spread#" in b for b in by)


def test_full_join_chain_takes_first_present_key(spark, rows):
    frames = [spark.createDataFrame([(k, 1)], f"k string, n{k} int") for k in "abc"]
    assert rows(full_join_chain(frames, ["k"])) == [("a", 1, None, None), ("b", None, 1, None), ("c", None, None, 1)]


def test_search_cost_matches_on_left_keys_only(spark, rows):
    l = spark.createDataFrame(
        [("d", "c", "1", 5), (None, None, None, 6), ("d", "c", None, 7)], "id_date string, channel string, campaign string, n int"
    )
    r = spark.createDataFrame([("d", "c", "1", 1.0), ("d", "c", "2", 2.0)], "id_date string, channel string, campaign_id string, cost double")
    keys = ((F.col("id_date") == F.col("g_id_date")) & (F.col("channel") == F.col("g_channel"))
            & (F.col("campaign") == F.col("g_campaign_id")))
    expected = l.join(r.select(*(F.col(c).alias(f"g_{c}") for c in r.columns)), keys, "full")
    assert rows(with_search_cost(l, r)) == rows(expected)


@pytest.mark.parametrize("seed", range(3))
def test_measures_equal_direct_join(spark, rows, seed):
    rng = random.Random(seed)
    fact = [
        (rng.choice(["d1", "d2"]), rng.choice(["h1", "h2", "h3", None]), rng.choice([None, "aff", "sell"]),
         rng.choice([None, "e1", "e2", "e3"]), rng.choice([None, 1.0, 2.0]))
        for _ in range(80)
    ]
    dim = [("h1", "paid"), ("h2", "social"), ("h2", "aff"), ("h2", "social"), ("h3", None)]
    f = spark.createDataFrame(fact, "d string, h string, override string, e string, x double")
    m = spark.createDataFrame(dim, "h string, channel string")
    f.createOrReplaceTempView("f")
    m.createOrReplaceTempView("m")
    expected = spark.sql(
        """SELECT d, f.h, CASE WHEN m.channel IN ('paid') THEN m.channel WHEN override IS NOT NULL THEN override
          ELSE m.channel END AS channel, count(DISTINCT e) AS n, sum(x) AS x
        FROM f LEFT JOIN m USING (h) GROUP BY ALL"""
    )
    actual = measures_by_channel(f, m, ["d"], "h", "e", ["aff", "sell"], ["paid"], "n", "x", "x")
    assert rows(actual, "d", "h", "channel", "n", "x") == rows(expected)


def test_candidate_join_reads_each_side_once(spark, tmp_path, rows):
    l = spark.createDataFrame([("x", "a", "b", "c", 1), ("x", "a", "b", "c", 1), ("y", None, None, None, 2)], "k string, a string, b string, c string, n int")
    r = spark.createDataFrame([("x", "abc", "abc", 5), ("x", "abc", "abc", 5), ("x", "acb", None, 6), ("z", None, None, 7)], "rk string, h string, h1 string, m int")
    for side, name in ((l, "l"), (r, "r")):
        side.write.parquet(str(tmp_path / name))
    l, r = (spark.read.parquet(str(tmp_path / name)) for name in "lr")
    texts = [joined("a", "b", "c"), joined("a", "c", "b")]
    found = candidate_full_join(l, r, [("k", "rk")], texts, [F.col("h"), F.col("h1")])
    assert len(found.collect()) == 2 * 3 + 1 + 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")]
    assert final.count("FileScan") == 2
