"""Blocked scans against plain Python, for several block sizes."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import ordered as o


def _data(seed=3, n=120):
    rng = random.Random(seed)
    out = []
    for key in ("a", "b", "c"):
        at = 0
        for _ in range(rng.randrange(1, n)):
            at += rng.randrange(1, 3)  # gaps in the order column
            out.append((key, at, rng.choice([None, rng.randrange(9)])))
    return out


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_scans(spark, size):
    data = _data()
    df = spark.createDataFrame(data, "k string, i long, v int")
    v = F.col("v")
    got = o.over_blocks(
        df,
        ["k"],
        "i",
        {
            "last": o.last_seen(v),
            "before": o.last_seen(v, inclusive=False),
            "next": o.next_seen(v),
            "prev": o.previous(v),
            "foll": o.following(v),
            "sum": o.running_total(v),
            "sum0": o.running_total(v, inclusive=False),
            "lo": o.whole_min(v),
            "hi": o.whole_max(v),
            "all": o.whole_sum(v),
            "first": o.whole_first(v, "i"),
            "final": o.whole_last(v, "i"),
        },
        rows_per_block=size,
    )
    got = {(r["k"], r["i"]): r for r in got.collect()}
    assert len(got) == len(data)
    for key in "abc":
        rows = sorted((i, v) for k, i, v in data if k == key)
        known = [v for _, v in rows if v is not None]
        for at, (i, v) in enumerate(rows):
            past = [x for _, x in rows[: at + 1] if x is not None]
            strict = [x for _, x in rows[:at] if x is not None]
            ahead = [x for _, x in rows[at:] if x is not None]
            r = got[(key, i)]
            assert r["last"] == (past[-1] if past else None)
            assert r["before"] == (strict[-1] if strict else None)
            assert r["next"] == (ahead[0] if ahead else None)
            assert r["prev"] == (rows[at - 1][1] if at else None)
            assert r["foll"] == (rows[at + 1][1] if at + 1 < len(rows) else None)
            assert (r["sum"], r["sum0"]) == (sum(past), sum(strict))
            assert (r["lo"], r["hi"]) == (min(known), max(known))
            assert (r["all"], r["first"], r["final"]) == (sum(known), known[0], known[-1])


def test_no_window_over_a_whole_key(spark):
    """Windows over rows are partitioned by block; only summaries are scanned per key."""
    df = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("i"))
    out = o.over_blocks(df, ["k"], "i", {"n": o.running_total(F.lit(1))}, rows_per_block=100)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("__block" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows) == 2
    assert out.filter("n != i + 1").count() == 0


def test_chained_scans_share_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([("k", i, i % 3) for i in range(50)], "k string, i long, v int")
        blocked = o.with_blocks(df, "i")
        one = o.over_blocks(blocked, ["k"], "i", {"a": o.last_seen(F.col("v"))})
        two = o.over_blocks(one, ["k"], "i", {"b": o.running_total(F.col("a"))})
        plan = two._jdf.queryExecution().executedPlan().toString()
        main = plan.splitlines()
        # The branch of the rows themselves, down the left side, has one exchange.
        left = [line for line in main if "Exchange hashpartitioning(k" in line and "i#" not in line.split("Exchange")[0]]
        assert "Window" in plan and left
        assert o.no_blocks(two).columns == ["k", "i", "v", "a", "b"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_join_facts_splits_a_hot_key(spark):
    df = o.with_blocks(spark.createDataFrame([("k", i) for i in range(40)], "k string, i long"), "i")
    facts = spark.createDataFrame([("k", "fact"), ("z", "none")], "k string, f string")
    out = o.join_facts(df, facts, ["k"])
    assert out.count() == 40 and out.select("f").distinct().collect()[0][0] == "fact"
