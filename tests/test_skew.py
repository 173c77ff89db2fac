"""Hot keys are split, and the split results equal plain windows and joins."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldtrail.operators import diff, skew
from fieldtrail.plans import marts
from tests.conftest import rows


@pytest.fixture
def low_limits(monkeypatch):
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 50)
    monkeypatch.setattr(skew, "HOT_MAX_KEYS", 1_000)


@pytest.fixture(scope="module")
def events(spark):
    r = random.Random(3)
    data = [("hot", r.randint(0, 400), i, r.choice("abc"), r.choice([None, 1.0, 2.5])) for i in range(3000)]
    data += [(f"k{r.randint(0, 300)}", r.randint(0, 400), i, r.choice("abc"), r.choice([None, 1.0])) for i in range(3000, 9000)]
    data += [(None, r.randint(0, 400), i, "a", 1.0) for i in range(9000, 9100)]
    return spark.createDataFrame(data, "k string, ts int, id int, v string, amount double").cache()


def test_hot_keys(events, low_limits):
    found = {r.k: r._parts for r in skew.hot_keys(events, ["k"]).collect()}
    assert "hot" in found and found["hot"] > 10
    assert skew.hot_keys_if_any(events.where("k <> 'hot'"), ["k"], 1000) is None


def test_chunks_spread_a_hot_key(events, low_limits):
    cuts = skew._cut_points(events, ["k"], "ts", skew.hot_keys_if_any(events, ["k"]))
    sizes = skew._with_chunk(events, ["k"], "ts", cuts).where("k = 'hot'").groupBy("_chunk").count().collect()
    assert len(sizes) > 10
    assert max(r["count"] for r in sizes) < 300


def test_neighbours_equal_plain_windows(events, low_limits):
    got = skew.ordered_neighbours(
        events, ["k"], ["ts", "id"], previous=["v", "amount"], following=["id"], running_sum={"total": "amount"}
    ).select("k", "id", "_seq", "_prev.v", "_prev.amount", F.col("_prev").isNull(), "_next.id", "total")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = events.select(
        "k", "id", F.row_number().over(w).cast("long"), F.lag("v").over(w), F.lag("amount").over(w),
        F.lag("id").over(w).isNull(), F.lead("id").over(w),
        F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)),
    )
    assert rows(got) == rows(want)


def test_change_log_and_marts_do_not_depend_on_the_split(spark, events, monkeypatch):
    def results():
        log = diff.change_log(events.where("k IS NOT NULL"), "k", ["ts", "id"], {"status": "v"})
        changes = log.select(
            "page_id", "field", "old_value", "new_value", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("ts"))).alias("valid_from"), "id"
        )
        order = ("valid_from", "id")
        history = marts.status_history(changes, order=order)
        return [
            rows(log), rows(history), rows(marts.open_volume_daily(changes, ["a"], order=order)),
            rows(marts.open_volume_touched(history, ["a"], F.lit("2024-01-20").cast("date"))),
            rows(marts.dim_scd2(events, "k", ["ts", "id"], ["v", "amount"])),
        ]

    plain = results()
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 50)
    assert results() == plain


def test_salted_join_equals_join(spark, events, low_limits):
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, x int")
    for how in ("left", "inner"):
        assert rows(skew.salted_join(events, one, ["k"], ["id"], how).select("k", "id", "x")) == rows(
            events.join(one, "k", how).select("k", "id", "x")
        )


def test_lookup_join_beyond_the_broadcast_bound(spark, events, low_limits):
    one = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, x int")
    small = skew.lookup_join(events, one, ["k"], ["id"])
    large = skew.lookup_join(events, one, ["k"], ["id"], max_rows=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small.select("k", "id", "x")) == rows(large.select("k", "id", "x"))


def test_latest_per_key_is_deterministic_on_ties(spark):
    data = [("a", 1, "x"), ("a", 1, "z"), ("a", 0, "zz"), ("b", None, "q")]
    df = spark.createDataFrame(data, "k string, ts int, v string")
    assert rows(skew.latest_per_key(df, ["k"], ["ts"])) == [("a", 1, "z"), ("b", None, "q")]
    assert skew.latest_per_key(df, ["k"], ["ts"]).columns == df.columns


def test_null_keys_are_spread_in_joins(spark, monkeypatch):
    from fieldtrail.operators import skew as m

    many = spark.range(4000).select(F.when(F.col("id") < 400, F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    one = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "k long, name string")
    plain = sorted(map(tuple, many.join(one, "k", "left").select("k", "v", "name").collect()), key=str)
    for floor in (m.HOT_MIN_ROWS, 10):
        monkeypatch.setattr(m, "HOT_MIN_ROWS", floor)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            joined = m.salted_join(many, one, ["k"], ["v"])
            sizes = [r["count"] for r in joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
            got = sorted(map(tuple, joined.select("k", "v", "name").collect()), key=str)
            inner = m.salted_join(many, one, ["k"], ["v"], "inner").count()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert got == plain and inner == 400
        assert max(sizes) < 1000


def test_a_hot_null_key_is_split_in_windows(spark):
    from fieldtrail.operators import skew as m

    df = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"), F.col("id").alias("t"), (F.col("id") * 7 % 11).alias("v"))
    args = dict(keys=["k"], order=["t"], previous=["v"], following=["t"], running_sum={"s": "v"})
    plain = m.ordered_neighbours(df, hot=None, **args)
    hot = m.hot_keys_if_any(df, ["k"], 50)
    assert hot.where("k IS NULL").count() == 1
    for limit in (1 << 30, 0):
        m.EDGE_BYTES, kept = limit, m.EDGE_BYTES
        try:
            split = m.ordered_neighbours(df, hot=hot, **args)
            assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
        finally:
            m.EDGE_BYTES = kept
