"""Marts kept up run by run, states at many moments, and their hot pages."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldtrail.operators import skew, upsert
from fieldtrail.plans import marts

START = dt.datetime(2024, 1, 1)
ORDER = ("at", "id")


def log(n=3000, seed=1):
    """Records of a hot page and some others, by time; two fields."""
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "a", "b", "c"]), rng.choice(["status", "tier"]), rng.choice(["x", "y", "z", None]),
         START + dt.timedelta(minutes=7 * (i // 2)), i)
        for i in range(n)
    ]


KINDS = "page_id string, field string, new_value string, at timestamp_ntz, id long"


@pytest.mark.parametrize("split", [False, True])
def test_states_at(spark, monkeypatch, split):
    if split:
        monkeypatch.setattr(skew, "HOT_MIN_ROWS", 50)
    rows, rng = log(), random.Random(2)
    asked = [(rng.choice(["hot", "a", "none"]), START + dt.timedelta(minutes=rng.randint(-9, 11_000))) for _ in range(400)]
    asked += [("hot", None), asked[0], asked[0], ("a", rows[500][3]), (None, START)]
    moments = spark.createDataFrame(asked, "page_id string, moment timestamp_ntz")
    got = marts.states_at(spark.createDataFrame(rows, KINDS), moments, ["status", "tier"], ORDER)

    def value(page, moment, field):
        known = [r for r in rows if r[0] == page and r[1] == field and moment is not None and r[3] <= moment]
        return known[-1][2] if known else None

    want = [(p, m, value(p, m, "status"), value(p, m, "tier")) for p, m in asked]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_states_at_takes_one_shuffle(spark):
    moments = spark.createDataFrame([("a", START)], "page_id string, moment timestamp_ntz")
    got = marts.states_at(spark.createDataFrame(log(10), KINDS), moments, ["status"], ORDER, hot=None)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("split", [False, True])
def test_history_and_open_volume_run_by_run(spark, monkeypatch, split):
    if split:
        monkeypatch.setattr(skew, "HOT_MIN_ROWS", 50)
    rows = [r for r in log(1200, 3) if r[1] == "status"]
    records = spark.createDataFrame(rows, KINDS).withColumn("status", F.col("new_value"))
    whole = spark.createDataFrame(rows, KINDS)
    want = marts.status_history(whole, order=ORDER)
    still = spark.createDataFrame([], want.schema)
    moves, closed, size = spark.createDataFrame([], "day date, delta long"), [], len(rows) // 3 + 1
    for a in range(0, len(rows), size):
        new = records.where(F.col("id").between(rows[a][4], rows[min(a + size, len(rows)) - 1][4]))
        assert marts.late_pages(still, new, ORDER).count() == 0
        advanced = marts.advance_history(still, new, ORDER)
        moves = spark.createDataFrame(marts.advance_open_volume(moves, still, new, ["x", "y"], ORDER).collect(), moves.schema)
        closed += advanced.where("valid_to IS NOT NULL").collect()
        still = spark.createDataFrame(marts.still_open(still, advanced).collect(), want.schema)
    assert sorted(map(tuple, closed + still.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    daily = marts.open_volume_daily(whole, ["x", "y"], order=ORDER)
    assert sorted(marts.open_volume(moves).collect()) == sorted(daily.collect())
    early = spark.createDataFrame([("a", "x", START - dt.timedelta(1), 1)], "page_id string, status string, at timestamp_ntz, id long")
    assert [r[0] for r in marts.late_pages(still, early, ORDER).collect()] == ["a"]


def test_days_by_period_of_a_long_interval(spark):
    rows = [("p", "open", dt.datetime(2014, 2, 27, 23), dt.datetime(2024, 3, 2, 1)), ("p", "done", dt.datetime(2024, 3, 2, 1), None),
            ("q", "open", dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 23)), ("r", "open", dt.datetime(2030, 1, 1), None)]
    history = spark.createDataFrame(rows, "page_id string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    as_of = F.lit("2024-03-05 12:00:00").cast("timestamp_ntz")
    got = marts.active_days_by_period(history, F.col("status"), as_of).collect()
    by = {(r["page_id"], r["bucket"], r["period"].isoformat()): r["active_days"] for r in got}
    assert len(by) == len(got) == 123
    assert by["p", "open", "2014-02-01"] == 2 and by["p", "open", "2016-02-01"] == 29
    assert by["p", "open", "2024-03-01"] == 1 and by["p", "done", "2024-03-01"] == 3
    assert sum(n for (p, b, _), n in by.items() if (p, b) == ("p", "open")) == (dt.date(2024, 3, 2) - dt.date(2014, 2, 27)).days


def test_adherence_shows_what_was_never_done(spark):
    definitions = spark.createDataFrame(
        [("never", 2, "2024-01-20"), ("once", 1, "2024-02-01"), ("later", 1, "2024-06-01"), ("idle", 0, None)],
        "page_id string, expected int, created string",
    )
    done = spark.createDataFrame([("once", dt.date(2024, 3, 1), 1), ("gone", dt.date(2024, 3, 1), 1)], "definition_id string, period date, completions long")
    got = marts.recurring_adherence(done, definitions, "expected", "created", F.lit("2024-04-10")).collect()
    found = {(r["definition_id"], r["period"].month): (r["completions"], r["adherence"]) for r in got}
    assert found == {
        **{("never", m): (0, 0.0) for m in (1, 2, 3, 4)}, ("once", 2): (0, 0.0), ("once", 3): (1, 1.0), ("once", 4): (0, 0.0), ("idle", 4): (0, None),
    }


def test_comments_compare_moments_not_text(spark):
    kinds = "comment_id string, last_edited_time string, text string"
    batch = spark.createDataFrame(
        [("c", "2024-01-01T12:00:00+05:00", "older"), ("c", "2024-01-01T08:00:00Z", "newer"), ("d", "no date", "only")], kinds
    )
    got = upsert.upsert_comments(spark.createDataFrame([], kinds), batch).collect()
    assert sorted(r["text"] for r in got) == ["newer", "only"]
