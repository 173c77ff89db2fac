import pytest
from pyspark.sql import functions as F

from fieldtrail.operators import diff
from tests.conftest import rows

BASE = dict(page_id="p1", created_time="2026-01-01T00:00:00Z", last_edited_time="2026-01-01T00:00:00Z", url="u", status="Open")
NOW = "2026-07-01T00:00:00+00:00"


def frame(spark, *pages, schema=None):
    cols = list(pages[0])
    kinds = schema or {}
    return spark.createDataFrame([tuple(p[c] for c in cols) for p in pages], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in cols))


def detect(spark, new, old=None, change_fields=(), exclude=(), new_types=None, old_types=None, **kw):
    batch = frame(spark, new, schema=new_types)
    prev = frame(spark, old, schema=old_types) if old else batch.limit(0)
    return {r.field: r for r in diff.detect_changes(batch, prev, NOW, change_fields, exclude, **kw).collect()}


def test_first_sight_records_every_tracked_field(spark):
    got = detect(spark, {**BASE, "content_text": "long", "note": None})
    assert set(got) == {"page_id", "created_time", "status", "note"}
    assert all(r.old_value is None and r.valid_from == BASE["created_time"] and r.detected_at == NOW for r in got.values())
    assert got["status"].new_value == "Open" and got["note"].new_value is None
    assert len({r.id for r in got.values()}) == 4


def test_without_created_time_a_first_sight_is_valid_from_the_run(spark):
    got = detect(spark, {"page_id": "p1", "status": "Open"})
    assert {r.valid_from for r in got.values()} == {NOW}


@pytest.mark.parametrize("small", [False, True])
def test_only_differences_afterwards(spark, small):
    assert detect(spark, BASE, BASE, batch_is_small=small) == {}
    got = detect(spark, {**BASE, "status": "Done", "url": "v", "last_edited_time": "x"}, BASE, batch_is_small=small)
    assert set(got) == {"status"}
    r = got["status"]
    assert (r.old_value, r.new_value, r.valid_from) == ("Open", "Done", NOW)


def test_allow_and_deny_lists_both_apply(spark):
    done = {**BASE, "status": "Done"}
    assert detect(spark, done, BASE, change_fields=["page_id"]) == {}
    assert detect(spark, done, BASE, exclude=["status"]) == {}
    assert detect(spark, done, BASE, change_fields=["status"], exclude=["status"]) == {}
    assert set(detect(spark, done, BASE, change_fields=["status"])) == {"status"}


@pytest.mark.parametrize("stored,value,changed", [("1", True, False), ("0", False, False), ("True", True, True)])
def test_flags_equal_their_stored_text(spark, stored, value, changed):
    got = detect(spark, {**BASE, "done": value}, {**BASE, "done": stored}, new_types={"done": "boolean"})
    assert ("done" in got) is changed


def test_a_value_where_there_was_none(spark):
    got = detect(spark, {**BASE, "due_date_start": "2026-06-01"}, {**BASE, "due_date_start": None})
    assert set(got) == {"due_date_start"}


def test_a_new_column_had_no_value(spark):
    got = detect(spark, {**BASE, "effort": "high"}, BASE)
    assert (got["effort"].old_value, got["effort"].new_value) == (None, "high")


def test_option_ids_travel_with_the_change_and_are_not_tracked(spark):
    old, new = {**BASE, "status_id": "abc"}, {**BASE, "status": "Done", "status_id": "def"}
    got = detect(spark, new, old)
    assert set(got) == {"status"}
    assert (got["status"].old_value_id, got["status"].new_value_id) == ("abc", "def")
    first = detect(spark, new)
    assert "status_id" not in first and (first["status"].old_value_id, first["status"].new_value_id) == (None, "def")


def test_a_property_named_page_does_not_hide_the_key(spark):
    assert diff.tracked_fields(["page_id", "page", "page_ref_id", "url"]) == ["page_id", "page", "page_ref_id"]
    got = detect(spark, {**BASE, "page": "x"})
    assert "page_id" in got and got["page"].new_value_id is None


def test_numbers_keep_their_text(spark):
    got = detect(
        spark, {**BASE, "n": 1e16, "m": 4.0}, {**BASE, "n": 0.1, "m": 4}, new_types={"n": "double", "m": "double"}, old_types={"n": "double", "m": "bigint"}
    )
    assert set(got) == {"n"}
    assert (got["n"].old_value, got["n"].new_value) == ("0.1", "1e+16")


def test_one_join_and_no_shuffle_beyond_it(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = diff.detect_changes(frame(spark, {**BASE, "a": "1"}), frame(spark, {**BASE, "a": "2"}), NOW)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Generate") == 1
    assert "Python" not in plan


def test_a_small_batch_leaves_the_snapshot_unshuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = diff.detect_changes(frame(spark, BASE), frame(spark, BASE), NOW, batch_is_small=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [page_id" in plan and "LeftSemi" in plan


def test_change_log_equals_repeated_comparison(spark):
    versions = spark.createDataFrame(
        [("a", 1, "x", 1.0), ("a", 2, "x", 1.0), ("a", 3, None, 2.0), ("a", 4, None, 2.0), ("b", 1, None, None)], "k string, t int, s string, n double"
    )
    log = diff.change_log(versions, "k", ["t"], {"s": "s", "n": "n"})
    assert rows(log) == [
        ("a", 1, True, "n", None, "1.0"), ("a", 1, True, "s", None, "x"), ("a", 3, False, "n", "1.0", "2.0"),
        ("a", 3, False, "s", "x", None), ("b", 1, True, "n", None, None), ("b", 1, True, "s", None, None),
    ]


def test_replaying_the_records_rebuilds_the_pages(spark):
    old = frame(spark, {**BASE, "a": "1"}, {**BASE, "page_id": "p2", "a": None})
    new = frame(spark, {**BASE, "a": None}, {**BASE, "page_id": "p2", "a": "2"}, {**BASE, "page_id": "p3", "a": "3"})
    first = diff.detect_changes(old, old.limit(0), "2026-05-01")
    second = diff.detect_changes(new, old, "2026-06-01")
    log = first.unionByName(second)
    state = log.groupBy("page_id").pivot("field", ["status", "a"]).agg(F.max_by("new_value", "detected_at"))
    assert rows(state) == rows(new.select("page_id", "status", "a"))
