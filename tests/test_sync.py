import json
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldtrail.operators import quality
from fieldtrail.plans import staging, sync
from fieldtrail.sources import pages as page_source
from fieldtrail.sources import sinks
from fieldtrail.sources import tables as tables_module
from fieldtrail.sources.tables import Tables
from fieldtrail.streaming import changes as stream
from tests.conftest import rows


def Store(spark, path):  # noqa: N802
    """The tables of a database of its own per folder."""
    return Tables(spark, re.sub(r"\W", "_", path), path)


def doc(**types):
    return json.dumps({"properties": {n: {"id": f"id_{n}", "type": t, t: {}} for n, t in types.items()}})


def page(pid, edited, **props):
    return json.dumps({"id": pid, "created_time": "2026-01-01T00:00:00.000Z", "last_edited_time": edited, "url": "u", "properties": props})


def select(name):
    return {"select": {"id": f"o_{name}", "name": name}}


def landed(spark, schema, *lines, **more):
    return sync.Landed(schema, spark.createDataFrame([(x,) for x in lines], "raw string"), **more)


def log_of(store, since=""):
    return rows(store.read("t_changes").where(F.col("detected_at") > since).select("page_id", "field", "old_value", "new_value"))


RUNS = ["2026-02-01T00:00:00+00:00", "2026-02-02T00:00:00+00:00", "2026-02-03T00:00:00+00:00", "2026-02-04T00:00:00+00:00"]


def test_a_database_over_four_runs(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    cfg = sync.DatabaseConfig("t", exclude_change_fields=["Created"], change_fields=["Status", "Due", "Points"])
    schema = doc(Status="select", Due="date", Points="number")
    block = spark.createDataFrame([("a", 0, json.dumps({"type": "paragraph", "paragraph": {"rich_text": [{"plain_text": "hi"}]}}))], "page_id string, position int, raw string")
    comments = spark.createDataFrame([(json.dumps({"page_id": "a", "results": [{"id": "c", "last_edited_time": "1", "rich_text": [{"plain_text": "x"}]}]}),)], "raw string")

    first = sync.sync_database(
        store, cfg,
        landed(spark, schema, page("a", "2026-01-31T20:00:00Z", Status=select("Open"), Points={"number": 1}), page("b", "2026-01-31T09:00:00Z", Status=select("Open")), blocks=block, comments=comments),
        RUNS[0],
    )
    assert (first.version, first.pages, first.changes, first.comments) == (1, 2, 8, 1)
    assert {r.page_id: r.content_text for r in store.read("t_pages").collect()} == {"a": "hi", "b": None}
    assert rows(store.read("t_comments").select("comment_id", "page_id", "text")) == [("c", "a", "x")]

    # Edited within the minute before the last run, edited before, delivered twice, unchanged.
    second = sync.sync_database(
        store, cfg,
        landed(
            spark, schema, page("a", "2026-01-31T23:59:30Z", Status=select("Done"), Points={"number": 1}), page("b", "2026-01-31T12:00:00Z", Status=select("Lost")),
            page("c", RUNS[1], Status=select("Open")), page("c", "2026-02-01T10:00:00Z", Status=select("Draft")),
        ),
        RUNS[1],
    )
    assert (second.pages, second.changes) == (2, 5)
    assert [r for r in log_of(store, RUNS[0]) if r[1] == "status"] == [("a", "status", "Open", "Done"), ("c", "status", None, "Open")]
    assert store.meta("last_sync:t") == RUNS[1]

    # The same delivery again changes nothing; a rename and a new type are followed.
    renamed = json.dumps({"properties": {"State": {"id": "id_Status", "type": "select", "select": {"options": [{"id": "o_Done", "name": "Finished"}]}}, "Due": {"id": "id_Due", "type": "date"}, "Points": {"id": "id_Points", "type": "rich_text"}}})
    cfg = sync.DatabaseConfig("t", change_fields=["State", "Due", "Points"])
    third = sync.sync_database(store, cfg, landed(spark, renamed, page("a", RUNS[2], State={"select": {"id": "o_Done", "name": "Finished"}}, Points={"rich_text": [{"plain_text": "one"}]})), RUNS[2])
    pages = store.read("t_pages")
    assert "state" in pages.columns and "status" not in pages.columns and "points_bak_20260203" in pages.columns
    assert third.backfilled == 1 and any("renamed" in m for m in third.messages)
    # The stored page still held the old name, so the rename itself is a record with equal ids.
    assert [r for r in log_of(store) if r[0] == "a" and r[1] == "state"] == [
        ("a", "state", "Done", "Finished"), ("a", "state", None, "Open"), ("a", "state", "Open", "Finished"),
    ]
    assert {r.field for r in store.read("t_changes").collect()} == {"state", "due_start", "due_end", "points"}
    assert rows(store.read("_backups").select("column_name", "type", "backup_column")) == [("points", "number", "points_bak_20260203")]

    # Back to the old type: the old numbers return.
    back = json.dumps({"properties": {"State": {"id": "id_Status", "type": "select"}, "Due": {"id": "id_Due", "type": "date"}, "Points": {"id": "id_Points", "type": "number"}}})
    sync.sync_database(store, cfg, landed(spark, back, page("b", RUNS[3], State=select("Open"), Points={"number": 7})), RUNS[3])
    assert {r.page_id: r.points for r in store.read("t_pages").collect()} == {"a": 1.0, "b": 7.0, "c": None}
    assert store.read("_backups").count() == 0
    assert {r.property_id: r.first_seen for r in store.read("_schema").collect()} == {f"id_{n}": RUNS[0] for n in ("Status", "Due", "Points")}


def test_running_a_batch_twice_changes_nothing(spark, tmp_path):
    store, cfg = Store(spark, str(tmp_path)), sync.DatabaseConfig("t")
    batch = landed(spark, doc(Status="select"), page("a", RUNS[0], Status=select("Open")))
    sync.sync_database(store, cfg, batch, RUNS[0])
    before = rows(store.read("t_pages"))
    assert sync.sync_database(store, cfg, batch, RUNS[1], full=True).changes == 0
    assert rows(store.read("t_pages")) == before


def test_one_failing_database_leaves_the_others(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    good = landed(spark, doc(Status="select"), page("a", RUNS[0], Status=select("Open")))
    bad = sync.Landed("{broken", good.pages)
    out = sync.sync_all(store, {"x": (sync.DatabaseConfig("x"), bad), "t": (sync.DatabaseConfig("t", track_changes=False), good)}, RUNS[0])
    assert isinstance(out["x"], Exception) and out["t"].pages == 1
    assert store.meta("last_sync:x") is None and store.meta("last_sync:t") == RUNS[0]
    assert not store.exists("t_changes")


def test_a_publish_is_seen_whole_or_not_at_all(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.read("t_pages").count() == 0 and store.tables() == []
    with pytest.raises(KeyError):
        store.read("unknown")
    one = spark.createDataFrame([("a",)], "page_id string")
    store.publish(replace={"t_pages": one}, append={"log": one})
    store.publish(append={"log": one.select("page_id", F.lit(1).alias("n"))}, meta={"k": "v"})
    broken = one.select(F.raise_error(F.lit("lost")).cast("string").alias("page_id"))
    with pytest.raises(Exception):
        store.publish(replace={"t_pages": one.limit(0), "u_pages": broken}, meta={"k": "w"})
    again = Store(spark, str(tmp_path))
    assert again.tables() == ["log", "t_pages"] and again.meta("k") == "v"
    assert rows(again.read("log")) == [("a", 1), ("a", None)] and again.read("t_pages").count() == 1
    assert rows(again.pages_by_id("t", spark.createDataFrame([("a",), ("z",)], "page_id string"))) == [("a",), ("z",)]
    assert rows(again.page_ids("t")) == [("a",)]
    assert again.register_views() == ["log", "t_pages"] and spark.sql("SELECT count(*) FROM log").first()[0] == 2


def test_csv_bytes(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 'say "hi", ok', None), ("b", 1e16, "two\nlines", " pad ")], "page_id string, n double, t string, u string")
    assert sinks.write_csv(df, str(tmp_path / "x.csv"), single_file=True)
    [part] = (tmp_path / "x.csv").glob("part-*")
    assert part.read_bytes() == b'page_id,n,t,u\r\na,1.5,"say ""hi"", ok",\r\nb,1e+16,"two\nlines", pad \r\n'
    assert not sinks.write_csv(df.limit(0), str(tmp_path / "y.csv")) and not (tmp_path / "y.csv").exists()
    assert sinks.write_csv(df.repartition(2, "page_id"), str(tmp_path / "z.csv"))


def test_exports_and_gate(spark, tmp_path):
    ok = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    broken = ok.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    assert sinks.export_parquet({"bad": broken, "ok": ok}, str(tmp_path / "out")) == {"bad": False, "ok": True}
    checks = quality.check_model("m", ok, {"k": ("not_null", "unique")})
    assert rows(checks) == [("m", "k", "not_null", 1), ("m", "k", "unique", 1)]
    several = spark.range(4).select("id", (F.col("id") % 2).alias("half"), F.when(F.col("id") > 2, F.col("id")).alias("few")).repartition(2)
    several.write.parquet(str(tmp_path / "several"))
    both = quality.check_model("s", spark.read.parquet(str(tmp_path / "several")), {"id": ("unique",), "half": ("unique",), "few": ("not_null", "unique")})
    assert rows(both.select("column", "test", "failures")) == [("few", "not_null", 3), ("few", "unique", 0), ("half", "unique", 2), ("id", "unique", 0)]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(sinks.QualityError, match="m.k not_null: 1"):
        sinks.publish_marts(store, {"ok": ok}, [checks])
    assert store.tables() == []
    sinks.publish_marts(store, {"ok": ok, "old": ok})
    sinks.publish_marts(store, {"ok": ok})
    assert store.tables() == ["ok"]
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_test")
    assert sinks.mart_tables(spark, "marts_test") == []


def test_staging_needs_its_columns(spark):
    with pytest.raises(ValueError, match="last_edited_time"):
        staging.stg_pursuits(spark.createDataFrame([("x",)], "created_time string"))


def test_a_replayed_stream_batch_is_taken_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    write = stream.batch_writer(store, "t", lambda batch, number: f"run-{number}")
    batch = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y")], "page_id string, last_edited_time string, status string")
    write(batch, 0)
    count = store.read("t_changes").count()
    write(batch, 0)
    assert store.read("t_changes").count() == count == 2
    write(batch.replace("y", "z"), 1)
    assert [tuple(r) for r in store.read("t_changes").where("detected_at = 'run-1'").select("old_value", "new_value").collect()] == [("y", "z")]


def test_an_incremental_run_rewrites_only_its_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 10)
    store, cfg = Store(spark, str(tmp_path)), sync.DatabaseConfig("t")
    schema = doc(Status="select")
    everything = [page(f"p{i}", RUNS[0], Status=select("Open")) for i in range(60)]

    def comments(ids, text):
        docs = [json.dumps({"page_id": i, "results": [{"id": f"c-{i}", "last_edited_time": text, "rich_text": [{"plain_text": text}]}]}) for i in ids]
        return spark.createDataFrame([(d,) for d in docs], "raw string")

    said = comments([f"p{i}" for i in range(60)], "1")
    sync.sync_database(store, cfg, landed(spark, schema, *everything, comments=said), RUNS[0])
    sync.sync_database(store, cfg, landed(spark, schema, *everything, comments=said), RUNS[1], full=True)
    assert store.buckets("t_pages") == store.buckets("t_comments") == 6
    before = set(store.parts("t_pages"))
    out = sync.sync_database(
        store, cfg, landed(spark, schema, page("p7", RUNS[2], Status=select("Done"), Extra={}), comments=comments(["p7", "p8"], "2")), RUNS[2]
    )
    texts = {r.comment_id: r.text for r in store.read("t_comments").collect()}
    assert len(texts) == 60 and texts["c-p7"] == "2" and texts["c-p8"] == "1" and out.comments == 1
    after = set(store.parts("t_pages"))
    assert out.changes == 1 and len(before - after) == 1 and len(after - before) == 1
    got = {r.page_id: r.status for r in store.read("t_pages").collect()}
    assert len(got) == 60 and got["p7"] == "Done" and got["p8"] == "Open"
    # A new column reaches the touched bucket only; a rename reshapes the whole table.
    wider = json.dumps({"properties": {"State": {"id": "id_Status", "type": "select"}, "Size": {"id": "s", "type": "number"}}})
    sync.sync_database(store, cfg, landed(spark, wider, page("p9", RUNS[3], State=select("Done"), Size={"number": 2})), RUNS[3])
    got = {r.page_id: (r.state, r["size"]) for r in store.read("t_pages").collect()}
    assert got["p9"] == ("Done", 2.0) and got["p7"] == ("Done", None) and len(got) == 60
    assert store.read("t_changes").where("field = 'status'").count() == 0


def test_an_empty_first_run_leaves_a_usable_database(spark, tmp_path):
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    assert sync.sync_database(store, cfg, landed(spark, schema), RUNS[0]).pages == 0
    again = Store(spark, str(tmp_path))
    assert again.read("t_changes").count() == again.read("t_pages").count() == 0
    assert sync.sync_database(again, cfg, landed(spark, schema, page("a", RUNS[1], Status=select("Open"))), RUNS[1]).changes > 0
    parts = again.parts("t_changes")
    sync.sync_database(again, cfg, landed(spark, schema), RUNS[2])
    assert again.parts("t_changes") == parts  # a run without changes adds none
    assert rows(Store(spark, str(tmp_path)).read("t_pages").select("page_id", "status")) == [("a", "Open")]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    data = spark.range(3).withColumnRenamed("id", "n")
    assert one.tables() == two.tables() == []
    one.publish(replace={"x": data})
    with pytest.raises(tables_module.ConflictError):
        two.publish(replace={"x": data})
    assert Store(spark, str(tmp_path)).read("x").count() == 3
    two.refresh()
    assert two.publish(append={"x": data}) == 2 and two.read("x").count() == 6


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 10)
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    seen = []
    for i, run in enumerate(RUNS):
        lines = [page(f"p{i}-{n}", run, Status=select("Open")) for n in range(30 * (i + 1))]
        sync.sync_database(store, cfg, landed(spark, schema, *lines), run)
        seen.append(store.buckets("t_pages"))
    assert seen[-1] >= 9 and store.read("t_pages").count() == 300 == store.read("t_pages").select("page_id").distinct().count()


def test_small_parts_are_joined_and_tables_no_longer_named_dropped(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(append={"x": spark.range(5).select(F.col("id").cast("int").alias("n"), F.lit("d9").alias("day"))}, partition_by={"x": ["day"]})
    large = store.parts("x")
    for i in range(4):
        store.publish(append={"x": spark.createDataFrame([(i, f"d{i % 2}")], "n int, day string")})
    before = rows(store.read("x"))
    assert len(store.parts("x")) == 5 and store.compact("x", below_rows=3) == 4
    assert len(store.parts("x")) == 2 and set(large) < set(store.parts("x")) and store.compact("x", below_rows=3) == 0
    assert rows(Store(spark, str(tmp_path)).read("x")) == before and len(before) == 9
    assert store.vacuum() == []
    store.publish(replace={"x": spark.range(3)})
    assert len(store.vacuum()) == 1 and store.read("x").count() == 3


def test_a_failed_run_leaves_readers_and_the_next_run_on_the_old_state(spark, tmp_path, monkeypatch):
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    sync.sync_database(store, cfg, landed(spark, schema, page("a", RUNS[0], Status=select("Open"))), RUNS[0])
    before = {n: rows(store.read(n)) for n in store.tables()}
    second = landed(spark, schema, page("a", RUNS[1], Status=select("Done")), page("b", RUNS[1], Status=select("New")))
    with monkeypatch.context() as m:  # everything is written but the run's own rows

        def lost(*_):
            raise OSError("lost")

        m.setattr(Tables, "_finish", lost)
        with pytest.raises(OSError):
            sync.sync_database(store, cfg, second, RUNS[1])
    again = Store(spark, str(tmp_path))
    assert {n: rows(again.read(n)) for n in again.tables()} == before and again.meta("last_sync:t") == RUNS[0]
    assert sync.sync_database(again, cfg, second, RUNS[1]).pages == 2
    assert [r for r in log_of(again, RUNS[0]) if r[1] == "status"] == [("a", "status", "Open", "Done"), ("b", "status", None, "New")]
    assert rows(again.read("t_pages").select("page_id", "status")) == [("a", "Done"), ("b", "New")]


def test_reading_some_buckets_prunes_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 10)
    store, key = Store(spark, str(tmp_path)), {"x_pages": "page_id"}
    data = spark.range(60).select(F.col("id").cast("string").alias("page_id"))
    for _ in range(2):
        store.publish(replace={"x_pages": data}, bucket_by=key)
    some = store.read_buckets("x_pages", [0, 3])
    plan = some._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(some.inputFiles()) == 2 and 0 < some.count() < 60


def test_a_typed_landing_is_pruned_by_day_and_edit_time(spark, tmp_path):
    landing = str(tmp_path / "landing")
    store, cfg, schema = Store(spark, str(tmp_path / "db")), sync.DatabaseConfig("t"), doc(Status="select", Points="number")

    def dump(day, *lines):
        page_source.land_pages(spark.createDataFrame([(x,) for x in lines], "raw string").coalesce(1), landing, day)

    early = "2026-01-30T00:00:00Z"
    dump("2026-01-30", page("a", early, Status=select("Open")), page("b", early, Status=select("Open")))
    first = sync.sync_database(store, cfg, sync.Landed(schema, page_source.read_landed(spark, landing)), RUNS[0])
    dump("2026-02-02", page("a", "2026-02-01T05:00:00-08:00", Status=select("Done")), page("b", "2026-01-20T00:00:00Z", Status=select("Old")))
    dump("2026-02-02", page("c", "no time", Status=select("New"), Points={"number": "many"}), "no json")
    delivery = sync.Landed(schema, page_source.read_landed(spark, landing))
    taken = sync.taken_pages(delivery, RUNS[0], full=False)
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_day" in plan and "GreaterThanOrEqual(last_edited_time" in plan
    second = sync.sync_database(store, cfg, delivery, RUNS[1])
    assert (first.pages, second.pages) == (2, 2) and first.rejected == 0
    assert rows(store.read("t_pages").select("page_id", "status")) == [("a", "Done"), ("b", "Open"), ("c", "New")]
    # The first dump's folder lies before the day of the cutoff, so it is pruned.
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_day#\d+ >= 2026-01-31", plan)
    assert rows(store.read("t_rejects")) == [("c", "Points", "many", RUNS[1])] and second.rejected == 1
    assert any("1 values could not be read" in m for m in second.messages)


def test_an_append_with_another_type_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(replace={"x": spark.range(2)})
    with pytest.raises(ValueError, match="other types"):
        store.publish(append={"x": spark.range(2).select(F.col("id").cast("string"))})


def test_files_handling_can_change_on_a_table_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 5)
    store, schema = Store(spark, str(tmp_path)), doc(Files="files")
    lines = [page(f"p{n}", RUNS[0], Files={"files": [{"name": "f", "file": {"url": "u"}}]}) for n in range(40)]
    for full in (False, True):
        sync.sync_database(store, sync.DatabaseConfig("t"), landed(spark, schema, *lines), RUNS[int(full)], full=full)
    assert store.buckets("t_pages") > 1
    sync.sync_database(store, sync.DatabaseConfig("t", files_handling="names"), landed(spark, schema, page("p1", RUNS[2], Files={"files": [{"name": "g", "file": {"url": "u"}}]})), RUNS[2])
    assert store.read("t_pages").count() == 40 and {r.page_id: r.files for r in store.read("t_pages").collect()}["p1"] is not None


def test_older_and_unreadable_deliveries(spark, tmp_path):
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    sync.sync_database(store, cfg, landed(spark, schema, page("a", "2026-01-30T00:00:00Z", Status=select("old"))), RUNS[0])
    sync.sync_database(store, cfg, landed(spark, schema, page("a", "2026-02-01T10:00:00Z", Status=select("new"))), RUNS[1])
    late = sync.sync_database(store, cfg, landed(spark, schema, page("a", "2026-01-30T00:00:00Z", Status=select("old"))), RUNS[2], full=True)
    assert late.changes == 0 and rows(store.read("t_pages").select("page_id", "status")) == [("a", "new")]
    odd = sync.sync_database(store, cfg, landed(spark, schema, page("b", "no time", Status=select("x")), page("c", None, Status=select("y"))), RUNS[3])
    assert {r.page_id for r in store.read("t_pages").collect()} == {"a", "b", "c"} and any("2 pages without" in m for m in odd.messages)


def test_a_late_version_in_a_stream_does_not_win(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    write = stream.batch_writer(store, "t", lambda batch, number: f"run-{number}")
    shape = "page_id string, last_edited_time string, status string"
    write(spark.createDataFrame([("a", "2", "new")], shape), 0)
    write(spark.createDataFrame([("a", "1", "old"), ("b", "1", "x")], shape), 1)
    assert rows(store.read("t_pages").select("page_id", "status")) == [("a", "new"), ("b", "x")]
    assert store.read("t_changes").where("page_id = 'a' AND old_value IS NOT NULL").count() == 0


def test_a_stream_compares_unreadable_edit_times_as_its_batches_do(spark, tmp_path):
    shape = "page_id string, last_edited_time string, event_id long, status string"
    east = "2026-01-01T05:00:00+05:00"  # the moment of a and b, in other text
    first = [("a", "2026-01-01T00:00:00Z", 1, "new"), ("b", "2026-01-01T00:00:00Z", 2, "new"), ("c", "x", 2, "new"), ("d", "y", 1, "new"), ("e", None, 2, "old"), ("f", "x", 2, "old")]
    later = [("a", east, 0, "old"), ("b", east, 2, "again"), ("c", "y", 1, "old"), ("d", "x", 1, "old"), ("e", "x", 1, "again"), ("f", "2026-01-01", 1, "again")]
    store = Store(spark, str(tmp_path))
    write = stream.batch_writer(store, "t", lambda batch, number: f"run-{number}", ["last_edited_time", "event_id"], ["status"])
    for number, batch in enumerate((first, later)):
        write(spark.createDataFrame(batch, shape), number)
    kept = dict(rows(store.read("t_pages").select("page_id", "status")))
    assert kept == {"a": "new", "b": "again", "c": "new", "d": "new", "e": "again", "f": "again"}
    together = Store(spark, str(tmp_path / "together"))
    stream.batch_writer(together, "t", lambda batch, number: "run", ["last_edited_time", "event_id"])(spark.createDataFrame(first[2:4] + later[2:4], shape), 0)
    assert rows(together.read("t_pages").select("page_id", "status")) == [("c", "new"), ("d", "new")]


def test_kept_rows_of_a_stream_leave_the_initial_partitions(spark, tmp_path):
    store, setting = Store(spark, str(tmp_path)), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    write = stream.batch_writer(store, "t", lambda batch, number: f"run-{number}")
    spark.conf.set(setting, "60")
    try:
        write(spark.range(300).select(F.concat(F.lit("p"), "id").alias("page_id"), F.lit("2026-01-01").alias("last_edited_time")), 0)
    finally:
        spark.conf.unset(setting)
    assert store.read("t_pages").count() == 300 and len(store.read("t_pages").inputFiles()) <= 10


def test_buckets_that_meet_in_a_partition_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 1_000)
    store, sizes = Store(spark, str(tmp_path)), {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    keyed = spark.range(0, 8_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 512).alias("page_id"))
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        for _ in range(2):
            store.publish(replace={"t_pages": keyed}, bucket_by={"t_pages": "page_id"})
    finally:
        for key in sizes:
            spark.conf.unset(key)
    written = spark.read.parquet(*store.read("t_pages").inputFiles()).groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).count()
    assert store.buckets("t_pages") == 8 and written.agg(F.sum("count")).first()[0] == 8_000
    # No task writes the rows of two buckets, though the eight hash to fewer partitions.
    assert written.agg(F.max("count")).first()[0] <= 1_300


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for d in dirs for f in Path(d).rglob("shuffle_*")}


def staged_tables(store):
    return [t.name for t in store.spark.catalog.listTables(store.database) if t.name.startswith("stage_")]


def test_what_a_run_leaves_on_the_disk(spark, tmp_path):
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    spark._jvm.System.gc()  # what earlier tests left may go at any time, this run's must go by itself
    time.sleep(1)
    before = shuffle_files(spark)
    for run in RUNS[:2]:
        out = sync.sync_database(store, cfg, landed(spark, schema, *[page(f"{run}{i}", run, Status=select("Open")) for i in range(5_000)]), run)
        assert (out.pages, out.changes) == (5_000, 15_000)
    until = time.monotonic() + 10  # executors are told to drop the files, not waited for
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    # Rows are not sorted by the folder they go to, so none are spilled for that.
    table = f"`{store.database}`.`{store._state().tables['t_changes'].data_table}`"
    plan = spark.sql(f"EXPLAIN EXTENDED INSERT INTO {table} SELECT * FROM {table}").first()[0]
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort [" not in plan
    # Half of an id's 64 hex digits are nothing but their spelling.
    sizes = [Path(f.removeprefix("file:")).stat().st_size for f in store.read("t_changes").inputFiles()]
    assert sum(sizes) < 50 * store.read("t_changes").count()
    assert store.read("t_changes").select("id").distinct().count() == 30_000
    assert store.read("t_changes").where("id <> sha2(concat_ws('|', page_id, field, detected_at), 256)").isEmpty()


def test_staged_rows_go_with_their_run(spark, tmp_path, monkeypatch):
    store, cfg, schema = Store(spark, str(tmp_path)), sync.DatabaseConfig("t"), doc(Status="select")
    first = landed(spark, schema, page("a", RUNS[0], Status=select("Open")), page("a", RUNS[1], Status=select("Done")))
    with sync.plan_sync(store, cfg, first, RUNS[0]) as plan:
        assert rows(plan.delivered.select("page_id", "status")) == [("a", "Done")] and staged_tables(store) == [plan.staged]
    assert staged_tables(store) == [] and store.vacuum() == []
    with monkeypatch.context() as m:
        m.setattr(page_source, "rejected_values", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sync.plan_sync(store, cfg, first, RUNS[0])
    assert staged_tables(store) == []
    left = store.stage("t_delivered", first.pages)  # as of a run that was killed
    assert store.vacuum() == [left] and staged_tables(store) == []


def test_large_tables_are_written_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "BUCKET_ROWS", 10)
    store, large, small = Store(spark, str(tmp_path)), spark.range(50), spark.range(5)
    busy, beside, write = set(), set(), Tables._append

    def timed(self, df, entry, run):
        beside.update(frozenset((entry.data_table[5:6], other)) for other in busy)
        busy.add(entry.data_table[5:6])
        time.sleep(0.5)
        try:
            return write(self, df, entry, run)
        finally:
            busy.discard(entry.data_table[5:6])

    fresh = {"a": large, "b": large, "c": small, "d": small}
    store.publish(replace=fresh)
    monkeypatch.setattr(Tables, "_append", timed)
    store.publish(append=fresh)
    assert frozenset("ab") not in beside and frozenset("cd") in beside
    assert [store.read(n).count() for n in "abcd"] == [100, 100, 10, 10]


def test_a_run_without_renamed_options_reads_no_history(spark, tmp_path):
    store, cfg = Store(spark, str(tmp_path)), sync.DatabaseConfig("t")
    schema = json.dumps({"properties": {"Status": {"id": "s", "type": "select", "select": {"options": [{"id": "o_Open", "name": "Open"}]}}}})
    for i in range(3):
        sync.sync_database(store, cfg, landed(spark, schema, page(f"p{i}", RUNS[i], Status=select("Open"))), RUNS[i])
    with sync.plan_sync(store, cfg, landed(spark, schema, page("p0", RUNS[3], Status=select("Open"))), RUNS[3]) as plan:
        assert plan.rewritten_changes is None and "t_changes" not in plan.new_changes._jdf.queryExecution().toString()
        assert not plan.renamed_options
    assert not plan.delivered.is_cached


def test_new_backups_keep_the_time_of_older_ones(spark, tmp_path):
    store, cfg = Store(spark, str(tmp_path)), sync.DatabaseConfig("t")
    sync.sync_database(store, cfg, landed(spark, doc(A="number", B="number"), page("a", "2026-01-30T00:00:00Z", A={"number": 1}, B={"number": 2})), RUNS[0])
    sync.sync_database(store, cfg, landed(spark, doc(A="rich_text", B="number")), RUNS[1])
    sync.sync_database(store, cfg, landed(spark, doc(A="rich_text", B="rich_text")), RUNS[2])
    assert rows(store.read("_backups").select("column_name", "created_at")) == [("a", RUNS[1]), ("b", RUNS[2])]


def test_marts_leave_other_tables_alone(spark, tmp_path):
    store, data = Store(spark, str(tmp_path)), spark.range(2)
    store.publish(replace={"t_pages": data})
    sinks.publish_marts(store, {"m1": data, "m2": data})
    sinks.publish_marts(store, {"m2": data})
    assert store.tables() == ["m2", "t_pages"]
    with pytest.raises(ValueError, match="no marts"):
        sinks.publish_marts(store, {"t_pages": data})


def test_export_of_a_mart_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS exported LOCATION '{tmp_path}/db'")
    try:
        with pytest.raises(sinks.QualityError, match="no mart"):
            sinks.export_mart_schema(spark, "exported", str(tmp_path / "none"))
        spark.range(3).write.saveAsTable("exported.fct_a")
        assert sinks.mart_tables(spark, "exported") == ["fct_a"]
        assert sinks.export_mart_schema(spark, "exported", str(tmp_path / "out")) == {"fct_a": True}
        assert spark.read.parquet(str(tmp_path / "out" / "fct_a.parquet")).count() == 3
    finally:
        spark.sql("DROP DATABASE exported CASCADE")
