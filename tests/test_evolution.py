import pytest
from fieldtrail.operators import evolve, history, migrate, orphans, upsert
from fieldtrail.operators.diff import CHANGES_SCHEMA
from tests.conftest import rows

NOW = "2026-07-15T00:00:00Z"


def diff_row(status, old=None, new=None, old_type="select", new_type="select", pid="pid"):
    col = lambda name: name and name.lower().replace(" ", "_")
    return dict(status=status, property_id=pid, old_name=old, new_name=new, old_column=col(old), new_column=col(new), old_type=old_type, new_type=new_type)


def change(field, old=None, new=None, old_id=None, new_id=None, page="p1", at="2026-06-01"):
    return (f"{page}-{field}-{at}", page, field, old, new, old_id, new_id, at, at)


def changes_of(spark, *records):
    return spark.createDataFrame(list(records), CHANGES_SCHEMA)


def test_schema_diff_and_registry(spark):
    shape = "table_name string, property_id string, property_name string, column_name string, property_type string"
    cur = spark.createDataFrame([("t", "1", "Effort", "effort", "select"), ("t", "2", "New", "new", "date"), ("t", "4", "Same", "same", "date")], shape)
    old = spark.createDataFrame(
        [("t", "1", "Effort Level", "effort_level", "number", "a", "b"), ("t", "3", "Gone", "gone", "select", "a", "b"), ("t", "4", "Same", "same", "date", "a", "b")],
        shape + ", first_seen string, last_seen string",
    )
    got = {r.property_id: r.status for r in evolve.schema_diff(cur, old).collect()}
    assert got == {"1": "renamed_and_type_changed", "2": "new", "3": "disappeared", "4": "same"}
    merged = {r.property_id: (r.property_name, r.first_seen, r.last_seen) for r in evolve.upsert_registry(old, cur, ["table_name", "property_id"], NOW).collect()}
    assert merged == {"1": ("Effort", "a", NOW), "2": ("New", NOW, NOW), "3": ("Gone", "a", "b"), "4": ("Same", "a", NOW)}


def test_rename_moves_the_family_and_its_history(spark):
    pages = spark.createDataFrame([("p1", "high", "h", "2026-01-01")], "page_id string, effort_level string, effort_level_id string, due_start string")
    log = changes_of(spark, change("effort_level", None, "high"), change("other", None, "x"))
    out = evolve.evolve(pages, log, [diff_row("renamed", "Effort Level", "Effort")], {("effort_level", "number"): "effort_level_bak_1"}, NOW)
    assert out.pages.columns == ["page_id", "effort", "effort_id", "due_start"]
    assert sorted(r.field for r in out.changes.collect()) == ["effort", "other"]
    assert out.backups == {("effort", "number"): "effort_level_bak_1"}
    assert out.changed_pages and "renamed" in out.messages[0]
    dated = evolve.rename_family(pages, log, "due", "deadline")[0]
    assert "deadline_start" in dated.columns and "due_start" not in dated.columns
    same, _ = evolve.rename_family(pages, log, "absent", "effort_level")
    assert same.columns == pages.columns


def test_declared_rename_fills_and_keeps(spark):
    pages = spark.createDataFrame([("p1", "a", None), ("p2", "b", "kept")], "page_id string, old string, new string")
    log = changes_of(spark, change("old", None, "a"))
    got, history_, moved = evolve.apply_declared_rename(pages, log, "old", "new")
    assert moved and rows(got) == [("p1", "a", "a"), ("p2", "b", "kept")]
    assert history_.first().field == "new"
    again = evolve.apply_declared_rename(got, history_, "old", "new")
    assert rows(again[0]) == rows(got)
    assert evolve.apply_declared_rename(pages, log, "absent", "x")[2] is False


def test_type_change_and_return(spark):
    pages = spark.createDataFrame([("p1", "high", "h")], "page_id string, effort string, effort_id string")
    log = changes_of(spark, change("effort", None, "high"))
    out = evolve.evolve(pages, log, [diff_row("type_changed", "Effort", "Effort", "select", "rich_text")], {}, NOW)
    assert out.pages.columns == ["page_id", "effort_bak_20260715", "effort_id_bak_20260715"]
    assert out.backups == {("effort", "select"): "effort_bak_20260715", ("effort_id", "select"): "effort_id_bak_20260715"}
    interim = upsert.upsert(out.pages, spark.createDataFrame([("p1", "text")], "page_id string, effort string"))
    back = evolve.evolve(interim, log, [diff_row("type_changed", "Effort", "Effort", "rich_text", "select")], out.backups, "2026-07-16T00:00:00Z")
    assert sorted(back.pages.columns) == ["effort", "effort_id", "page_id"]
    assert rows(back.pages.select("page_id", "effort", "effort_id")) == rows(pages)
    assert back.backups == {}


def test_stale_backup_entries_fall_back_to_a_new_backup(spark):
    pages = spark.createDataFrame([("p1", "x")], "page_id string, effort string")
    out = evolve.evolve(
        pages, changes_of(spark, change("effort")), [diff_row("type_changed", "Effort", "Effort", "number", "select")], {("effort", "select"): "gone"}, NOW
    )
    assert out.backups == {("effort", "number"): "effort_bak_20260715"}
    assert "effort_bak_20260715" in out.pages.columns


def test_type_change_of_a_property_without_columns_does_nothing(spark):
    pages = spark.createDataFrame([("p1",)], "page_id string")
    out = evolve.evolve(pages, changes_of(spark, change("x")), [diff_row("type_changed", "Due", "Due", "date", "select")], {}, NOW)
    assert out.pages.columns == ["page_id"] and out.backups == {} and not out.changed_pages


def test_backup_names_are_numbered():
    assert evolve.backup_name("a", "20260101", []) == "a_bak_20260101"
    assert evolve.backup_name("a", "20260101", ["a_bak_20260101"]) == "a_bak_20260101_2"
    assert evolve.backup_name("a", "20260101", ["a_bak_20260101", "a_bak_20260101_2"]) == "a_bak_20260101_3"


def test_a_disappeared_property_keeps_its_data(spark):
    pages = spark.createDataFrame([("p1", "x")], "page_id string, old_field string")
    out = evolve.evolve(pages, changes_of(spark, change("x")), [diff_row("disappeared", "Old Field", None)], {}, NOW)
    assert out.pages.columns == pages.columns and "old_field" in out.messages[0]


def test_backfill(spark):
    opts = spark.createDataFrame([("b", "opt1", "Other"), ("a", "opt1", "Active"), ("a", "opt3", "Same")], "property_id string, option_id string, option_name string")
    log = changes_of(
        spark, change("status", "In Progress", "Done", "opt1", "opt2"), change("status", "Active", "Same", "opt1", "opt3", "p2"),
        change("status", None, "Old", "opt1", "opt1, opt3", "p3"), change("status", None, "Was", None, "opt1", "p4"),
    )
    for bound in (100, 0):
        done = history.backfill_option_names(log, opts, bound)
        assert rows(done.select("page_id", "old_value", "new_value")) == [("p1", "Active", "Done"), ("p2", "Active", "Same"), ("p3", None, "Old"), ("p4", None, "Active")]
        assert history.backfill_count(done).first().updated_values == 2


def test_history_split_and_migration(spark):
    log = changes_of(
        spark, change("due_date", "2026-06-01/2026-06-02", "2026-06-05/2026-06-06"), change("due_date", "2026-06-01", "2026-06-10", page="p2"), change("status", "Open", "Done", "a", "b")
    )
    split = history.split_date_fields(log, ["due_date"])
    assert rows(split.select("page_id", "field", "old_value", "new_value", "old_value_id")) == [
        ("p1", "due_date_end", "2026-06-02", "2026-06-06", None), ("p1", "due_date_start", "2026-06-01", "2026-06-05", None),
        ("p1", "status", "Open", "Done", "a"), ("p2", "due_date_end", None, None, None), ("p2", "due_date_start", "2026-06-01", "2026-06-10", None),
    ]
    assert split.select("id").distinct().count() == 5 and split.dtypes == log.dtypes
    assert history.split_date_fields(log, []) is log
    moved = history.normalise_values(log, ["status"], [("Open", "1"), ("1", "2"), ("Done", "3")])
    assert rows(moved.select("field", "old_value", "new_value"))[-1] == ("status", "2", "3")
    assert history.chained_pairs([("a", "b"), ("b", "c")]) == [("a", "b")]
    assert rows(history.delete_fields(log, ["due_date"]).select("field")) == [("status",)]


def test_old_histories_get_option_ids(spark):
    old = changes_of(spark, change("a")).drop("old_value_id", "new_value_id")
    assert set(history.with_option_ids(old).columns) == set(CHANGES_SCHEMA.fieldNames())


def test_column_migration_and_split(spark):
    pages = spark.createDataFrame([("p1", "True", "2026-06-01T09:00/2026-06-02"), ("p2", "12abc", "2026-06-01"), ("p3", None, None)], "page_id string, done string, due_date string")
    got = migrate.migrate_columns(pages, ["done", "missing"], "INTEGER", migrate.value_map_for("INTEGER"))
    assert rows(got.select("page_id", "done")) == [("p1", 1), ("p2", 12), ("p3", None)] and got.columns == pages.columns
    assert rows(migrate.split_date_columns(pages, ["due_date", "nope"]).drop("done")) == [("p1", "2026-06-01T09:00", "2026-06-02"), ("p2", "2026-06-01", None), ("p3", None, None)]
    assert migrate.split_date_columns(pages, ["nope"]) is pages
    impact = rows(migrate.migration_impact(pages, ["done"], "INTEGER", [("True", "1")]))
    assert impact == [("done", 2, 0)]


def test_date_detection(spark):
    pages = spark.createDataFrame(
        [("p1", None, "", "Task", 1, "2026-01-01", "2026-01-01", None), ("p2", "2026-06-01T09:00", "2026-06-05/2026-06-06", "Task", 2, "2026-01-01", "2026-01-01", None)],
        "page_id string, due_date string, range string, name string, count int, created_time string, x_start string, nothing string",
    )
    assert rows(migrate.detect_date_columns(pages).select("column_name")) == [("due_date",), ("range",)]
    assert migrate.detect_date_columns(spark.createDataFrame([(1,)], "n int")).count() == 0


def test_orphans(spark):
    names = ["page_id", "url", "status", "status_id", "due_start", "due_end", "effort_bak_1", "lost", "lost_id", "kept_bak"]
    cols = spark.createDataFrame([("t", c) for c in names], "table_name string, column_name string")
    reg = spark.createDataFrame([("t", "status", "2"), ("t", "due", "1"), ("u", "lost", "2")], "table_name string, column_name string, last_seen string")
    bak = spark.createDataFrame([("t", "kept_bak")], "table_name string, backup_column string")
    assert rows(orphans.find_orphans(cols, reg, bak).select("column_name")) == [("effort_bak_1",), ("lost",), ("lost_id",)]
    loose = rows(orphans.find_orphans(cols, reg, bak, strict=False).select("column_name"))
    assert ("due_start",) in loose and ("status",) not in loose
    pages = spark.createDataFrame([("p1", "x", None), ("p2", None, None)], "page_id string, lost string, lost_id string")
    log = changes_of(spark, change("lost", None, "x"), change("status", None, "x"))
    assert rows(orphans.orphan_impact(pages, log, ["lost", "lost_id"])) == [("lost", 1, 1), ("lost_id", 0, 0)]
    kept, logged, registered = orphans.drop_orphans(pages, log, reg, "t", ["lost", "status"])
    assert kept.columns == ["page_id", "lost_id"] and logged.count() == 0 and registered.count() == 2


def test_upserts(spark):
    prev = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "page_id string, n int, old string")
    batch = spark.createDataFrame([("b", 9.5, None), ("c", 3.0, "z")], "page_id string, n double, new string")
    for small in (False, True):
        merged = upsert.upsert(prev, batch, batch_is_small=small)
        assert merged.columns == ["page_id", "n", "old", "new"]
        assert rows(merged) == [("a", 1.0, "x", None), ("b", 9.5, "y", None), ("c", 3.0, None, "z")]
        replaced = upsert.upsert(prev, batch, mode="replace", batch_is_small=small)
        assert rows(replaced) == [("a", 1.0, "x", None), ("b", 9.5, None, None), ("c", 3.0, None, "z")]


def test_soft_delete(spark):
    prev = spark.createDataFrame([("a",), ("b",)], "page_id string")
    once = upsert.mark_deleted(prev, prev.where("page_id = 'a'"), "2026-01-01T00:00:00Z")
    assert rows(once) == [("a", None), ("b", "2026-01-01T00:00:00Z")]
    again = upsert.mark_deleted(once, prev.where("page_id = 'b'"), "2026-01-05T00:00:00Z")
    assert rows(again) == [("a", "2026-01-05T00:00:00Z"), ("b", None)]
    assert rows(upsert.purge_deleted(again, "2026-02-10T00:00:00Z", 30)) == [("b", None)]


def _diff_row(pid, old, new, status="renamed"):
    return {"status": status, "old_column": old, "new_column": new, "old_name": old, "new_name": new, "property_id": pid, "old_type": "number", "new_type": "number"}


@pytest.mark.parametrize(
    ("renames", "want", "fields"),
    [
        ([("a", "b"), ("b", "a")], {"a": 2, "b": 1, "c": 3}, ["b", "a", "c"]),
        ([("a", "b"), ("b", "c")], {"b": 1, "c": 2}, ["b", "c", "c"]),
        ([("a", "b"), ("b", "c"), ("c", "a")], {"a": 3, "b": 1, "c": 2}, ["b", "c", "a"]),
        ([("a", "z")], {"z": 1, "b": 2, "c": 3}, ["z", "b", "c"]),
    ],
)
def test_renames_of_a_run_happen_at_once(spark, renames, want, fields):
    pages = spark.createDataFrame([("p", 1, 2, None if ("b", "c") in renames and len(renames) == 2 else 3)], "page_id string, a int, b int, c int")
    changes = spark.createDataFrame([(i, f) for i, f in enumerate(["a", "b", "c"])], "id int, field string")
    backups = {("a", "text"): "a_bak", ("b", "text"): "b_bak"}
    out = evolve.evolve(pages, changes, [_diff_row(str(i), o, n) for i, (o, n) in enumerate(renames)], backups, "2026-01-01T00:00:00+00:00")
    got = out.pages.first().asDict()
    assert {k: v for k, v in got.items() if k != "page_id"} == want
    assert [r.field for r in out.changes.orderBy("id").collect()] == fields
    moved = dict(renames)
    assert out.backups == {(moved.get(c, c), t): b for (c, t), b in backups.items()}
