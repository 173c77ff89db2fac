import json

from pyspark.sql import functions as F

from fieldtrail.operators import evolve
from fieldtrail.sources import content, pages
from tests.conftest import rows

TYPES = {
    "Name": "title", "Notes?": "rich_text", "Points": "number", "Done": "checkbox", "Status": "status", "Kind": "select",
    "Tags": "multi_select", "Due Date": "date", "Calc": "formula", "Sum": "rollup", "Parent": "relation", "Who": "people",
    "Files": "files", 'Odd "name".x': "email", "Made By": "created_by",
}
DOC = {"properties": {n: {"id": f"i{k}", "type": t, t: {}} for k, (n, t) in enumerate(TYPES.items())}}
FULL = {
    "Name": {"title": [{"plain_text": "a"}, {"plain_text": "b"}]}, "Notes?": {"rich_text": [{"plain_text": "n"}]}, "Points": {"number": 3},
    "Done": {"checkbox": True}, "Status": {"status": {"id": "s", "name": "Open"}}, "Kind": {"select": {"id": "k", "name": "Big"}},
    "Tags": {"multi_select": [{"id": "1", "name": "x"}, {"id": "2", "name": "y"}]}, "Due Date": {"date": {"start": "2026-01-01", "end": "2026-01-02"}},
    "Calc": {"formula": {"type": "boolean", "boolean": True}}, "Sum": {"rollup": {"type": "array", "array": [{"a": 1}, {"b": 2}]}},
    "Parent": {"relation": [{"id": "p"}, {"id": "q"}]}, "Who": {"people": [{"name": "Ada"}]}, "Files": {"files": [{"name": "f.pdf"}]},
    'Odd "name".x': {"email": "e@x"}, "Made By": {"created_by": {"id": "u"}},
}
EMPTY = {
    "Name": {"title": []}, "Status": {"status": None}, "Tags": {"multi_select": []}, "Due Date": {"date": None}, "Done": {"checkbox": False},
    "Calc": {"formula": {"type": "number", "number": None}}, "Sum": {"rollup": {"type": "number", "number": 2.5}}, "Parent": {"relation": []}, "Files": {"files": []},
}
BROKEN = {
    "Points": {"number": "many"}, "Kind": {"select": {"name": "no id"}}, "Tags": {"multi_select": [{"id": "1"}]}, "Due Date": {"date": "soon"},
    "Done": {"checkbox": "yes"}, "Name": {"title": [{"plain_text": "still read"}]},
}


def landed(spark, **docs):
    lines = [json.dumps({"id": i, "created_time": "c", "last_edited_time": "e", "url": "u", "properties": p}) for i, p in docs.items()]
    return spark.createDataFrame([(x,) for x in [*lines, "no json", '{"properties": {}}', '{"id": "cut']], "raw string")


def test_every_property_type(spark):
    df = landed(spark, full=FULL, empty=EMPTY, broken=BROKEN, none={})
    flat = pages.flatten_pages(df, pages.parse_schema(DOC))
    assert flat.columns == [
        "page_id", "created_time", "last_edited_time", "url", "name", "notes", "points", "done", "status", "status_id", "kind",
        "kind_id", "tags", "tags_id", "due_date_start", "due_date_end", "calc", "sum", "parent", "who", "files", "odd_name_x",
    ]
    got = {r.page_id: tuple(r)[4:] for r in flat.collect()}
    assert got["full"] == ("ab", "n", 3.0, 1, "Open", "s", "Big", "k", "x, y", "1, 2", "2026-01-01", "2026-01-02", "1", "2", "p, q", "Ada", 1, "e@x")
    assert got["empty"] == ("", None, None, 0) + (None,) * 9 + ("2.5", None, None, 0, None)
    assert got["broken"] == ("still read",) + (None,) * 17
    assert got["none"] == (None,) * 18
    assert pages.unreadable_pages(df).count() == 3


def test_rejects_name_what_was_not_read(spark):
    got = rows(pages.rejected_values(landed(spark, full=FULL, empty=EMPTY, broken=BROKEN), pages.parse_schema(DOC)))
    assert [(p, name) for p, name, _ in got] == [("broken", n) for n in ("Done", "Due Date", "Kind", "Points", "Tags")]


def test_projection_and_files_by_name(spark):
    props = pages.parse_schema(DOC)
    df = landed(spark, full=FULL)
    assert pages.flatten_pages(df, props, ["Name", "Due Date"], ["Name"]).columns[4:] == ["due_date_start", "due_date_end"]
    assert pages.flatten_pages(df, props, ["Files"], files_handling="names").first().files == "f.pdf"
    assert pages.flatten_pages(df, props, ["Nothing"]).columns == ["page_id", "created_time", "last_edited_time", "url"]


def test_colliding_names(spark):
    doc = {"properties": {"A b": {"id": "1", "type": "number"}, "a_B": {"id": "2", "type": "email"}, "URL": {"id": "3", "type": "url"}}}
    props = pages.parse_schema(json.dumps(doc))
    raw = landed(spark, x={"A b": {"number": 1}, "a_B": {"email": "later"}, "URL": {"url": "own"}})
    row = pages.flatten_pages(raw, props).first()
    assert (row.a_b, row.url) == ("later", "own")
    assert pages.name_collisions(props) == {"a_b": ["A b", "a_B"], "url": ["(system)", "URL"]}


def test_edited_since(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 10:00:00' - make_dt_interval(0, 0, 0, id) AS last_edited_time FROM range(0, 120, 30) t(id)")
    at = "2026-01-01T10:00:00+00:00"
    assert pages.edited_since(df, at).count() == 3
    assert pages.edited_since(df, at, full=True).count() == pages.edited_since(df, None).count() == 4


def test_edited_since_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT timestamp'2026-01-01' + make_dt_interval(id) AS last_edited_time, id FROM range(10) t(id)").write.parquet(str(tmp_path / "t"))
    df = pages.edited_since(spark.read.parquet(str(tmp_path / "t")), "2026-01-05T00:00:00+00:00")
    assert "GreaterThanOrEqual(last_edited_time,2026-01-04 23:59:00.0)" in df._jdf.queryExecution().executedPlan().toString()


def test_options_and_their_groups(spark):
    doc = {"properties": {
        "S": {"id": "p1", "type": "status", "status": {
            "options": [{"id": "o1", "name": "Backlog"}, {"id": "o2", "name": "Doing"}, {"id": "o3", "name": "Done"}],
            "groups": [{"name": "Not started", "option_ids": ["o1"]}, {"name": "In progress", "option_ids": ["o2"]}]}},
        "K": {"id": "p2", "type": "select", "select": {"options": [{"id": "o1", "name": "Open"}]}},
        "M": {"id": "p3", "type": "multi_select", "multi_select": {"options": []}},
        "N": {"type": "number"}, "C": {"id": "p4", "type": "created_by"},
    }}
    found = pages.schema_rows(spark.createDataFrame([("t", json.dumps(doc))], "table_name string, doc string"))
    assert rows(evolve.property_registry(found)) == [("t", "p1", "S", "s", "status"), ("t", "p2", "K", "k", "select"), ("t", "p3", "M", "m", "multi_select")]
    assert rows(evolve.options_of(found)) == [
        ("t", "p1", "o1", "Backlog", "Not started"), ("t", "p1", "o2", "Doing", "In progress"), ("t", "p1", "o3", "Done", None), ("t", "p2", "o1", "Open", None),
    ]


def rich(kind, text, **more):
    return {"type": kind, kind: {"rich_text": [{"plain_text": text}], **more}}


BLOCKS = [
    (rich("paragraph", "p"), "p"), (rich("heading_2", "h"), "h"), (rich("toggle", "t"), "t"), (rich("bulleted_list_item", "b"), "b"),
    (rich("numbered_list_item", "n"), "n"), (rich("to_do", "x", checked=True), "[x] x"), (rich("to_do", "y", checked=False), "[ ] y"),
    (rich("quote", "q"), "> q"), (rich("callout", "c"), "| c"), (rich("code", "k", language="sql"), "[code:sql] k"),
    ({"type": "table", "table": {}}, None), ({"type": "table_row", "table_row": {"cells": [[{"plain_text": "1"}], [{"plain_text": "2"}, {"plain_text": "3"}]]}}, "1 | 23"),
    ({"type": "child_page", "child_page": {"title": "T"}}, "[child_page: T]"), ({"type": "child_database", "child_database": {"title": "D"}}, "[child_database: D]"),
    ({"type": "image", "image": {"caption": [{"plain_text": "cap"}]}}, "[image: cap]"), ({"type": "image", "image": {"caption": []}}, "[image]"),
    ({"type": "video", "video": {}}, "[video]"), ({"type": "pdf", "pdf": {}}, "[pdf]"), ({"type": "file", "file": {"name": "f.zip"}}, "[file: f.zip]"),
    ({"type": "bookmark", "bookmark": {"url": "u"}}, "[bookmark: u]"), ({"type": "embed", "embed": {"url": "v"}}, "[embed: v]"),
    ({"type": "link_preview", "link_preview": {"url": "w"}}, "[link_preview: w]"), ({"type": "synced", "synced": {}}, "[unsupported]"),
]


def test_block_texts_in_order(spark, monkeypatch):
    monkeypatch.setattr(content, "PIECE_BLOCKS", 5)
    data = [("a", i, json.dumps(b)) for i, (b, _) in enumerate(BLOCKS)] + [("b", 0, json.dumps(rich("paragraph", "only")))]
    df = spark.createDataFrame(data, "page_id string, position int, raw string").repartition(4, "raw")
    got = {r.page_id: r.content_text for r in content.content_text(df).collect()}
    assert got == {"a": "\n".join(t for _, t in BLOCKS if t is not None), "b": "only"}


def test_comments(spark):
    doc = {"page_id": "p", "results": [{"id": "c1", "created_time": "t", "last_edited_time": "u", "rich_text": [{"plain_text": "a"}, {"plain_text": "b"}]}]}
    df = spark.createDataFrame([(json.dumps(doc),), ('{"page_id": "q", "results": []}',)], "raw string")
    assert rows(content.comment_rows(df)) == [("c1", "p", "t", "u", "ab")]


def test_given_values_are_looked_up_only_beside_unread_ones(spark):
    found = pages.rejected_values(landed(spark, full=FULL, broken=BROKEN), pages.parse_schema(DOC))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    by_text = [line.split("from_json(StructField(properties,MapType")[0] for line in plan.splitlines() if "MapType" in line]
    assert len(by_text) == 1 and by_text[0].rstrip().endswith("THEN") and "CASE WHEN" in by_text[0]
