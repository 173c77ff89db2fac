import pytest
from pyspark.sql import functions as F

from fieldtrail.functions import names
from fieldtrail.sources.pages import Property

CASES = {
    "Name": "name", "Due Date": "due_date", "A  B  C": "a_b_c", "Field #1": "field_1", "Field (Notes)": "field_notes",
    "1st Task": "_1st_task", "A--B": "a_b", "A  --  B": "a_b", "!!!": "col", "___": "col", "status": "status",
    "Blocked by": "blocked_by", "Is Open": "is_open", "_Ünïted ²": "ünïted_²", "": "col", "日付": "日付",
}


@pytest.mark.parametrize("name,column", CASES.items())
def test_column_name(name, column):
    assert names.column_name(name) == column


def test_column_name_as_expression(spark):
    df = spark.createDataFrame([(n,) for n in CASES], "name string")
    got = {r.name: r.c for r in df.select("name", names.column_name_of(F.col("name")).alias("c")).collect()}
    assert got == CASES


DATED = ["page_id", "status", "due_date_start", "due_date_end", "closed_date_start", "closed_date_end"]


@pytest.mark.parametrize(
    "fields,columns,expected",
    [
        (["status"], ["status", "due_date_start"], ["status"]),
        (["due_date"], DATED, ["due_date_start", "due_date_end"]),
        (["my_date"], ["my_date_start"], ["my_date_start"]),
        (["nonexistent_field"], ["status"], ["nonexistent_field"]),
        ([], DATED, []),
        (["status", "due_date", "closed_date"], DATED, DATED[1:]),
        (["due_date_start"], DATED, ["due_date_start"]),
    ],
)
def test_expand_split_dates(fields, columns, expected):
    once = names.expand_split_dates(fields, columns)
    assert once == expected
    assert names.expand_split_dates(once, columns) == once


def test_lists():
    props = [Property("Status", "a", "select"), Property("Tags", "b", "multi_select"), Property("Due", "c", "date")]
    shadows = names.shadow_id_columns(props)
    assert shadows == ["status_id", "tags_id"]
    assert names.excluded_fields(["My Notes"], shadows) == ["my_notes", "status_id", "tags_id"]
    assert names.merge_column_lists(["a", "b"], ["b"], ["c", "a"]) == ["a", "c"]
