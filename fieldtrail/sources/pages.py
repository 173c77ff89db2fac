"""Landed page dumps to flat typed rows (O-S1, O-S2, O-S3, O-P2 to O-P8)."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions.canon import declared_type
from fieldtrail.functions.dates import to_timestamp
from fieldtrail.functions.names import SKIPPED_TYPES, column_name


@dataclass(frozen=True)
class Property:
    """One property of a database, as its schema document declares it."""

    name: str
    id: str | None
    type: str

    @property
    def column(self) -> str:
        return column_name(self.name)

    @property
    def columns(self) -> list[str]:
        if self.type == "date":
            return [f"{self.column}_start", f"{self.column}_end"]
        if self.type in ("select", "status", "multi_select"):
            return [self.column, f"{self.column}_id"]
        return [self.column]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """O-S1: one landed JSON document per line, column ``raw``. Land dumps in folders by
    ingest date: raw text has no statistics to skip by, its folders have."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


LANDED_SCHEMA = "raw string, last_edited_time timestamp, ingest_day date"


def edit_time(raw: str = "raw") -> Column:
    """The moment a page document was edited; NULL where it cannot be read."""
    return to_timestamp(F.get_json_object(raw, "$.last_edited_time"))


def land_pages(dump: DataFrame, path: str, ingest_day: str) -> None:
    """O-S1: adds one dump (``raw``) to a typed landing: Parquet in a folder per ingest day (UTC, the day
    the dump was taken), with the edit time as a column. Rows are ordered by it within each
    task's file, so row groups span narrow times and a scan by time skips most of them.
    A dump landed twice is a re-delivery, of which the sync takes the newest version."""
    typed = dump.select("raw", edit_time().alias("last_edited_time"), F.lit(ingest_day).cast("date").alias("ingest_day"))
    typed.sortWithinPartitions("last_edited_time").write.mode("append").partitionBy("ingest_day").parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """O-S1: a typed landing, for ``Landed.pages`` or ``edited_since``."""
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


def edited_since(pages: DataFrame, last_sync: str | None, overlap_seconds: int = 60, full: bool = False) -> DataFrame:
    """O-S2: pages edited since the last run, with an overlap for late edits. Without an
    earlier run, or for a full one, every page. A page without a readable time is taken in:
    whether it changed is for the comparison to tell. The column must be a timestamp, so
    the comparison is by time and reaches the Parquet scan. Of a typed landing, days before
    the cutoff are not read at all: dumps taken on them were there for the last run."""
    if full or last_sync is None:
        return pages
    kind = dict(pages.dtypes)["last_edited_time"]
    cutoff = F.lit(last_sync).cast("timestamp").cast(kind) - F.expr(f"interval {overlap_seconds} seconds")
    edited = F.col("last_edited_time")
    if "ingest_day" in pages.columns:
        pages = pages.where(F.col("ingest_day") >= cutoff.cast("date"))
    return pages.where(edited.isNull() | (edited >= cutoff))


def parse_schema(document: str | dict) -> list[Property]:
    """Properties in document order; bounded by the number of columns of a table."""
    doc = json.loads(document) if isinstance(document, str) else document
    return [
        Property(name, spec.get("id"), spec.get("type"))
        for name, spec in doc.get("properties", {}).items()
    ]


def schema_rows(documents: DataFrame, doc: str = "doc", keep: Sequence[str] = ("table_name",)) -> DataFrame:
    """O-S3 for many schema documents: one row per tracked property with its definition
    as VARIANT, without the skipped types and without properties that have no id."""
    parsed = documents.select(*keep, F.try_variant_get(F.try_parse_json(doc), "$.properties", "variant").alias("_props"))
    exploded = parsed.lateralJoin(
        documents.sparkSession.tvf.variant_explode_outer(F.col("_props").outer())
    )
    return exploded.select(
        *keep,
        F.try_variant_get("value", "$.id", "string").alias("property_id"),
        F.col("key").alias("property_name"),
        F.try_variant_get("value", "$.type", "string").alias("property_type"),
        F.col("value").alias("definition"),
    ).where(F.col("property_id").isNotNull() & (F.col("property_id") != "") & ~F.col("property_type").isin(*SKIPPED_TYPES))


def projected(
    schema: Iterable[Property], include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> list[Property]:
    """O-P3: the allowlist wins if set, then exclusions, both by original name."""
    return [
        p
        for p in schema
        if p.type not in SKIPPED_TYPES and (not include or p.name in include) and p.name not in exclude
    ]


# What is read of a value, by property type; anything else is read as text.
_TEXT = T.StringType()


def _list_of(*members: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(m, _TEXT) for m in members]))


_OPTION = T.StructType([T.StructField("id", _TEXT), T.StructField("name", _TEXT)])
_SPAN = T.StructType([T.StructField("start", _TEXT), T.StructField("end", _TEXT)])
_COMPUTED = T.StructType(
    [
        T.StructField("string", _TEXT),
        T.StructField("number", _TEXT),
        T.StructField("boolean", T.BooleanType()),
        T.StructField("date", _SPAN),
        T.StructField("array", T.ArrayType(_TEXT)),
    ]
)
VALUE_SHAPES: dict[str, T.DataType] = {
    "title": _list_of("plain_text"),
    "rich_text": _list_of("plain_text"),
    "number": T.DoubleType(),
    "checkbox": T.BooleanType(),
    "date": _SPAN,
    "select": _OPTION,
    "status": _OPTION,
    "multi_select": _list_of("id", "name"),
    "relation": _list_of("id"),
    "people": _list_of("name"),
    "files": _list_of("name"),
    "formula": _COMPUTED,
    "rollup": _COMPUTED,
}


def page_shape(props: Sequence[Property]) -> T.StructType:
    """The part of a page document the listed properties need. Names that differ only in
    case share a stored column, which the last of them gets."""
    wanted = {p.name.lower(): p for p in props}
    values = [
        T.StructField(p.name, T.StructType([T.StructField(p.type, VALUE_SHAPES.get(p.type, _TEXT))]))
        for p in wanted.values()
    ]
    system = [T.StructField(c, _TEXT) for c in ("id", "created_time", "last_edited_time", "url")]
    return T.StructType([*system, *([T.StructField("properties", T.StructType(values))] if values else [])])


def _property_columns(prop: Property, files_handling: str) -> list[Column]:
    """The stored columns of one property, NULL where the value is unset or malformed."""
    value = F.col("_page").getField("properties").getField(prop.name).getField(prop.type)

    def joined(member: str, separator: str = ", ") -> Column:
        return F.when(F.size(value) > 0, F.array_join(value.getField(member), separator))

    if prop.type == "date":
        return [value["start"], value["end"]]
    if prop.type in ("select", "status"):
        # A value lacking either member is malformed as a whole.
        whole = value["id"].isNotNull() & value["name"].isNotNull()
        return [F.when(whole, value[member]) for member in ("name", "id")]
    if prop.type == "multi_select":
        whole = ~F.exists(value, lambda o: o["id"].isNull() | o["name"].isNull())
        return [F.when(whole, joined(member)) for member in ("name", "id")]
    if prop.type in ("title", "rich_text"):
        return [F.array_join(value.getField("plain_text"), "")]
    if prop.type == "checkbox":
        return [value.cast("int")]
    if prop.type in ("formula", "rollup"):
        # Its text, number, 1/0, date start, or the number of its elements.
        return [
            F.coalesce(
                value["string"],
                value["number"],
                value["boolean"].cast("int").cast("string"),
                value["date"]["start"],
                F.size(value["array"]).cast("string"),
            )
        ]
    if prop.type == "relation":
        return [joined("id")]
    if prop.type == "people" or (prop.type == "files" and files_handling != "bool"):
        return [joined("name")]
    if prop.type == "files":
        return [(F.size(value) > 0).cast("int")]
    return [value]


def planned_columns(props: Sequence[Property], files_handling: str = "bool") -> dict[str, Column]:
    """Stored column -> expression in schema order. When names collide the later property
    takes the column, at the place of the first."""
    columns = {"page_id": F.col("_page.id")}
    columns.update({c: F.col(f"_page.{c}") for c in ("created_time", "last_edited_time", "url")})
    for prop in {p.name.lower(): p for p in props}.values():
        kind = declared_type(prop.type, files_handling)
        for name, expr in zip(prop.columns, _property_columns(prop, files_handling)):
            columns[name] = expr.cast(kind)
    return columns


def name_collisions(props: Iterable[Property]) -> dict[str, list[str]]:
    """Stored columns claimed by more than one source, with the claimants in order."""
    claims: dict[str, list[str]] = {c: ["(system)"] for c in ("page_id", "created_time", "last_edited_time", "url")}
    for prop in props:
        for col in prop.columns:
            claims.setdefault(col, []).append(prop.name)
    return {col: names for col, names in claims.items() if len(names) > 1}


def flatten_pages(
    pages: DataFrame,
    schema: Sequence[Property],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    files_handling: str = "bool",
    raw: str = "raw",
) -> DataFrame:
    """O-P2: one row per page, one or two columns per property, in schema order.

    Only what the listed properties need is read from a document; a value of the wrong
    shape is NULL and leaves the others alone. Rows that are no JSON or have no id are not
    pages; ``unreadable_pages`` returns them.
    """
    props = projected(schema, include, exclude)
    columns = planned_columns(props, files_handling)
    return (
        # A generator keeps the filter above the one place the document is parsed at.
        pages.select(F.explode(F.array(F.from_json(F.col(raw), page_shape(props)))).alias("_page"))
        .where(F.col("_page.id").isNotNull())
        .select(*[expr.alias(name) for name, expr in columns.items()])
    )


def unreadable_pages(pages: DataFrame, raw: str = "raw") -> DataFrame:
    """Landed rows that hold no page."""
    return pages.where(F.from_json(F.col(raw), page_shape(())).getField("id").isNull())


def rejected_values(
    pages: DataFrame,
    schema: Sequence[Property],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    files_handling: str = "bool",
    raw: str = "raw",
) -> DataFrame:
    """O-P8: (page_id, property, value) wherever a value is present but was not readable."""
    props = projected(schema, include, exclude)
    if not props:
        return pages.sparkSession.createDataFrame([], "page_id string, property string, value string")
    parsed = pages.select(raw, F.from_json(F.col(raw), page_shape(props)).alias("_page"))
    unread = {prop.name: _property_columns(prop, files_handling)[0].isNull() for prop in props}
    # Most pages have every value read; the texts as given are looked up in the others only.
    given = F.when(
        reduce(Column.__or__, unread.values()),
        F.from_json(F.col(raw), "properties map<string, map<string, string>>").getField("properties"),
    )
    entries = []
    for prop in props:
        value = F.col("_given")[F.lit(prop.name)][F.lit(prop.type)]
        empty = value.isin("", "[]", "{}")
        if prop.type == "date":
            empty = empty | value.rlike(r'"start":\s*null')
        if prop.type in ("formula", "rollup"):
            empty = empty | ~value.rlike(r'"(string|number|boolean|date|array)":\s*[^n\s]')
        entries.append(
            F.when(
                value.isNotNull() & ~empty & unread[prop.name],
                F.struct(F.lit(prop.name).alias("property"), value.alias("value")),
            )
        )
    return (
        parsed.select("_page", given.alias("_given"))
        .select(F.col("_page.id").alias("page_id"), F.inline(F.array(*entries)))
        .where(F.col("property").isNotNull())
    )
