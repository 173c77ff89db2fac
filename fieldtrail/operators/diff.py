"""Field-level change detection (O-C1, O-C2, O-C3, O-J1, O-F1, O-P18)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions.canon import canonical_text, differs, is_fractional
from fieldtrail.functions.names import SYSTEM_COLUMNS
from fieldtrail.operators import skew

# Never tracked, whatever the configuration says.
NEVER_TRACKED = ("last_edited_time", "content_text", "url")

CHANGES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("page_id", T.StringType(), False),
        T.StructField("field", T.StringType(), False),
        T.StructField("old_value", T.StringType()),
        T.StructField("new_value", T.StringType()),
        T.StructField("old_value_id", T.StringType()),
        T.StructField("new_value_id", T.StringType()),
        T.StructField("valid_from", T.StringType()),
        T.StructField("detected_at", T.StringType(), False),
    ]
)


def tracked_fields(
    columns: Sequence[str],
    change_fields: Iterable[str] = (),
    exclude_change_fields: Iterable[str] = (),
) -> list[str]:
    """O-F1: both lists apply. ``x_id`` beside ``x`` is an option id and is not tracked,
    unless it is a system column (a property named "Page" must not hide ``page_id``)."""
    wanted, unwanted = set(change_fields), set(exclude_change_fields) | set(NEVER_TRACKED)
    present = set(columns)

    def is_shadow(c: str) -> bool:
        return c.endswith("_id") and c not in SYSTEM_COLUMNS and c[:-3] in present

    return [c for c in columns if c not in unwanted and not is_shadow(c) and (not wanted or c in wanted)]


def change_id(page_id: Column, field: Column, detected_at: Column) -> Column:
    """A run emits at most one record per page and field, so this is unique."""
    return F.sha2(F.concat_ws("|", page_id, field, detected_at), 256)


# A changed field leaves the Generate as (field, text or number per side). The long text
# rule for numbers is applied once per record afterwards, which keeps the generated code
# of the wide side small.


def _sided(side: str, value: Column, dtype: T.DataType) -> list[Column]:
    number = is_fractional(dtype)
    nothing = F.lit(None)
    return [
        (nothing.cast("string") if number else canonical_text(value, dtype)).alias(f"_{side}_text"),
        (value.cast("double") if number else nothing.cast("double")).alias(f"_{side}_number"),
    ]


def _value_text(side: str) -> Column:
    number = canonical_text(F.col(f"_{side}_number"), T.DoubleType())
    return F.coalesce(F.col(f"_{side}_text"), number).alias(f"{side}_value")


def _entry(field: str, changed: Column, values: list[Column], **ids: Column) -> Column:
    members = [F.lit(field).alias("field"), *values, *[col.alias(name) for name, col in ids.items()]]
    return F.when(changed, F.struct(*members))


def detect_changes(
    batch: DataFrame,
    prev: DataFrame,
    run_ts: str,
    change_fields: Iterable[str] = (),
    exclude_change_fields: Iterable[str] = (),
    batch_is_small: bool = False,
) -> DataFrame:
    """O-C2 with O-C1: one record per tracked field whose canonical text differs; a page
    without a stored row yields every tracked field, NULL values included.

    ``batch`` and ``prev`` hold one row per ``page_id``. One join and one Generate. With
    ``batch_is_small`` (a counted size) the stored rows are first reduced by a broadcast
    of the batch keys, so a large snapshot is not shuffled.
    """
    fields = tracked_fields(batch.columns, change_fields, exclude_change_fields)
    if not fields:
        return batch.sparkSession.createDataFrame([], CHANGES_SCHEMA)
    types = {f.name: f.dataType for f in batch.schema}
    stored_types = {f.name: f.dataType for f in prev.schema}
    shadows = [f"{f}_id" for f in fields if f"{f}_id" in stored_types and f"{f}_id" not in SYSTEM_COLUMNS]
    stored_cols = [c for c in dict.fromkeys([*fields, *shadows]) if c in stored_types and c != "page_id"]

    if batch_is_small:
        prev = prev.join(F.broadcast(batch.select("page_id")), "page_id", "left_semi")
    stored = prev.select(
        F.col("page_id").alias("_key"),
        F.struct(*[F.col(c) for c in stored_cols], F.lit(True).alias("_seen")).alias("_p"),
    )
    joined = batch.join(stored, batch["page_id"] == stored["_key"], "left")
    unseen = F.col("_p").isNull()

    def option_id(field: str, side: str) -> Column:
        shadow = f"{field}_id"
        known = stored_types if side == "_p" else types
        if shadow in SYSTEM_COLUMNS or shadow not in known:
            return F.lit(None).cast("string")
        return F.col(f"_p.{shadow}" if side == "_p" else shadow).cast("string")

    entries = []
    for field in fields:
        new, new_type = F.col(field), types[field]
        if field == "page_id":
            old, old_type = F.col("_key"), stored_types["page_id"]
        elif field in stored_types:
            old, old_type = F.col(f"_p.{field}"), stored_types[field]
        else:
            old, old_type = F.lit(None).cast(new_type), new_type
        entries.append(
            _entry(
                field,
                unseen | differs(old, old_type, new, new_type),
                _sided("old", F.when(~unseen, old), old_type) + _sided("new", new, new_type),
                old_value_id=option_id(field, "_p"),
                new_value_id=option_id(field, "batch"),
            )
        )
    created = canonical_text(F.col("created_time"), types["created_time"]) if "created_time" in types else F.lit(run_ts)
    detected = F.lit(run_ts)
    return (
        joined.select(
            F.col("page_id").cast("string").alias("page_id"),
            F.when(unseen, created).otherwise(detected).alias("valid_from"),
            F.inline(F.array(*entries)),
        )
        .where(F.col("field").isNotNull())
        .select(
            change_id(F.col("page_id"), F.col("field"), detected).alias("id"),
            "page_id",
            "field",
            _value_text("old"),
            _value_text("new"),
            "old_value_id",
            "new_value_id",
            "valid_from",
            detected.alias("detected_at"),
        )
    )


def change_log(
    versions: DataFrame,
    key: str,
    order: Sequence[str],
    values: dict[str, str],
    hot=skew.COUNT,
) -> DataFrame:
    """O-C3: the records repeated runs of O-C2 would emit, from all versions at once.

    ``values`` maps field name to column. Returns (page_id, field, old_value, new_value,
    is_initial) plus the order columns. One shuffle by key; hot keys are split. ``hot`` is
    the outcome of ``hot_keys_if_any`` over ``page_id`` when the caller has it.
    """
    types = {f.name: f.dataType for f in versions.schema}
    cols = list(dict.fromkeys(values.values()))
    # Cast before the window: what is keyed by page_id afterwards needs no second shuffle.
    rest = [c for c in (*order, *cols) if c != "page_id"]
    slim = versions.select(F.col(key).cast("string").alias("page_id"), *dict.fromkeys(rest))
    paired = skew.ordered_neighbours(slim, ["page_id"], order, previous=cols, hot=hot)
    first = F.col("_prev").isNull()
    entries = [
        _entry(
            field,
            first | differs(F.col(f"_prev.{c}"), types[c], F.col(c), types[c]),
            _sided("old", F.col(f"_prev.{c}"), types[c]) + _sided("new", F.col(c), types[c]),
        )
        for field, c in values.items()
    ]
    return (
        paired.select(
            "page_id",
            *order,
            first.alias("is_initial"),
            F.inline(F.array(*entries)),
        )
        .where(F.col("field").isNotNull())
        .select("page_id", *order, "is_initial", "field", _value_text("old"), _value_text("new"))
    )
