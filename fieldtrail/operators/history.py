"""Rewrites of the change history (O-J2, O-C4 to O-C8, O-M11)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.functions.dates import range_end, range_start
from fieldtrail.operators import skew

log = logging.getLogger(__name__)


def with_option_ids(changes: DataFrame) -> DataFrame:
    """O-E2: a history written before option ids were stored gets them as NULL."""
    missing = [c for c in ("old_value_id", "new_value_id") if c not in changes.columns]
    return changes.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else changes


def option_names(options: DataFrame) -> DataFrame:
    """O-L2: one name per option id, that of the lowest property id."""
    return options.groupBy("option_id").agg(F.min_by("option_name", "property_id").alias("option_name"))


def names_differ(known: DataFrame, current: DataFrame) -> bool:
    """Whether an option has another name than was known, or was not known at all."""
    old = option_names(known).withColumnRenamed("option_name", "_known")
    moved = option_names(current).join(old, "option_id", "left").where(~F.col("option_name").eqNullSafe(F.col("_known")))
    return not moved.isEmpty()


def backfill_option_names(
    changes: DataFrame, options: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """O-J2, O-C4: values that carry an option id take the option's present name. NULL
    values and ids that are not registered stay. Adds ``old_updated`` and ``new_updated``."""
    names = option_names(options)
    small = skew.fits_broadcast(names, max_rows)
    out = changes
    for side in ("old", "new"):
        lookup = names.select(F.col("option_id").alias(f"{side}_value_id"), F.col("option_name").alias("_name"))
        out = skew.lookup_join(out, lookup, [f"{side}_value_id"], ["id"], small=small)
        stale = F.coalesce(F.col("_name") != F.col(f"{side}_value"), F.lit(False))
        out = (
            out.withColumn(f"{side}_updated", stale)
            .withColumn(f"{side}_value", F.when(F.col(f"{side}_updated"), F.col("_name")).otherwise(F.col(f"{side}_value")))
            .drop("_name")
        )
    return out.select(*changes.columns, "old_updated", "new_updated")


def backfill_count(backfilled: DataFrame) -> DataFrame:
    """How many values a backfill changed, as one row."""
    touched = F.col("old_updated").cast("long") + F.col("new_updated").cast("long")
    return backfilled.agg(F.coalesce(F.sum(touched), F.lit(0)).alias("updated_values"))


def rename_fields(changes: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """O-C7: many field renames in one pass."""
    if not renames:
        return changes
    lookup = F.create_map(*[F.lit(x) for pair in renames.items() for x in pair])
    return changes.withColumn("field", F.coalesce(lookup[F.col("field")], F.col("field")))


def delete_fields(changes: DataFrame, fields: Iterable[str]) -> DataFrame:
    """O-C8."""
    return changes.where(~F.col("field").isin(*fields))


def split_date_fields(changes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """O-C5: each record of a date field becomes one for its start and one for its end,
    without option ids; the end of a plain date is NULL. Other records pass unchanged."""
    if not fields:
        return changes

    def half(suffix: str, part) -> Column:
        cols = []
        for c in changes.columns:
            if c == "field":
                cols.append(F.concat(F.col("field"), F.lit(suffix)).alias(c))
            elif c in ("old_value", "new_value"):
                cols.append(part(F.col(c)).alias(c))
            elif c in ("old_value_id", "new_value_id"):
                cols.append(F.lit(None).cast("string").alias(c))
            elif c == "id":
                cols.append(F.sha2(F.concat(F.col("id").cast("string"), F.lit(suffix)), 256).alias(c))
            else:
                cols.append(F.col(c))
        return F.struct(*cols)

    whole = F.struct(*[F.col(c).cast("string").alias(c) if c == "id" else F.col(c) for c in changes.columns])
    halves = F.array(half("_start", range_start), half("_end", range_end))
    return changes.select(F.inline(F.when(F.col("field").isin(*fields), halves).otherwise(F.array(whole))))


def chained_pairs(value_map: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Map entries whose result is mapped again by a later entry."""
    return [(o, n) for i, (o, n) in enumerate(value_map) if any(n == later and later != m for later, m in value_map[i + 1 :])]


def normalise_values(
    changes: DataFrame, fields: Sequence[str], value_map: Sequence[tuple[str, str]]
) -> DataFrame:
    """O-C6: applies the map to both values of the fields, entry after entry, so a result
    that a later entry names is mapped again (unlike the one-step column migration)."""
    if not fields or not value_map:
        return changes
    for old, new in chained_pairs(value_map):
        log.warning("value map chains: %r -> %r is mapped again", old, new)

    def final(start: str) -> str:
        value = start
        for old, new in value_map:
            value = new if value == old else value
        return value

    # Following each distinct start through the map once gives the same result as one
    # pass per entry, as a single lookup.
    outcome = {start: final(start) for start, _ in value_map}
    lookup = F.create_map(*[F.lit(x) for pair in outcome.items() for x in pair])
    hit = F.col("field").isin(*fields)
    return changes.withColumns(
        {c: F.when(hit, F.coalesce(lookup[F.col(c)], F.col(c))).otherwise(F.col(c)) for c in ("old_value", "new_value")}
    )


def rename_only(changes: DataFrame) -> DataFrame:
    """O-M11: flags records where the option stayed and only its name changed."""
    same_option = F.col("old_value_id").isNotNull() & (F.col("old_value_id") == F.col("new_value_id"))
    return changes.withColumn("is_rename_only", F.coalesce(same_option & (F.col("old_value") != F.col("new_value")), F.lit(False)))
