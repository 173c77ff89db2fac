"""Schema registries and schema evolution (O-J3, O-J5, O-U3, O-E1 to O-E9, O-E13).

Registries are DataFrames. Deciding which columns to rename, back up or restore is done
on the driver from the registry rows of one table, whose number is its column count.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.functions.names import column_family, column_name_of
from fieldtrail.operators import history

log = logging.getLogger(__name__)


# -- registries ------------------------------------------------------------------------


def property_registry(schema_rows: DataFrame) -> DataFrame:
    """Schema rows as registry columns."""
    return schema_rows.select(
        "table_name",
        "property_id",
        "property_name",
        column_name_of(F.col("property_name")).alias("column_name"),
        "property_type",
    )


def schema_diff(current: DataFrame, stored: DataFrame) -> DataFrame:
    """O-J3, O-U3: every property as new, same, renamed, type_changed,
    renamed_and_type_changed or disappeared, matched by its stable id."""
    keys = ["table_name", "property_id"]
    cur = current.select(
        *keys, F.col("property_name").alias("new_name"), F.col("column_name").alias("new_column"),
        F.col("property_type").alias("new_type"),
    )
    old = stored.select(
        *keys, F.col("property_name").alias("old_name"), F.col("column_name").alias("old_column"),
        F.col("property_type").alias("old_type"),
    )
    renamed = F.col("new_name") != F.col("old_name")
    retyped = F.col("new_type") != F.col("old_type")
    status = (
        F.when(F.col("old_name").isNull(), "new")
        .when(F.col("new_name").isNull(), "disappeared")
        .when(renamed & retyped, "renamed_and_type_changed")
        .when(renamed, "renamed")
        .when(retyped, "type_changed")
        .otherwise("same")
    )
    return cur.join(old, keys, "full").withColumn("status", status)


def upsert_registry(stored: DataFrame, current: DataFrame, keys: Sequence[str], now: str) -> DataFrame:
    """O-E7, O-E8: present entries take the current values and ``last_seen``; the first
    sighting is kept, and entries that disappeared stay as they were."""
    values = [c for c in current.columns if c not in keys]
    cur = current.select(*keys, F.struct(*values).alias("_cur"))
    old = stored.select(*keys, F.struct(*values, "first_seen", "last_seen").alias("_old"))
    present = F.col("_cur").isNotNull()
    return cur.join(old, list(keys), "full").select(
        *keys,
        *[F.when(present, F.col(f"_cur.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values],
        F.coalesce(F.col("_old.first_seen"), F.lit(now)).alias("first_seen"),
        F.when(present, F.lit(now)).otherwise(F.col("_old.last_seen")).alias("last_seen"),
    )


def options_of(schema_rows: DataFrame) -> DataFrame:
    """O-J5: one row per option of select, multi-select and status properties; a status
    option has the group that lists its id, the others none. The arrays live in one
    property row, so the group is found in that row, without a join."""
    option = "array<struct<id string,name string>>"
    group = "array<struct<name string,option_ids array<string>>>"
    kind = F.col("property_type")

    def member(path: str, shape: str):
        return F.coalesce(
            *[F.when(kind == t, F.try_variant_get("definition", f"$.{t}.{path}", shape)) for t in ("select", "multi_select", "status")]
        )

    listed = schema_rows.where(kind.isin("select", "multi_select", "status")).select(
        "table_name",
        "property_id",
        F.explode(member("options", option)).alias("_o"),
        F.when(kind == "status", F.try_variant_get("definition", "$.status.groups", group)).alias("_groups"),
    )
    # The last group that lists the id, as a later assignment overrides an earlier one.
    owner = F.filter("_groups", lambda g: F.array_contains(g["option_ids"], F.col("_o.id")))
    return listed.select(
        "table_name",
        "property_id",
        F.col("_o.id").alias("option_id"),
        F.col("_o.name").alias("option_name"),
        F.when(F.size(owner) > 0, F.element_at(owner, -1)["name"]).alias("option_group"),
    )


# -- column operations -----------------------------------------------------------------


def rename_families(
    pages: DataFrame, changes: DataFrame, renames: Sequence[tuple[str, str]]
) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """O-E3: the properties were renamed, so all columns they own and their history move, all
    at once: a swap or a chain of names mixes nothing. A target that exists and does not move
    away itself is filled where it is NULL. Returns the moves of stored columns too."""
    family = {o: n for old, new in renames for o, n in zip(column_family(old), column_family(new)) if o != n}
    moves = {o: n for o, n in family.items() if o in pages.columns}
    if not moves:
        return pages, changes, {}
    types = {f.name: f.dataType for f in pages.schema}
    sources: dict[str, list[str]] = {}
    for o, n in moves.items():
        sources.setdefault(n, []).append(o)
    stays = [c for c in pages.columns if c not in moves]
    clash = [n for n in sources if n in stays]
    if clash:
        log.warning("rename target exists, filling its NULLs: %s", clash)
    columns = []
    for c in pages.columns:
        name = moves.get(c, c)
        kind = types[name] if name in stays else types[sources[name][0]] if name in sources else types[c]
        parts = ([F.col(name)] if name in stays else []) + [F.col(o).cast(kind) for o in sources.get(name, [])]
        if c in stays or (name not in stays and sources[name][0] == c):
            columns.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(name))
    return pages.select(*columns), history.rename_fields(changes, moves), moves


def rename_family(pages: DataFrame, changes: DataFrame, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """O-E3 for a single property."""
    pages, changes, _ = rename_families(pages, changes, [(old, new)])
    return pages, changes


def apply_declared_rename(
    pages: DataFrame, changes: DataFrame, old: str, new: str
) -> tuple[DataFrame, DataFrame, bool]:
    """O-E4: fills the new columns from the old ones where they are NULL and renames the
    history; the old columns stay. Nothing happens when the old ones are not there."""
    moves = {o: n for o, n in zip(column_family(old), column_family(new)) if o in pages.columns and o != n}
    if not moves:
        return pages, changes, False
    filled = {}
    for o, n in moves.items():
        filled[n] = F.coalesce(F.col(n), F.col(o).cast(pages.schema[n].dataType)) if n in pages.columns else F.col(o)
    return pages.withColumns(filled), history.rename_fields(changes, moves), True


def backup_name(column: str, date_str: str, taken: Sequence[str]) -> str:
    """O-E5: ``{column}_bak_{YYYYMMDD}``, numbered from 2 when that is taken."""
    base = f"{column}_bak_{date_str}"
    number, name = 1, base
    while name in taken:
        number += 1
        name = f"{base}_{number}"
    return name


def backup_family(pages: DataFrame, column: str, prop_type: str, date_str: str) -> tuple[DataFrame, dict[str, str]]:
    """O-E5: sets a property's columns aside; a property without stored columns has
    nothing to set aside. Returns the renames made."""
    renames: dict[str, str] = {}
    for c in column_family(column, prop_type):
        if c in pages.columns:
            renames[c] = backup_name(c, date_str, [*pages.columns, *renames.values()])
    return pages.withColumnsRenamed(renames), renames


def restore_family(pages: DataFrame, backups: Mapping[str, str]) -> tuple[DataFrame, bool]:
    """O-E6: drops the interim columns and brings the backups (column -> backup) back.
    False when a backup is gone, so its registry entry is stale."""
    usable = {b: c for c, b in backups.items() if b in pages.columns}
    if not usable or len(usable) < len(backups):
        return pages, False
    return pages.drop(*usable.values()).withColumnsRenamed(usable), True


# -- the evolution of one table ----------------------------------------------------------


@dataclass
class Evolution:
    """Evolved tables with the registry entries and messages the evolution left."""

    pages: DataFrame
    changes: DataFrame
    backups: dict[tuple[str, str], str] = field(default_factory=dict)  # (column, type) -> backup column
    messages: list[str] = field(default_factory=list)
    changed_pages: bool = False
    moved_fields: bool = False


def evolve(
    pages: DataFrame,
    changes: DataFrame,
    diff: Sequence[Mapping],
    backups: Mapping[tuple[str, str], str],
    now: str,
) -> Evolution:
    """Applies a schema diff (rows of ``schema_diff``) to the tables of one database.

    Everything stays lazy; the result is only published by the caller, so a dry run
    (O-E13) is a call whose result is not published.
    """
    out = Evolution(pages, changes, dict(backups))
    rows = sorted(diff, key=lambda r: (r["new_column"] or r["old_column"], r["property_id"]))
    renamed = []
    for row in rows:
        status, old, new = row["status"], row["old_column"], row["new_column"]
        if status == "disappeared":
            out.messages.append(f"column '{old}' ('{row['old_name']}') is no longer in the schema; its data is kept")
        if "renamed" in status and old != new:
            renamed.append((old, new))
            out.messages.append(f"renamed '{row['old_name']}' to '{row['new_name']}' (column '{old}' to '{new}')")
    if renamed:
        out.pages, out.changes, moves = rename_families(out.pages, out.changes, renamed)
        out.changed_pages = out.moved_fields = bool(moves)
        family = {o: n for old, new in renamed for o, n in zip(column_family(old), column_family(new))}
        out.backups = {(family.get(c, c), t): b for (c, t), b in out.backups.items()}
    for row in rows:
        if "type_changed" in row["status"]:
            _retype(out, row, row["new_column"], now)
    return out


def _retype(out: Evolution, row: Mapping, column: str, now: str) -> None:
    old_type, new_type = row["old_type"], row["new_type"]
    kept = {c: b for (c, t), b in out.backups.items() if t == new_type and c in column_family(column, new_type)}
    if kept:
        restored, done = restore_family(out.pages.drop(*[c for c in column_family(column, old_type) if c not in kept]), kept)
        out.backups = {k: b for k, b in out.backups.items() if b not in kept.values()}
        if done:
            out.pages, out.changed_pages = restored, True
            out.messages.append(f"type of '{row['new_name']}' went back to '{new_type}'; restored {sorted(kept.values())}")
            return
    out.pages, renames = backup_family(out.pages, column, old_type, now[:10].replace("-", ""))
    out.backups.update({(c, old_type): b for c, b in renames.items()})
    out.changed_pages = out.changed_pages or bool(renames)
    out.messages.append(
        f"type of '{row['new_name']}' changed from '{old_type}' to '{new_type}'; old data kept in {sorted(renames.values())}"
    )
