"""Columns no property owns any more (O-J4, O-A1, O-A2, O-L3, O-E11, O-C8, O-E13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.functions.names import SYSTEM_COLUMNS
from fieldtrail.operators import history


def find_orphans(columns: DataFrame, registry: DataFrame, backups: DataFrame, strict: bool = True) -> DataFrame:
    """O-J4: (table_name, column_name) pairs that are no system column, no registered
    column, no registered backup and no ``_id``/``_start``/``_end`` part of a registered
    column. With ``strict=False`` a property not seen by its table's last run does not
    count as registered. Order the result by name for a listing (O-L3)."""
    if not strict:
        newest = registry.groupBy("table_name").agg(F.max("last_seen").alias("_newest"))
        registry = registry.join(newest, "table_name").where(F.col("last_seen") == F.col("_newest"))
    owned = registry.select("table_name", F.col("column_name").alias("_owned")).distinct()
    kept = backups.select("table_name", F.col("backup_column").alias("column_name"))
    base = F.regexp_replace("column_name", r"(_id|_start|_end)$", "")
    return (
        columns.where(~F.col("column_name").isin(*SYSTEM_COLUMNS))
        .join(owned.withColumnRenamed("_owned", "column_name"), ["table_name", "column_name"], "left_anti")
        .join(kept, ["table_name", "column_name"], "left_anti")
        .withColumn("_owned", base)
        .join(owned, ["table_name", "_owned"], "left_anti")
        .select("table_name", "column_name")
    )


def orphan_impact(pages: DataFrame, changes: DataFrame, orphans: Sequence[str]) -> DataFrame:
    """O-A1, O-A2: per orphan its non-null page rows and its change records (0 if none).
    One pass over the pages for all columns, one grouped pass over the history. This is
    also what a dry run of the drop reports."""
    orphans = sorted(orphans)
    if not orphans:
        return pages.sparkSession.createDataFrame([], "column_name string, non_null_rows long, change_rows long")
    counts = pages.agg(*[F.count(c).alias(c) for c in orphans])
    per_column = counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null_rows")) for c in orphans]))
    )
    records = (
        changes.where(F.col("field").isin(*orphans)).groupBy(F.col("field").alias("column_name")).agg(
            F.count(F.lit(1)).alias("change_rows")
        )
    )
    return per_column.join(records, "column_name", "left").withColumn(
        "change_rows", F.coalesce("change_rows", F.lit(0).cast("long"))
    )


def drop_orphans(
    pages: DataFrame, changes: DataFrame, registry: DataFrame, table: str, orphans: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """O-E11: the columns, their history and their registry rows go together; publish the
    three results in one version."""
    gone = F.col("table_name").eqNullSafe(table) & F.col("column_name").isin(*orphans)
    return pages.drop(*orphans), history.delete_fields(changes, orphans), registry.where(~gone)
