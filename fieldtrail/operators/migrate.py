"""Column migrations of the pages table (O-P15 to O-P17, O-E12, O-E13, O-F4, O-L1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions import canon
from fieldtrail.functions.dates import looks_like_date, range_end, range_start
from fieldtrail.functions.names import SYSTEM_COLUMNS


def value_map_for(new_type: str, value_map: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """The given map, or the text booleans when an INTEGER migration has none."""
    if value_map or new_type != "INTEGER":
        return list(value_map)
    return list(canon.TEXT_BOOLEANS)


def migrate_columns(
    pages: DataFrame, columns: Sequence[str], new_type: str, value_map: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """O-P16: retypes the listed columns that exist; all others pass unchanged."""
    types = {f.name: f.dataType for f in pages.schema}
    return pages.withColumns(
        {c: canon.migrated_value(F.col(c), types[c], new_type, value_map) for c in columns if c in types}
    )


def migration_impact(
    pages: DataFrame, columns: Sequence[str], new_type: str, value_map: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """O-E13: what the migration would do, per column: rows whose text changes, and rows
    that would read as zero without holding one."""
    types = {f.name: f.dataType for f in pages.schema}
    spark_type = {"INTEGER": T.LongType(), "REAL": T.DoubleType(), "TEXT": T.StringType()}[new_type]
    aggs, present = [], [c for c in columns if c in types]
    if not present:
        return pages.sparkSession.createDataFrame([], "column_name string, changed_rows long, zeroed_rows long")
    for c in present:
        text = canon.canonical_text(F.col(c), types[c])
        new = canon.canonical_text(canon.migrated_value(F.col(c), types[c], new_type, value_map), spark_type)
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(~text.eqNullSafe(new)).alias("changed_rows"),
                F.count_if(new.isin("0", "0.0") & text.try_cast("double").isNull()).alias("zeroed_rows"),
            )
        )
    return pages.agg(F.array(*aggs).alias("_impact")).select(F.inline("_impact"))


def split_date_columns(pages: DataFrame, columns: Sequence[str]) -> DataFrame:
    """O-P17: each listed column that exists becomes its ``_start`` and ``_end``."""
    present = [c for c in columns if c in pages.columns]
    halves = {}
    for c in present:
        halves[f"{c}_start"], halves[f"{c}_end"] = range_start(F.col(c)), range_end(F.col(c))
    return pages.withColumns(halves).drop(*present) if present else pages


def split_impact(pages: DataFrame, changes: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """O-E13 of O-P17 and O-C5: per table and column what a split would do: values set in the
    start and in the end column of the pages, rows added to and removed from the history.
    Columns the pages do not have are not listed; nor are fields without records."""
    present = [c for c in columns if c in pages.columns]
    shape = "table_name string, column_name string, values_set long, rows_added long, rows_removed long"
    spark = pages.sparkSession
    nothing = F.lit(0).cast("long")
    out = spark.createDataFrame([], shape)
    if present:
        per_column = [
            F.struct(
                F.lit("pages").alias("table_name"), F.lit(c).alias("column_name"),
                (F.count(range_start(F.col(c))) + F.count(range_end(F.col(c)))).alias("values_set"),
                nothing.alias("rows_added"), nothing.alias("rows_removed"),
            )
            for c in present
        ]
        out = pages.agg(F.array(*per_column).alias("_impact")).select(F.inline("_impact"))
    if changes is None:
        return out
    counted = changes.where(F.col("field").isin(*columns)).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(counted.select(
        F.lit("changes").alias("table_name"), F.col("field").alias("column_name"), nothing.alias("values_set"),
        (F.col("n") * 2).alias("rows_added"), F.col("n").alias("rows_removed"),
    ))


def date_candidates(pages: DataFrame) -> list[str]:
    """Text columns that are neither system columns nor halves of a split date."""
    return [
        f.name
        for f in pages.schema
        if isinstance(f.dataType, T.StringType)
        and f.name not in SYSTEM_COLUMNS
        and not f.name.endswith(("_start", "_end"))
    ]


def detect_date_columns(pages: DataFrame) -> DataFrame:
    """O-E12, O-L1: the candidates whose first non-empty value (by page id, so the choice
    does not depend on row order) starts like a date, with that sample. One aggregation
    for all columns."""
    candidates = date_candidates(pages)
    shape = "column_name string, sample string"
    if not candidates:
        return pages.sparkSession.createDataFrame([], shape)
    samples = pages.agg(
        *[F.min_by(F.col(c), F.when(F.col(c) != "", F.col("page_id"))).alias(c) for c in candidates]
    )
    listed = samples.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("sample")) for c in candidates]))
    )
    return listed.where(looks_like_date(F.col("sample")))
