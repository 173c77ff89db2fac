"""Data-quality checks and counts (O-Q1, O-A3, O-A5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared checks of the staging models.
STAGING_CHECKS: dict[str, dict[str, tuple[str, ...]]] = {
    "stg_tasks": {"page_id": ("not_null", "unique"), "created_time": ("not_null",), "last_edited_time": ("not_null",)},
    "stg_task_changes": {
        "id": ("not_null", "unique"), "page_id": ("not_null",), "field": ("not_null",), "detected_at": ("not_null",),
    },
    "stg_job_applications": {"page_id": ("not_null", "unique")},
    "stg_job_application_changes": {"id": ("not_null", "unique"), "page_id": ("not_null",), "detected_at": ("not_null",)},
    "stg_pursuits": {"page_id": ("not_null", "unique")},
}


def check_model(model: str, df: DataFrame, checks: Mapping[str, Sequence[str]]) -> DataFrame:
    """O-Q1: (model, column, test, failures), all tests of a model in one scan and one shuffle.

    A ``unique`` test counts the values that occur more than once. Each such column is a
    grouping set, so rows are expanded and combined within a task before they move; the
    ``not_null`` counts ride along with the first set.
    """
    null_cols = [c for c, tests in checks.items() if "not_null" in tests]
    unique_cols = [c for c, tests in checks.items() if "unique" in tests]
    nulls = {f"_null_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(null_cols)}
    if unique_cols:
        own = {f"_other_{i}": F.grouping(c) for i, c in enumerate(unique_cols)}
        grouped = df.groupingSets([[F.col(c)] for c in unique_cols], *[F.col(c) for c in unique_cols]).agg(
            F.count(F.lit(1)).alias("_n"), *[e.alias(name) for name, e in {**own, **nulls}.items()]
        )
        first = F.col("_other_0") == 0
        sums = [F.coalesce(F.sum(F.when(first, F.col(name))), F.lit(0)).alias(name) for name in nulls]
        sums += [
            F.count_if((F.col(f"_other_{i}") == 0) & F.col(c).isNotNull() & (F.col("_n") > 1)).alias(f"_repeated_{i}")
            for i, c in enumerate(unique_cols)
        ]
        counted = grouped.agg(*sums)
    else:
        counted = df.agg(*[e.alias(name) for name, e in nulls.items()])
    results = [(c, "not_null", f"_null_{i}") for i, c in enumerate(null_cols)]
    results += [(c, "unique", f"_repeated_{i}") for i, c in enumerate(unique_cols)]
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(test).alias("test"), F.col(name).alias("failures"))
        for c, test, name in results
    ]
    return counted.select(F.inline(F.array(*rows))).select(F.lit(model).alias("model"), "column", "test", "failures")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """O-A3: one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def distinct_fields(changes: DataFrame) -> DataFrame:
    """O-A5."""
    return changes.select("field").distinct()
