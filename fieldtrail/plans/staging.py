"""Typed staging views over the raw text tables (O-P11 to O-P14).

Each model replaces the listed columns in place and lets every other column through, so
new properties appear without a change here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.functions.dates import to_date, to_timestamp


def replace_columns(df: DataFrame, replacements: Mapping[str, Column]) -> DataFrame:
    """O-P11: retypes columns at their place; a name that is not there is an error."""
    missing = sorted(set(replacements) - set(df.columns))
    if missing:
        raise ValueError(f"cannot replace missing columns: {', '.join(missing)}")
    return df.withColumns(dict(replacements))


def _typed(df: DataFrame, timestamps: Sequence[str] = (), dates: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    return replace_columns(
        df,
        {
            **{c: to_timestamp(F.col(c)) for c in timestamps},
            **{c: to_date(F.col(c)) for c in dates},
            **{c: F.col(c).cast("boolean") for c in flags},
        },
    )


_EDITED = ("created_time", "last_edited_time")
_DETECTED = ("valid_from", "detected_at")


def stg_tasks(pages: DataFrame) -> DataFrame:
    return _typed(pages, _EDITED, ("due_date_start", "due_date_end", "closed_date_start", "closed_date_end"))


def stg_changes(changes: DataFrame) -> DataFrame:
    """Task and job-application changes alike."""
    return _typed(changes, _DETECTED)


def stg_job_applications(pages: DataFrame) -> DataFrame:
    dates = (
        "applied_date_start", "applied_date_end", "follow_up_date_start", "follow_up_date_end", "last_follow_up",
    )
    return _typed(pages, _EDITED, dates, ("resume", "cover_letter"))


def stg_pursuits(pages: DataFrame) -> DataFrame:
    return _typed(pages, _EDITED)
