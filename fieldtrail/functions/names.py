"""Column names and column-name lists (O-P1, O-F3, O-U1, O-U2, O-E9).

The list functions run on the driver: their size is the number of columns of one table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns every pages table owns, the property types never stored,
# and the property types that carry an option id next to the option name.
SYSTEM_COLUMNS = ("page_id", "created_time", "last_edited_time", "url", "content_text")
SKIPPED_TYPES = ("created_by", "last_edited_by")
OPTION_TYPES = ("select", "status", "multi_select")


def column_name(name: str) -> str:
    """O-P1 for one property name: words joined by ``_``, lower case, never digit-first or empty."""
    words = [word for word in re.split(r"[\W_]+", name) if word]
    joined = "_".join(words).lower()
    if not joined:
        return "col"
    return "_" + joined if joined[0].isdigit() else joined


def column_name_of(name: Column) -> Column:
    """O-P1 as a column expression, for property names that are data."""
    joined = F.lower(F.btrim(F.regexp_replace(name, r"[^\p{L}\p{N}]+", "_"), F.lit("_")))
    return (
        F.when(name.isNull(), F.lit(None))
        .when(joined == "", F.lit("col"))
        .when(joined.rlike(r"^[\p{Nd}\p{No}]"), F.concat(F.lit("_"), joined))
        .otherwise(joined)
    )


def column_family(base: str, prop_type: str | None = None) -> list[str]:
    """Every column a property may own; the base alone does not exist for dates."""
    if prop_type == "date":
        return [f"{base}_start", f"{base}_end"]
    if prop_type in OPTION_TYPES:
        return [base, f"{base}_id"]
    if prop_type is not None:
        return [base]
    return [base, f"{base}_id", f"{base}_start", f"{base}_end"]


def shadow_id_columns(properties: Iterable) -> list[str]:
    """O-E9: the option-id columns of select, status and multi-select properties."""
    return [f"{p.column}_id" for p in properties if p.type in OPTION_TYPES]


def expand_split_dates(fields: Sequence[str], columns: Iterable[str]) -> list[str]:
    """O-F3: a date field that was split is replaced by whichever halves exist; idempotent."""
    present = set(columns)
    out: list[str] = []
    for field in fields:
        halves = [h for h in (f"{field}_start", f"{field}_end") if h in present]
        out.extend([field] if field in present or not halves else halves)
    return out


def excluded_fields(configured: Iterable[str], shadows: Iterable[str]) -> list[str]:
    """O-U1: configured exclusions (property names) joined with the option-id columns."""
    return sorted({column_name(name) for name in configured} | set(shadows))


def merge_column_lists(detected: Sequence[str], excluded: Iterable[str], explicit: Sequence[str]) -> list[str]:
    """O-U2: detected minus excluded, then the explicit ones, first mention wins."""
    dropped = set(excluded)
    return list(dict.fromkeys([c for c in detected if c not in dropped] + list(explicit)))
