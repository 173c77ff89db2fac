"""Queries of the change-tracking core."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions.canon import canonical_text
from fieldtrail.functions.names import excluded_fields, expand_split_dates
from fieldtrail.operators import diff, skew
from fieldtrail.workload import query
from fieldtrail.workload.tables import (
    EVENT_LOG_CTE,
    RUN_TS,
    TASK_CTES,
    changes_sql,
    status_events,
    table,
    tasks_before,
    tasks_now,
)


def task_changes(spark, sf_dir):
    return diff.detect_changes(tasks_now(spark, sf_dir), tasks_before(spark, sf_dir), RUN_TS)


def hot_users(spark, sf_dir):
    """The hot keys of the events, counted once per query for all that is derived from them."""
    return skew.hot_keys_if_any(status_events(spark, sf_dir).select(F.col("user_id").cast("string").alias("page_id")), ["page_id"])


def event_log(spark, sf_dir, hot=skew.COUNT):
    return diff.change_log(status_events(spark, sf_dir), "user_id", ["ts", "event_id"], {"status": "event_type"}, hot)


@query("field_changes", f"WITH {TASK_CTES}\n{changes_sql()}")
def field_changes(spark, sf_dir):
    """O-C1, O-C2, O-J1, O-F1, O-F2, O-U1, O-P9, O-P18."""
    return task_changes(spark, sf_dir)


@query("change_log_lag", f"WITH {EVENT_LOG_CTE} SELECT * FROM log_t")
def change_log_lag(spark, sf_dir):
    """O-C3."""
    return event_log(spark, sf_dir)


@query(
    "tracked_subset",
    f"WITH {TASK_CTES}, c AS ({changes_sql()}) SELECT * FROM c WHERE field IN ('status', 'due_date_start', 'due_date_end')",
)
def tracked_subset(spark, sf_dir):
    """O-F1, O-F3, O-U1: an allowlist with a split date, and exclusions that still apply."""
    now = tasks_now(spark, sf_dir)
    wanted = expand_split_dates(["status", "due_date", "priority"], now.columns)
    unwanted = excluded_fields(["Priority"], ["status_id", "priority_id"])
    return diff.detect_changes(now, tasks_before(spark, sf_dir), RUN_TS, wanted, unwanted)


@query(
    "canonical_text",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS quantity, CAST(l_extendedprice AS VARCHAR) AS price,
  CAST(l_extendedprice * 1048576.0 AS VARCHAR) AS large, CAST(l_discount / 1024.0 AS VARCHAR) AS small,
  CAST(l_quantity / 1048576.0 AS VARCHAR) AS tiny, CAST(l_quantity * 18014398509481984.0 AS VARCHAR) AS huge,
  CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS flag, CAST(l_linenumber AS VARCHAR) AS line
FROM lineitem""",
)
def canonical_texts(spark, sf_dir):
    """O-P9: numbers of every size, booleans, integers."""
    double, text = T.DoubleType(), canonical_text
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text(F.col("l_quantity"), double).alias("quantity"),
        text(F.col("l_extendedprice"), double).alias("price"),
        text(F.col("l_extendedprice") * 1048576.0, double).alias("large"),
        text(F.col("l_discount") / 1024.0, double).alias("small"),
        text(F.col("l_quantity") / 1048576.0, double).alias("tiny"),
        text(F.col("l_quantity") * 18014398509481984.0, double).alias("huge"),
        text(F.col("l_returnflag") == "A", T.BooleanType()).alias("flag"),
        text(F.col("l_linenumber"), T.IntegerType()).alias("line"),
    )
