"""Task pages, their earlier state and their histories, derived from the driver's tables.

Edits are decided by the values of a row, so both engines derive the same states.
Every ``*_SQL`` text below defines what the function beside it returns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.session import scratch_dir
from fieldtrail.sources.tables import Tables

RUN_TS = "2024-02-01T00:00:00+00:00"
#: Orders placed before this day were known to the previous run.
KNOWN_BEFORE = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_tables(spark: SparkSession, label: str) -> Tables:
    """Tables of a database of its own, in the shared scratch folder."""
    path = scratch_dir(spark, label)
    return Tables(spark, re.sub(r"\W", "_", path.rsplit("/", 1)[-1]), path)


def iso(ts: Column) -> Column:
    """Timestamp as UTC ISO text."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _task(status: Column, price: Column, due: Column, priority: Column, urgent: Column) -> list[Column]:
    day = F.col("o_orderdate")
    return [
        F.col("o_orderkey").cast("string").alias("page_id"),
        iso(day).alias("created_time"),
        iso(day + F.expr("interval 1 day")).alias("last_edited_time"),
        F.concat(F.lit("https://pages.example/"), F.col("o_orderkey")).alias("url"),
        status.alias("status"),
        F.concat(F.lit("opt_"), F.lower(status)).alias("status_id"),
        price.alias("total_price"),
        F.date_format(due, "yyyy-MM-dd").alias("due_date_start"),
        F.lit(None).cast("string").alias("due_date_end"),
        F.substr(priority, F.lit(3)).alias("priority"),
        F.substring(priority, 1, 1).alias("priority_id"),
        urgent.alias("is_urgent"),
    ]


def tasks_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of every task: expensive ones closed, low ones re-priced, pending
    ones moved by three days, cheap ones without a priority."""
    total, prio = F.col("o_totalprice"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        *_task(
            F.when(total > 400000, F.lit("F")).otherwise(F.col("o_orderstatus")),
            F.when(prio == "5-LOW", total + 10).otherwise(total),
            F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("interval 3 days")).otherwise(
                F.col("o_orderdate")
            ),
            F.when(total >= 20000, prio),
            prio == "1-URGENT",
        )
    )


def tasks_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State stored by the previous run; the flag was stored as text then."""
    prio = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderdate") < F.lit(KNOWN_BEFORE).cast("timestamp_ntz"))
        .select(
            *_task(
                F.col("o_orderstatus"),
                F.col("o_totalprice"),
                F.col("o_orderdate"),
                prio,
                F.when(prio == "1-URGENT", F.lit("1")).otherwise(F.lit("0")),
            )
        )
    )


_TASK_SQL = """
  SELECT CAST(o_orderkey AS VARCHAR) AS page_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_time,
         strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS last_edited_time,
         'https://pages.example/' || o_orderkey AS url,
         {status} AS status, 'opt_' || lower({status}) AS status_id,
         {price} AS total_price,
         strftime({due}, '%Y-%m-%d') AS due_date_start, CAST(NULL AS VARCHAR) AS due_date_end,
         substr({prio}, 3) AS priority, substr({prio}, 1, 1) AS priority_id,
         {urgent} AS is_urgent
  FROM orders {where}"""

TASKS_NOW_SQL = _TASK_SQL.format(
    status="(CASE WHEN o_totalprice > 400000 THEN 'F' ELSE o_orderstatus END)",
    price="(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 10 ELSE o_totalprice END)",
    due="(CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 3 DAY ELSE o_orderdate END)",
    prio="(CASE WHEN o_totalprice >= 20000 THEN o_orderpriority END)",
    urgent="(o_orderpriority = '1-URGENT')",
    where="",
)
TASKS_BEFORE_SQL = _TASK_SQL.format(
    status="o_orderstatus",
    price="o_totalprice",
    due="o_orderdate",
    prio="o_orderpriority",
    urgent="(CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END)",
    where=f"WHERE o_orderdate < TIMESTAMP '{KNOWN_BEFORE}'",
)
TASK_CTES = f"now_t AS ({TASKS_NOW_SQL}), before_t AS ({TASKS_BEFORE_SQL})"

#: (field, SQL text of its canonical value) in column order, as the diff tracks them.
TASK_FIELDS = {
    "page_id": "page_id",
    "created_time": "created_time",
    "status": "status",
    "total_price": "CAST(total_price AS VARCHAR)",
    "due_date_start": "due_date_start",
    "due_date_end": "due_date_end",
    "priority": "priority",
    "is_urgent": "CAST(CAST(is_urgent AS INTEGER) AS VARCHAR)",
}


def changes_sql(now: str = "now_t", before: str = "before_t", run_ts: str = RUN_TS) -> str:
    """The change records between two task states, one SELECT per field."""
    parts = []
    for field, text in TASK_FIELDS.items():
        has_id = field in ("status", "priority")
        old_id, new_id = (f"p.{field}_id", f"n.{field}_id") if has_id else ("CAST(NULL AS VARCHAR)",) * 2
        old = text.replace(field, f"p.{field}").replace("due_date_p.", "")
        new = text.replace(field, f"n.{field}")
        parts.append(
            f"""SELECT sha256(concat_ws('|', n.page_id, '{field}', '{run_ts}')) AS id, n.page_id AS page_id,
  '{field}' AS field, {old} AS old_value, {new} AS new_value, {old_id} AS old_value_id, {new_id} AS new_value_id,
  CASE WHEN p.page_id IS NULL THEN n.created_time ELSE '{run_ts}' END AS valid_from, '{run_ts}' AS detected_at
FROM {now} n LEFT JOIN {before} p ON p.page_id = n.page_id
WHERE p.page_id IS NULL OR {old} IS DISTINCT FROM {new}"""
        )
    return "\nUNION ALL\n".join(parts)


# --- history: one status event per row; page = user, value = event type -------------------

OPEN_STATUSES = ("click", "view", "signup")


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")


#: The change log of the events: a record where the type differs from the one before.
EVENT_LOG_CTE = """log_t AS (
  SELECT CAST(user_id AS VARCHAR) AS page_id, ts, event_id, prev IS NULL AS is_initial, 'status' AS field,
         prev AS old_value, event_type AS new_value
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
  WHERE prev IS DISTINCT FROM event_type)"""
