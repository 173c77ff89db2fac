"""Queries over staged tables: staging views, quality checks, interval tables and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.operators import diff, quality, skew
from fieldtrail.plans import marts, staging
from fieldtrail.session import scratch_dir
from fieldtrail.workload import ORACLE, query
from fieldtrail.workload.changes import event_log, hot_users, task_changes
from fieldtrail.workload.tables import (
    EVENT_LOG_CTE,
    OPEN_STATUSES,
    TASK_CTES,
    changes_sql,
    iso,
    table,
    tasks_now,
)


def _naive(df):
    """Timestamps without a zone, as the tables and the SQL have them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


# --- staging -----------------------------------------------------------------------------


def _spelled(day, status):
    """A day in the spellings a date arrives in: plain, late in the day with an offset
    (so it is the next day in UTC), not a date, or a year alone."""
    text = F.date_format(day, "yyyy-MM-dd")
    return (
        F.when(status == "P", F.concat(text, F.lit("T22:00:00.000-05:00")))
        .when(status == "O", text)
        .otherwise(F.when(F.month(day) == 1, F.lit("2026")).when(F.month(day) == 2, F.lit("2026-08")).otherwise(F.lit("soon")))
    )


_SPELLED_SQL = """CASE WHEN o_orderstatus = 'P' THEN CAST({day} AS DATE) + 1
  WHEN o_orderstatus = 'O' THEN CAST({day} AS DATE) END"""


def _raw_orders(spark, sf_dir, **columns):
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("page_id"),
        iso(day).alias("created_time"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'").alias("last_edited_time"),
        F.col("o_orderpriority").alias("status"),
        *[c.alias(name) for name, c in columns.items()],
    )


_STAGED_SQL = """CAST(o_orderkey AS VARCHAR) AS page_id, o_orderdate AS created_time,
  o_orderdate - INTERVAL 2 HOUR AS last_edited_time, o_orderpriority AS status"""


@query(
    "stg_tasks",
    f"""SELECT {_STAGED_SQL}, {_SPELLED_SQL.format(day="o_orderdate")} AS due_date_start, CAST(NULL AS DATE) AS due_date_end,
  {_SPELLED_SQL.format(day="o_orderdate + INTERVAL 9 DAY")} AS closed_date_start, CAST(NULL AS DATE) AS closed_date_end,
  o_custkey AS extra FROM orders""",
)
def stg_tasks(spark, sf_dir):
    """O-P11, O-P12, O-P13."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    return _naive(
        staging.stg_tasks(
            _raw_orders(
                spark,
                sf_dir,
                due_date_start=_spelled(day, status),
                due_date_end=F.lit(""),
                closed_date_start=_spelled(day + F.expr("interval 9 days"), status),
                closed_date_end=F.lit(None).cast("string"),
                extra=F.col("o_custkey"),
            )
        )
    )


@query(
    "stg_job_applications",
    f"""SELECT {_STAGED_SQL}, {_SPELLED_SQL.format(day="o_orderdate")} AS applied_date_start, CAST(NULL AS DATE) AS applied_date_end,
  CAST(o_orderdate AS DATE) AS follow_up_date_start, CAST(NULL AS DATE) AS follow_up_date_end,
  {_SPELLED_SQL.format(day="o_orderdate")} AS last_follow_up,
  o_orderpriority = '1-URGENT' AS resume, o_orderstatus = 'O' AS cover_letter FROM orders""",
)
def stg_job_applications(spark, sf_dir):
    """O-P11 to O-P14."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    nothing = F.lit(None).cast("string")
    return _naive(
        staging.stg_job_applications(
            _raw_orders(
                spark,
                sf_dir,
                applied_date_start=_spelled(day, status),
                applied_date_end=nothing,
                follow_up_date_start=F.date_format(day, "yyyy-MM-dd"),
                follow_up_date_end=nothing,
                last_follow_up=_spelled(day, status),
                resume=(F.col("o_orderpriority") == "1-URGENT").cast("int"),
                cover_letter=(status == "O").cast("int"),
            )
        )
    )


@query(
    "stg_pursuits",
    """SELECT CAST(c_custkey AS VARCHAR) AS page_id, TIMESTAMP '2024-01-01' + to_days(c_nationkey) AS created_time,
  CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2024-01-01' + to_days(c_nationkey) END AS last_edited_time,
  c_mktsegment AS area FROM customer""",
)
def stg_pursuits(spark, sf_dir):
    """O-P11, O-P12."""
    text = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd")
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("page_id"),
        F.concat(text, F.lit("T00:00:00Z")).alias("created_time"),
        F.when(F.col("c_acctbal") > 0, text).otherwise("n/a").alias("last_edited_time"),
        F.col("c_mktsegment").alias("area"),
    )
    return _naive(staging.stg_pursuits(raw))


@query(
    "stg_changes",
    f"""WITH {TASK_CTES}, c AS ({changes_sql()})
SELECT * REPLACE (CAST(replace(substr(valid_from, 1, 19), 'T', ' ') AS TIMESTAMP) AS valid_from,
  TIMESTAMP '2024-02-01' AS detected_at) FROM c""",
)
def stg_changes(spark, sf_dir):
    """O-P11, O-P12: moments spelled with Z and with an offset."""
    return _naive(staging.stg_changes(task_changes(spark, sf_dir)))


# --- quality -----------------------------------------------------------------------------


@query(
    "dq_checks",
    f"""WITH {TASK_CTES}, c AS ({changes_sql()})
SELECT 'lines' AS model, 'l_shipdate' AS "column", 'not_null' AS test, count(*) FILTER (WHERE l_shipdate IS NULL) AS failures FROM lineitem
UNION ALL SELECT 'lines', 'l_orderkey', 'unique', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_tasks', 'page_id', 'not_null', count(*) FILTER (WHERE page_id IS NULL) FROM now_t
UNION ALL SELECT 'stg_tasks', 'priority', 'not_null', count(*) FILTER (WHERE priority IS NULL) FROM now_t
UNION ALL SELECT 'stg_tasks', 'page_id', 'unique', count(*) FROM (SELECT page_id FROM now_t GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_tasks', 'priority', 'unique', count(*) FROM (SELECT priority FROM now_t WHERE priority IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_task_changes', 'id', 'not_null', 0
UNION ALL SELECT 'stg_task_changes', 'page_id', 'not_null', 0
UNION ALL SELECT 'stg_task_changes', 'field', 'not_null', 0
UNION ALL SELECT 'stg_task_changes', 'detected_at', 'not_null', 0
UNION ALL SELECT 'stg_task_changes', 'id', 'unique', count(*) FROM (SELECT id FROM c GROUP BY 1 HAVING count(*) > 1)""",
)
def dq_checks(spark, sf_dir):
    """O-Q1."""
    lines = quality.check_model("lines", table(spark, sf_dir, "lineitem"), {"l_shipdate": ("not_null",), "l_orderkey": ("unique",)})
    both = ("not_null", "unique")
    tasks = quality.check_model("stg_tasks", tasks_now(spark, sf_dir), {"page_id": both, "priority": both})
    name = "stg_task_changes"
    changes = quality.check_model(name, task_changes(spark, sf_dir), quality.STAGING_CHECKS[name])
    return lines.unionByName(tasks).unionByName(changes)


@query(
    "dq_staging",
    f"""WITH {TASK_CTES}, c AS ({changes_sql()}),
j AS (SELECT o_custkey AS page_id FROM orders), p AS (SELECT CAST(c_custkey AS VARCHAR) AS page_id FROM customer)
SELECT 'stg_tasks' AS model, 'page_id' AS "column", 'not_null' AS test, count(*) FILTER (WHERE page_id IS NULL) AS failures FROM now_t
UNION ALL SELECT 'stg_tasks', 'page_id', 'unique', count(*) FROM (SELECT page_id FROM now_t GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_tasks', 'created_time', 'not_null', count(*) FILTER (WHERE created_time IS NULL) FROM now_t
UNION ALL SELECT 'stg_tasks', 'last_edited_time', 'not_null', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'stg_task_changes', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM c
UNION ALL SELECT 'stg_task_changes', 'id', 'unique', count(*) FROM (SELECT id FROM c GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_task_changes', 'page_id', 'not_null', count(*) FILTER (WHERE page_id IS NULL) FROM c
UNION ALL SELECT 'stg_task_changes', 'field', 'not_null', count(*) FILTER (WHERE field IS NULL) FROM c
UNION ALL SELECT 'stg_task_changes', 'detected_at', 'not_null', count(*) FILTER (WHERE detected_at IS NULL) FROM c
UNION ALL SELECT 'stg_job_applications', 'page_id', 'not_null', count(*) FILTER (WHERE page_id IS NULL) FROM j
UNION ALL SELECT 'stg_job_applications', 'page_id', 'unique', count(*) FROM (SELECT page_id FROM j GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_job_application_changes', 'id', 'not_null', 0
UNION ALL SELECT 'stg_job_application_changes', 'id', 'unique', count(*) FROM (SELECT event_type FROM events GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stg_job_application_changes', 'page_id', 'not_null', count(*) FILTER (WHERE user_id % 10 = 0) FROM events
UNION ALL SELECT 'stg_job_application_changes', 'detected_at', 'not_null', count(*) FILTER (WHERE event_type = 'error') FROM events
UNION ALL SELECT 'stg_pursuits', 'page_id', 'not_null', count(*) FILTER (WHERE page_id IS NULL) FROM p
UNION ALL SELECT 'stg_pursuits', 'page_id', 'unique', count(*) FROM (SELECT page_id FROM p GROUP BY 1 HAVING count(*) > 1)""",
)
def dq_staging(spark, sf_dir):
    """O-Q1: every declared check of the five staging models on its staged view. Some inputs
    are wrong on purpose: unreadable times, customers as application ids, a missing page."""
    edited = F.when(F.col("o_orderstatus") == "F", "never").otherwise(iso(F.col("o_orderdate")))
    nothing = F.lit(None).cast("string")
    due = {f"{c}_{half}": nothing for c in ("due_date", "closed_date") for half in ("start", "end")}
    applied = {c: nothing for c in ("applied_date_start", "applied_date_end", "follow_up_date_start", "follow_up_date_end", "last_follow_up")}
    flags = {c: F.lit(1) for c in ("resume", "cover_letter")}
    tasks = _raw_orders(spark, sf_dir, edited=edited, **due).withColumn("last_edited_time", F.col("edited"))
    applications = _raw_orders(spark, sf_dir, customer=F.col("o_custkey"), **applied, **flags).withColumn("page_id", F.col("customer"))
    application_changes = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("id"), F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("page_id"),
        iso(F.col("ts")).alias("valid_from"), F.when(F.col("event_type") == "error", "?").otherwise(iso(F.col("ts"))).alias("detected_at"),
    )
    day = F.lit("2024-01-01T00:00:00Z")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("page_id"), day.alias("created_time"), day.alias("last_edited_time")
    )
    models = {
        "stg_tasks": staging.stg_tasks(tasks),
        "stg_task_changes": staging.stg_changes(task_changes(spark, sf_dir)),
        "stg_job_applications": staging.stg_job_applications(applications),
        "stg_job_application_changes": staging.stg_changes(application_changes),
        "stg_pursuits": staging.stg_pursuits(customers),
    }
    checked = [quality.check_model(name, df, quality.STAGING_CHECKS[name]) for name, df in models.items()]
    return reduce(DataFrame.unionByName, checked)


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("orders", "events", "lineitem", "conversations")
    ),
)
def table_counts(spark, sf_dir):
    """O-A3."""
    return quality.table_counts({t: table(spark, sf_dir, t) for t in ("orders", "events", "lineitem", "conversations")})


@query("distinct_fields", f"WITH {TASK_CTES}, c AS ({changes_sql()}) SELECT DISTINCT field FROM c")
def distinct_fields(spark, sf_dir):
    """O-A5."""
    return quality.distinct_fields(task_changes(spark, sf_dir))


# --- intervals ---------------------------------------------------------------------------

ORDER = ("valid_from", "id")


def status_changes(spark, sf_dir, hot=skew.COUNT):
    """The event log as staged change records; a first state is valid from before it was seen."""
    return event_log(spark, sf_dir, hot).select(
        "page_id", "field", "old_value", "new_value", F.col("ts").alias("valid_from"),
        F.when(F.col("is_initial"), F.col("ts") + F.expr("interval 1 second")).otherwise(F.col("ts")).alias("detected_at"),
        F.col("event_id").alias("id"),
    )


def intervals(spark, sf_dir, hot=skew.COUNT):
    if hot is skew.COUNT:
        hot = hot_users(spark, sf_dir)
    return marts.status_history(status_changes(spark, sf_dir, hot), order=ORDER, hot=hot)


_HISTORY_CTE = f"""{EVENT_LOG_CTE}, h AS (
  SELECT page_id, new_value AS status, ts AS valid_from, event_id,
    lead(ts) OVER (PARTITION BY page_id ORDER BY ts, event_id) AS valid_to,
    row_number() OVER (PARTITION BY page_id ORDER BY ts, event_id) AS interval_no
  FROM log_t)"""
_OPEN = "('" + "', '".join(OPEN_STATUSES) + "')"


@query("status_history", f"WITH {_HISTORY_CTE} SELECT page_id, status, valid_from, valid_to, interval_no FROM h")
def status_history(spark, sf_dir):
    """O-M1."""
    return intervals(spark, sf_dir)


def _active_days_sql(as_of):
    until = f"least(coalesce(valid_to, TIMESTAMP '{as_of}'), TIMESTAMP '{as_of}')"
    return f"CAST(sum(date_diff('day', CAST(valid_from AS DATE), CAST({until} AS DATE))) AS BIGINT) AS active_days"


_BUCKETS = {"click": "open", "view": "open", "signup": "in-progress", "error": "blocked"}


@query(
    "active_days",
    f"""WITH {_HISTORY_CTE}
SELECT page_id, CASE status WHEN 'click' THEN 'open' WHEN 'view' THEN 'open' WHEN 'signup' THEN 'in-progress'
    WHEN 'error' THEN 'blocked' ELSE 'done' END AS bucket,
  {_active_days_sql("2024-02-01")}
FROM h WHERE valid_from <= TIMESTAMP '2024-02-01' GROUP BY 1, 2""",
)
def active_days(spark, sf_dir):
    """O-M2."""
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    return marts.active_days(intervals(spark, sf_dir), marts.bucket_of(F.col("status"), _BUCKETS, "done"), as_of)


@query(
    "active_days_as_of",
    f"""WITH {_HISTORY_CTE}
SELECT page_id, CASE status WHEN 'click' THEN 'open' WHEN 'view' THEN 'open' WHEN 'signup' THEN 'in-progress'
    WHEN 'error' THEN 'blocked' ELSE 'done' END AS bucket, {_active_days_sql("2024-01-12 06:00:00")}
FROM h WHERE valid_from <= TIMESTAMP '2024-01-12 06:00:00' GROUP BY 1, 2""",
)
def active_days_as_of(spark, sf_dir):
    """O-M2 as it was earlier: later intervals do not count, running ones end then."""
    as_of = F.lit("2024-01-12 06:00:00").cast("timestamp_ntz")
    return marts.active_days(intervals(spark, sf_dir), marts.bucket_of(F.col("status"), _BUCKETS, "done"), as_of)


@query(
    "active_days_by_group",
    f"""WITH {_HISTORY_CTE}, b AS (SELECT event_type AS status, CASE WHEN max(value) > 50 THEN left(event_type, 1) END AS bucket
  FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT page_id, coalesce(b.bucket, 'other') AS bucket,
  {_active_days_sql("2024-02-01")}
FROM h LEFT JOIN b USING (status) WHERE valid_from <= TIMESTAMP '2024-02-01' GROUP BY 1, 2""",
)
def active_days_by_group(spark, sf_dir):
    """O-M2 with the groups of an option registry."""
    options = (
        table(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("event_type").alias("option_name"))
        .agg(F.max("value").alias("top"))
        .select(
            F.lower("option_name").alias("option_id"), "option_name",
            F.when(F.col("top") > 50, F.substring("option_name", 1, 1)).alias("option_group"),
        )
    )
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    return marts.active_days_by_group(intervals(spark, sf_dir), marts.option_buckets(options), as_of)


@query(
    "open_volume_daily",
    f"""
WITH days AS (SELECT CAST(unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM
    (SELECT ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, event_type FROM events) WHERE p IS DISTINCT FROM event_type),
last AS (SELECT d.day, user_id, arg_max(event_type, (ts, event_id)) AS status
  FROM days d JOIN events e ON e.ts < d.day + INTERVAL 1 DAY GROUP BY ALL)
SELECT day, count(*) FILTER (WHERE status IN {_OPEN}) AS open_tasks FROM days LEFT JOIN last USING (day) GROUP BY day""",
)
def open_volume_daily(spark, sf_dir):
    """O-M5: open at the end of the day, against the last event of every user and day."""
    hot = hot_users(spark, sf_dir)
    return marts.open_volume_daily(status_changes(spark, sf_dir, hot), OPEN_STATUSES, order=ORDER, hot=hot)


@query(
    "open_volume_touched",
    f"""
WITH {_HISTORY_CTE}, o AS (SELECT * FROM h WHERE status IN {_OPEN} AND (valid_to IS NULL OR valid_to > valid_from)),
days AS (SELECT CAST(unnest(generate_series((SELECT min(valid_from)::DATE FROM o), DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, count(DISTINCT page_id) AS open_tasks
FROM days LEFT JOIN o ON o.valid_from < day + INTERVAL 1 DAY AND (o.valid_to IS NULL OR o.valid_to > day)
GROUP BY day""",
)
def open_volume_touched(spark, sf_dir):
    """O-M5, other reading: open at any time of the day."""
    hot = hot_users(spark, sf_dir)
    return marts.open_volume_touched(intervals(spark, sf_dir, hot), OPEN_STATUSES, F.lit("2024-01-31").cast("date"), hot)


# --- marts -------------------------------------------------------------------------------


def _user_tasks(spark, sf_dir):
    """One task per customer, closed when its balance is positive."""
    closed = F.date_add(F.lit("2024-01-03").cast("date"), F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("page_id"),
        F.lit("2024-01-01").cast("date").alias("created_time"),
        F.when(F.col("c_acctbal") > 0, closed).alias("closed_date_start"),
        F.col("c_mktsegment").alias("area"),
        F.col("c_nationkey").alias("pursuit"),
    )


@query(
    "tasks_closed",
    """
WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS page_id, DATE '2024-01-01' AS created_at, DATE '2024-01-03' + c_nationkey AS closed_at,
  c_mktsegment AS area, c_nationkey AS pursuit FROM customer WHERE c_acctbal > 0)
SELECT t.*, (SELECT arg_max(event_type, (ts, event_id)) FROM events e
  WHERE CAST(e.user_id AS VARCHAR) = t.page_id AND e.ts < t.closed_at + INTERVAL 1 DAY) AS status_at_close FROM t""",
)
def tasks_closed(spark, sf_dir):
    """O-M4, against the last event before the end of the closing day."""
    hot = hot_users(spark, sf_dir)
    return marts.tasks_closed(_user_tasks(spark, sf_dir), intervals(spark, sf_dir, hot), ["area", "pursuit"], hot)


@query(
    "mttr",
    """
SELECT o_orderpriority AS area, l_returnflag AS pursuit, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  count(*) AS closed_tasks, round(avg(date_diff('day', o_orderdate, l_shipdate)), 6) AS mean_days,
  CAST(CASE WHEN grouping(o_orderpriority) = 1 THEN 3 WHEN grouping(l_returnflag) = 1 THEN 2
    WHEN grouping(CAST(date_trunc('month', l_shipdate) AS DATE)) = 1 THEN 1 ELSE 0 END AS INTEGER) AS level
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY ROLLUP (o_orderpriority, l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE))""",
)
def mttr(spark, sf_dir):
    """O-M6: lines as tasks, opened with their order and closed when shipped."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("closed")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("area"), F.to_date("o_orderdate").alias("created")
    )
    tasks = skew.salted_join(lines, orders, ["o_orderkey"], ["l_partkey", "l_suppkey", "closed"], "inner").select(
        "area", F.col("l_returnflag").alias("pursuit"), F.trunc("closed", "month").alias("month"), "created", "closed"
    )
    means = marts.mttr(tasks, ["area", "pursuit", "month"], F.datediff("closed", "created"))
    return means.withColumn("mean_days", F.round("mean_days", 6))




@query(
    "due_date_drift",
    f"""
WITH d AS (SELECT CAST(user_id AS VARCHAR) AS page_id, ts, event_id,
    CASE WHEN event_type <> 'error' THEN DATE '2024-01-01' + CAST(floor(value) AS INTEGER) END AS due FROM events),
l AS (SELECT *, lag(due) OVER w AS prev, row_number() OVER w AS n FROM d WINDOW w AS (PARTITION BY page_id ORDER BY ts, event_id)),
c AS (SELECT * FROM l WHERE n > 1 AND prev IS DISTINCT FROM due)
SELECT page_id, ts AS changed_at, prev AS old_due, due AS new_due, CAST(due - prev AS BIGINT) AS shift_days,
  row_number() OVER w AS change_no, CAST(sum(due - prev) OVER w AS BIGINT) AS total_shift_days
FROM c WINDOW w AS (PARTITION BY page_id ORDER BY ts, event_id)""",
)
def due_date_drift(spark, sf_dir):
    """O-M7: due dates from the event values, none while in error."""
    due = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.floor("value").cast("int")), "yyyy-MM-dd")
    events = table(spark, sf_dir, "events").withColumn("due", F.when(F.col("event_type") != "error", due))
    hot = hot_users(spark, sf_dir)
    log = diff.change_log(events, "user_id", ["ts", "event_id"], {"due_date_start": "due"}, hot)
    changes = log.select(
        "page_id", "field", "old_value", "new_value", F.col("ts").alias("valid_from"),
        F.when(F.col("is_initial"), F.col("ts") + F.expr("interval 1 second")).otherwise(F.col("ts")).alias("detected_at"),
        F.col("event_id").alias("id"),
    )
    return marts.due_date_drift(changes, order=ORDER, hot=hot)


_STAGES = ("view", "click", "signup", "purchase")


@query(
    "job_funnel",
    f"""
WITH {EVENT_LOG_CTE}, s AS (SELECT page_id, min(ts) FILTER (WHERE NOT is_initial) AS first_response,
  max(list_position(['view', 'click', 'signup', 'purchase'], new_value)) AS stage FROM log_t GROUP BY page_id)
SELECT CAST(c_custkey AS VARCHAR) AS page_id, c_mktsegment AS area,
  CAST(date_diff('day', DATE '2024-01-01' - c_nationkey, CAST(first_response AS DATE)) AS INTEGER) AS days_to_first_response,
  first_response IS NULL AND DATE '2024-02-01' - (DATE '2024-01-01' - c_nationkey) > 40 AS is_ghosted,
  ['view', 'click', 'signup', 'purchase'][stage] AS funnel_stage_reached
FROM customer LEFT JOIN s ON s.page_id = CAST(c_custkey AS VARCHAR)""",
)
def job_funnel(spark, sf_dir):
    """O-M8: customers as applications, their events as the status changes."""
    applications = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("page_id"),
        F.date_sub(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("applied_date_start"),
        F.col("c_mktsegment").alias("area"),
    )
    as_of = F.lit("2024-02-01").cast("date")
    return marts.job_applications(applications, status_changes(spark, sf_dir), _STAGES, as_of, 40, ["area"])


@query(
    "dim_scd2",
    """
WITH v AS (SELECT user_id, ts, event_id, event_type AS status, value > 50 AS is_large FROM events),
p AS (SELECT *, lag(status) OVER w AS ps, lag(is_large) OVER w AS pl, row_number() OVER w AS n FROM v
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT * FROM p WHERE n = 1 OR ps IS DISTINCT FROM status OR pl IS DISTINCT FROM is_large)
SELECT user_id, status, is_large, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current,
  row_number() OVER w AS version_no FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def dim_scd2(spark, sf_dir):
    """O-M9."""
    versions = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("status"), (F.col("value") > 50).alias("is_large")
    )
    return marts.dim_scd2(versions, "user_id", ["ts", "event_id"], ["status", "is_large"])


@query(
    "recurring_adherence",
    """
WITH t AS (SELECT unnest(['p' || l_partkey, 's' || l_suppkey]) AS definition_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS period
  FROM lineitem WHERE l_returnflag <> 'R'),
n AS (SELECT definition_id, period, count(*) AS c FROM t WHERE period IS NOT NULL GROUP BY ALL),
d AS (SELECT 'p' || p_partkey AS definition_id, p_size AS expected, TIMESTAMP '1996-01-01' + to_months(p_size) AS created FROM part
  UNION ALL SELECT 's' || s_suppkey, s_nationkey, CASE WHEN s_nationkey <> 3 THEN TIMESTAMP '1995-06-15' END FROM supplier
  UNION ALL SELECT 'c' || c_custkey, c_nationkey, TIMESTAMP '1999-11-20' + to_months(c_nationkey) FROM customer),
f AS (SELECT definition_id, coalesce(least(date_trunc('month', any_value(created)), min(period)), DATE '2001-05-01') AS first
  FROM d LEFT JOIN n USING (definition_id) GROUP BY 1),
x AS (SELECT definition_id, CAST(unnest(generate_series(CAST(first AS DATE), DATE '2001-05-01', INTERVAL 1 MONTH)) AS DATE) AS period FROM f)
SELECT definition_id, period, coalesce(c, 0) AS completions, expected,
  CASE WHEN expected <> 0 THEN coalesce(c, 0) / expected END AS adherence
FROM x LEFT JOIN n USING (definition_id, period) JOIN d USING (definition_id)""",
)
def recurring_adherence(spark, sf_dir):
    """O-M3: lines as tasks related to a part and a supplier; returned ones are not done. Every month
    from a definition's creation on counts, customers never complete anything, some definitions are
    expected to do nothing, some have no creation date, and some are created after the moment asked for."""
    tasks = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), "l_partkey", F.lit(", s"), "l_suppkey").alias("series"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("closed"),
    )

    def definition(name, kind, key, expected, created):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(kind), key).alias("page_id"), F.col(expected).alias("per_month"), created.alias("created_time")
        )

    def day(text):
        return F.lit(text).cast("timestamp_ntz")

    definitions = definition("part", "p", "p_partkey", "p_size", day("1996-01-01") + F.make_ym_interval(F.lit(0), F.col("p_size").cast("int")))
    definitions = definitions.unionByName(
        definition("supplier", "s", "s_suppkey", "s_nationkey", F.when(F.col("s_nationkey") != 3, day("1995-06-15")))
    ).unionByName(
        definition("customer", "c", "c_custkey", "c_nationkey", day("1999-11-20") + F.make_ym_interval(F.lit(0), F.col("c_nationkey").cast("int")))
    )
    completions = marts.recurring_completions(tasks, "series", "closed")
    return marts.recurring_adherence(completions, definitions, "per_month", "created_time", day("2001-05-17"))


@query(
    "as_of_state",
    """
SELECT CAST(user_id AS VARCHAR) AS page_id, arg_max(event_type, (ts, event_id)) AS status,
  arg_max(CASE WHEN value > 50 THEN 'large' ELSE 'small' END, (ts, event_id)) AS tier
FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id""",
)
def as_of_state(spark, sf_dir):
    """O-M12: replaying the change records gives the last state before the moment."""
    events = table(spark, sf_dir, "events").withColumn("tier", F.when(F.col("value") > 50, "large").otherwise("small"))
    log = diff.change_log(events, "user_id", ["ts", "event_id"], {"status": "event_type", "tier": "tier"})
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return marts.as_of_state(log, moment, ["status", "tier"], order=("ts", "event_id"))


@query(
    "states_at",
    """
WITH m AS (SELECT user_id, ts + INTERVAL 6 HOUR AS moment FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT c_custkey, TIMESTAMP '2024-01-10' FROM customer),
e AS (SELECT user_id, ts, arg_max(event_type, event_id) AS status, arg_max(CASE WHEN value > 50 THEN 'large' ELSE 'small' END, event_id) AS tier
  FROM events GROUP BY ALL)
SELECT CAST(m.user_id AS VARCHAR) AS page_id, m.moment, e.status, e.tier
FROM m ASOF LEFT JOIN e ON m.user_id = e.user_id AND m.moment >= e.ts""",
)
def states_at(spark, sf_dir):
    """O-M12 at many moments: six hours after each purchase, and one day for every customer, of whom some
    never had an event."""
    events = table(spark, sf_dir, "events").withColumn("tier", F.when(F.col("value") > 50, "large").otherwise("small"))
    log = diff.change_log(events, "user_id", ["ts", "event_id"], {"status": "event_type", "tier": "tier"})
    after = events.where("event_type = 'purchase'").select(
        F.col("user_id").cast("string").alias("page_id"), (F.col("ts") + F.expr("interval 6 hours")).alias("moment")
    )
    fixed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("page_id"), F.lit("2024-01-10").cast("timestamp_ntz").alias("moment")
    )
    return marts.states_at(log, after.unionByName(fixed), ["status", "tier"], order=("ts", "event_id"))


@query(
    "active_days_by_week",
    f"""
WITH {_HISTORY_CTE}, d AS (
  SELECT page_id, status AS bucket, CAST(unnest(generate_series(CAST(valid_from AS DATE),
    CAST(least(coalesce(valid_to, TIMESTAMP '2024-02-20'), TIMESTAMP '2024-02-20') AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM h)
SELECT page_id, bucket, CAST(date_trunc('week', day) AS DATE) AS period, CAST(count(*) AS INTEGER)::BIGINT AS active_days FROM d GROUP BY ALL""",
)
def active_days_by_week(spark, sf_dir):
    """O-M2 per week, against a row per day."""
    as_of = F.lit("2024-02-20").cast("timestamp_ntz")
    return marts.active_days_by_period(intervals(spark, sf_dir), F.col("status"), as_of, "week")


#: Bounds between three runs; the first and the last are open-ended.
_RUN_DAYS = (None, "2024-01-11", "2024-01-21", None)


def _runs(spark, sf_dir):
    """The status records of each run."""
    records = status_changes(spark, sf_dir).where("field = 'status'").withColumnRenamed("new_value", "status")
    for start, end in zip(_RUN_DAYS, _RUN_DAYS[1:]):
        at = F.col("valid_from")
        since = F.lit(True) if start is None else at >= F.lit(start).cast("timestamp_ntz")
        yield records.where(since if end is None else since & (at < F.lit(end).cast("timestamp_ntz")))


def _written(df, path):
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_INTERVAL = "page_id string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz, interval_no long"


@query("history_advanced", f"WITH {_HISTORY_CTE} SELECT page_id, status, valid_from, valid_to, interval_no FROM h")
def history_advanced(spark, sf_dir):
    """O-M1 kept up over three runs, each reading its own records and the open intervals only."""
    still, closed = spark.createDataFrame([], _INTERVAL), scratch_dir(spark, "closed-intervals")
    for records in _runs(spark, sf_dir):
        advanced = _written(marts.advance_history(still, records, ORDER), scratch_dir(spark, "advanced"))
        _written(advanced.where("valid_to IS NOT NULL"), closed)
        still = _written(marts.still_open(still, advanced), scratch_dir(spark, "open-intervals"))
    return spark.read.schema(_INTERVAL).parquet(closed).unionByName(still)


@query("open_volume_advanced", ORACLE["open_volume_daily"])
def open_volume_advanced(spark, sf_dir):
    """O-M5 kept up over three runs as daily moves."""
    still, moves = spark.createDataFrame([], _INTERVAL), spark.createDataFrame([], "day date, delta long")
    for records in _runs(spark, sf_dir):
        records = _written(records, scratch_dir(spark, "records"))
        moves = _written(marts.advance_open_volume(moves, still, records, OPEN_STATUSES, ORDER), scratch_dir(spark, "moves"))
        still = _written(marts.still_open(still, marts.advance_history(still, records, ORDER)), scratch_dir(spark, "open-intervals"))
    return marts.open_volume(moves)
