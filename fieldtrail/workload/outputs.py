"""Queries that write and read back: exports, gated publish, views, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtrail.operators import quality
from fieldtrail.plans import marts
from fieldtrail.session import scratch_dir
from fieldtrail.sources import sinks
from fieldtrail.streaming import changes as stream
from fieldtrail.workload import query
from fieldtrail.workload.analytics import ORDER, intervals, status_changes
from fieldtrail.workload.changes import task_changes
from fieldtrail.workload.tables import EVENT_LOG_CTE, OPEN_STATUSES, TASK_CTES, changes_sql, scratch_tables, table, tasks_now

_OPEN = "('" + "', '".join(OPEN_STATUSES) + "')"


@query(
    "csv_export",
    """SELECT CAST(conv_id AS VARCHAR) AS page_id, CAST(turn AS VARCHAR) AS position, CASE WHEN role <> 'system' THEN role END AS author,
  '"' || text || '", he said' AS text FROM conversations""",
)
def csv_export(spark, sf_dir):
    """O-K4: quotes, commas, line ends within values and NULLs survive the file."""
    store = scratch_tables(spark, "csv-store")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("page_id"),
        F.col("turn").cast("string").alias("position"),
        F.when(F.col("role") != "system", F.col("role")).alias("author"),
        F.concat(F.lit('"'), "text", F.lit('", he said')).alias("text"),
    )
    store.publish(replace={"talks_pages": rows, "talks_changes": store.read("talks_changes")})
    out = scratch_dir(spark, "csv")
    written = sinks.export_csv(store, "talks", out)
    if written != {"talks_pages": True, "talks_changes": False}:
        raise AssertionError(f"unexpected export {written}")
    reader = spark.read.schema(rows.schema).option("header", True).option("multiLine", True).option("lineSep", "\r\n")
    return reader.option("escape", '"').csv(f"{out}/talks_pages.csv")


def _marts(spark, sf_dir):
    return {
        "fct_open_volume_daily": marts.open_volume_daily(status_changes(spark, sf_dir), OPEN_STATUSES, order=ORDER),
        "int_status_history": intervals(spark, sf_dir),
    }


_HISTORY_SQL = f"""WITH {EVENT_LOG_CTE}
SELECT page_id, new_value AS status, ts AS valid_from, lead(ts) OVER w AS valid_to, row_number() OVER w AS interval_no
FROM log_t WINDOW w AS (PARTITION BY page_id ORDER BY ts, event_id)"""


@query("parquet_publish", _HISTORY_SQL)
def parquet_publish(spark, sf_dir):
    """O-K5: every mart to its own file."""
    out = scratch_dir(spark, "marts")
    done = sinks.export_parquet(_marts(spark, sf_dir), out)
    if done != {"fct_open_volume_daily": True, "int_status_history": True}:
        raise AssertionError(f"unexpected export {done}")
    return spark.read.parquet(f"{out}/int_status_history.parquet")


@query("gated_publish", _HISTORY_SQL)
def gated_publish(spark, sf_dir):
    """O-K6, O-K7: failing checks keep the old version; a good publish drops stale marts
    and no other table."""
    store = scratch_tables(spark, "gated")
    store.publish(replace={"fct_stale": table(spark, sf_dir, "nation")}, kind=sinks.MART)
    store.publish(replace={"raw_pages": table(spark, sf_dir, "region")})
    built = _marts(spark, sf_dir)
    history = built["int_status_history"]
    bad = quality.check_model("int_status_history", history, {"page_id": ("unique",)})
    try:
        sinks.publish_marts(store, built, [bad])
        raise AssertionError("the failing check did not stop the publish")
    except sinks.QualityError:
        if store.tables(sinks.MART) != ["fct_stale"]:
            raise
    good = quality.check_model("int_status_history", history, {"page_id": ("not_null",), "valid_from": ("not_null",)})
    sinks.publish_marts(store, built, [good])
    if store.tables(sinks.MART) != sorted(built) or not store.exists("raw_pages"):
        raise AssertionError(f"unexpected tables {store.tables()}")
    return store.read("int_status_history")


@query(
    "adhoc_sql",
    f"""WITH {TASK_CTES}, c AS ({changes_sql()})
SELECT n.status, count(DISTINCT n.page_id) AS pages, count(*) AS changes
FROM now_t n JOIN c USING (page_id) WHERE c.old_value IS NOT NULL GROUP BY n.status""",
)
def adhoc_sql(spark, sf_dir):
    """O-S6, O-S8: SQL over the views of the published tables."""
    store = scratch_tables(spark, "views")
    store.publish(replace={"tasks_pages": tasks_now(spark, sf_dir)}, append={"tasks_changes": task_changes(spark, sf_dir)})
    store.register_views()
    return spark.sql(
        """SELECT p.status, count(DISTINCT p.page_id) AS pages, count(*) AS changes
        FROM tasks_pages p JOIN tasks_changes c USING (page_id) WHERE c.old_value IS NOT NULL GROUP BY p.status"""
    )


# --- streams -----------------------------------------------------------------------------

#: Bounds between three deliveries; the first and the last are open-ended.
_SLICES = (None, "2024-01-11", "2024-01-21", None)


@query(
    "stream_changes",
    """
WITH s AS (SELECT CAST(user_id AS VARCHAR) AS page_id, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS run,
    ts, event_id, event_type, value FROM events),
l AS (SELECT page_id, run, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS status,
    arg_max(value, (ts, event_id)) AS amount FROM s GROUP BY ALL),
p AS (SELECT *, lag(status) OVER w AS old_status, lag(amount) OVER w AS old_amount, row_number() OVER w AS n
  FROM l WINDOW w AS (PARTITION BY page_id ORDER BY run))
SELECT page_id, 'status' AS field, old_status AS old_value, status AS new_value, 'run-' || run AS detected_at
FROM p WHERE n = 1 OR old_status IS DISTINCT FROM status
UNION ALL
SELECT page_id, 'amount', CAST(old_amount AS VARCHAR), CAST(amount AS VARCHAR), 'run-' || run
FROM p WHERE n = 1 OR old_amount IS DISTINCT FROM amount""",
)
def stream_changes(spark, sf_dir):
    """O-T1: three deliveries, each taken in by a stream that resumes from its checkpoint;
    a page's newest version per delivery is compared with the stored one."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-checkpoint")
    store = scratch_tables(spark, "stream-store")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_edited_time"),
        "event_id",
        F.col("event_type").alias("status"),
        F.col("value").alias("amount"),
        "ts",
    )
    for run, (start, end) in enumerate(zip(_SLICES, _SLICES[1:]), 1):
        day = lambda text: F.lit(text).cast("timestamp_ntz")
        after = F.lit(True) if start is None else F.col("ts") >= day(start)
        before = F.lit(True) if end is None else F.col("ts") < day(end)
        delivery = rows.where(after & before).drop("ts")
        delivery.write.mode("append").parquet(landing)
        source = spark.readStream.schema(delivery.schema).parquet(landing)
        writer = stream.batch_writer(
            store, "users", lambda batch, number, run=run: f"run-{run}", ["last_edited_time", "event_id"], ["status", "amount"]
        )
        stream.run_available(source, writer, checkpoint)
    return store.read("users_changes").select("page_id", "field", "old_value", "new_value", "detected_at")


def _two_spellings(ts, east):
    """A moment in UTC, or where ``east`` as it reads five hours further east."""
    there = F.date_format(ts + F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:00'")
    return F.when(east, there).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


@query(
    "stream_late",
    """SELECT CAST(user_id AS VARCHAR) AS page_id, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id""",
)
def stream_late(spark, sf_dir):
    """O-T1, O-T2: the later half of the edits is delivered first; older versions do not win. Half of the
    edits spell their moment with an offset, so their text says five hours more."""
    landing, checkpoint = scratch_dir(spark, "late"), scratch_dir(spark, "late-checkpoint")
    store = scratch_tables(spark, "late-store")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("page_id"), _two_spellings(F.col("ts"), F.col("value") > 50).alias("last_edited_time"),
        "event_id", F.col("event_type").alias("status"), "ts",
    )
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    for run, part in enumerate((F.col("ts") >= middle, F.col("ts") < middle)):
        rows.where(part).drop("ts").write.mode("append").parquet(landing)
        writer = stream.batch_writer(store, "users", lambda batch, number, run=run: f"run-{run}", ["last_edited_time", "event_id"], ["status"])
        stream.run_available(spark.readStream.schema(rows.drop("ts").schema).parquet(landing), writer, checkpoint)
    return store.read("users_pages").select("page_id", "event_id", "status")


@query(
    "stream_redeliveries",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS page_id, ts AS last_edited_time, event_type AS status FROM events",
)
def stream_redeliveries(spark, sf_dir):
    """O-T2: a delivery that repeats every edit yields each edit once."""
    landing, out = scratch_dir(spark, "twice"), scratch_dir(spark, "once")
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("page_id"),
        F.col("ts").cast("timestamp").alias("last_edited_time"), F.col("event_type").alias("status"),
    )
    rows.unionAll(rows).write.parquet(landing)
    once = stream.without_redeliveries(spark.readStream.schema(rows.schema).parquet(landing))
    started = (
        once.writeStream.format("parquet").option("checkpointLocation", scratch_dir(spark, "once-checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    started.awaitTermination()
    return spark.read.parquet(out).withColumn("last_edited_time", F.col("last_edited_time").cast("timestamp_ntz"))
