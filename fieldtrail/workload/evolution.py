"""Queries that evolve schemas, migrate columns and rewrite history."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtrail.operators import evolve as ev
from fieldtrail.operators import history, migrate, orphans, upsert
from fieldtrail.workload import query
from fieldtrail.workload.changes import event_log, task_changes
from fieldtrail.workload.tables import EVENT_LOG_CTE, TASK_CTES, changes_sql, table, tasks_before, tasks_now

# --- upserts -----------------------------------------------------------------------------


def _rated(tasks):
    """Stored tasks with a column later batches no longer bring."""
    return tasks.withColumn("rating", F.length("url")).drop("is_urgent")


def _recent(tasks):
    return tasks.where(F.col("created_time") >= "1999-01-01").drop("is_urgent")


_UPSERT_SQL = """
WITH {ctes}, b AS (SELECT * EXCLUDE (is_urgent) FROM now_t WHERE created_time >= '1999-01-01')
SELECT b.*, {kept} AS rating FROM b LEFT JOIN before_t p USING (page_id)
UNION ALL
SELECT p.* EXCLUDE (is_urgent), CAST(length(url) AS INTEGER) FROM before_t p ANTI JOIN b USING (page_id)"""


@query("upsert_merge", _UPSERT_SQL.format(ctes=TASK_CTES, kept="CAST(length(p.url) AS INTEGER)"))
def upsert_merge(spark, sf_dir):
    """O-K1 (merge), O-E1."""
    return upsert.upsert(_rated(tasks_before(spark, sf_dir)), _recent(tasks_now(spark, sf_dir)))


@query("upsert_replace", _UPSERT_SQL.format(ctes=TASK_CTES, kept="CAST(NULL AS INTEGER)"))
def upsert_replace(spark, sf_dir):
    """O-K1 (replace): columns the batch lacks become NULL."""
    return upsert.upsert(_rated(tasks_before(spark, sf_dir)), _recent(tasks_now(spark, sf_dir)), mode="replace")


@query(
    "soft_delete",
    f"""
WITH {TASK_CTES}
SELECT p.page_id, p.status, CASE WHEN n.total_price < 300000 THEN NULL
  WHEN p.status = 'O' THEN '2023-12-01T00:00:00Z' ELSE '2024-02-01T00:00:00Z' END AS deleted_at
FROM before_t p JOIN now_t n USING (page_id)
WHERE n.total_price < 300000 OR p.status <> 'O'""",
)
def soft_delete(spark, sf_dir):
    """O-M10: deleted pages are marked, those older than the lifespan purged, returned ones cleared."""
    earlier = F.when(F.col("status") == "O", "2023-12-01T00:00:00Z")
    prev = tasks_before(spark, sf_dir).select("page_id", "status", earlier.alias("deleted_at"))
    present = tasks_now(spark, sf_dir).where("total_price < 300000")
    now = "2024-02-01T00:00:00Z"
    return upsert.purge_deleted(upsert.mark_deleted(prev, present, now), now, 30)


# --- options -----------------------------------------------------------------------------

_OPTIONS_SQL = """
  SELECT DISTINCT 'p3' AS property_id, substr(o_orderpriority, 1, 1) AS option_id,
    CASE WHEN o_orderpriority LIKE '4%' THEN 'UNSET' ELSE substr(o_orderpriority, 3) END AS option_name FROM orders
  UNION ALL
  SELECT DISTINCT 'p9', substr(o_orderpriority, 1, 1), 'other property' FROM orders
  UNION ALL
  SELECT DISTINCT 'p0', 'opt_' || lower(o_orderstatus), 'Status ' || o_orderstatus FROM orders WHERE o_orderstatus <> 'O'"""


def option_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    prio = F.col("o_orderpriority")
    names = F.when(prio.startswith("4"), "UNSET").otherwise(F.substr(prio, F.lit(3)))
    first = F.substring(prio, 1, 1).alias("option_id")
    return (
        orders.select(F.lit("p3").alias("property_id"), first, names.alias("option_name")).distinct()
        .unionByName(orders.select(F.lit("p9").alias("property_id"), first, F.lit("other property").alias("option_name")).distinct())
        .unionByName(
            orders.where("o_orderstatus <> 'O'").select(
                F.lit("p0").alias("property_id"),
                F.concat(F.lit("opt_"), F.lower("o_orderstatus")).alias("option_id"),
                F.concat(F.lit("Status "), "o_orderstatus").alias("option_name"),
            ).distinct()
        )
    )


_BACKFILL_CTES = f"""{TASK_CTES}, c AS ({changes_sql()}), o AS ({_OPTIONS_SQL}),
names AS (SELECT option_id, arg_min(option_name, property_id) AS option_name FROM o GROUP BY option_id),
j AS (SELECT c.*, a.option_name AS old_name, b.option_name AS new_name FROM c
  LEFT JOIN names a ON a.option_id = c.old_value_id LEFT JOIN names b ON b.option_id = c.new_value_id)"""


@query(
    "option_backfill",
    f"""
WITH {_BACKFILL_CTES}
SELECT id, page_id, field, CASE WHEN old_name <> old_value THEN old_name ELSE old_value END AS old_value,
  CASE WHEN new_name <> new_value THEN new_name ELSE new_value END AS new_value, old_value_id, new_value_id,
  valid_from, detected_at, coalesce(old_name <> old_value, false) AS old_updated,
  coalesce(new_name <> new_value, false) AS new_updated
FROM j""",
)
def option_backfill(spark, sf_dir):
    """O-J2, O-C4, O-L2, O-E2."""
    return history.backfill_option_names(task_changes(spark, sf_dir), option_table(spark, sf_dir))


@query(
    "option_backfill_count",
    f"""
WITH {_BACKFILL_CTES}
SELECT CAST(coalesce(count(*) FILTER (WHERE old_name <> old_value), 0)
  + coalesce(count(*) FILTER (WHERE new_name <> new_value), 0) AS BIGINT) AS updated_values FROM j""",
)
def option_backfill_count(spark, sf_dir):
    """O-J2: the number of refreshed values."""
    return history.backfill_count(option_backfill(spark, sf_dir))


@query(
    "rename_only",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS page_id, substr(o_orderpriority, 3) AS old_value,
  CASE WHEN o_orderpriority LIKE '4%' THEN 'UNSET' WHEN o_orderstatus = 'P' THEN 'HIGH' ELSE substr(o_orderpriority, 3) END AS new_value,
  o_orderpriority LIKE '4%' AS is_rename_only
FROM orders
WHERE o_orderpriority LIKE '4%' OR (o_orderstatus = 'P' AND o_orderpriority NOT LIKE '2%')""",
)
def rename_only(spark, sf_dir):
    """O-M11, Q12: an option rename appears as a change with equal ids and is flagged."""
    from fieldtrail.operators import diff

    orders = table(spark, sf_dir, "orders")
    prio, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string").alias("page_id")
    unset = prio.startswith("4")
    pending = F.col("o_orderstatus") == "P"
    name, first = F.substr(prio, F.lit(3)), F.substring(prio, 1, 1)
    prev = orders.select(key, name.alias("priority"), first.alias("priority_id"))
    now = orders.select(
        key,
        F.when(unset, "UNSET").when(pending, "HIGH").otherwise(name).alias("priority"),
        F.when(unset, first).when(pending, "2").otherwise(first).alias("priority_id"),
    )
    flagged = history.rename_only(diff.detect_changes(now, prev, "2024-02-01"))
    return flagged.select("page_id", "old_value", "new_value", "is_rename_only")


# --- renames and type changes ------------------------------------------------------------


@query(
    "rename_auto",
    f"""
WITH {TASK_CTES}
SELECT page_id, created_time, last_edited_time, url, coalesce(status, priority) AS status,
  coalesce(status_id, priority_id) AS status_id, total_price, due_date_start AS deadline_start,
  due_date_end AS deadline_end, is_urgent
FROM now_t""",
)
def rename_auto(spark, sf_dir):
    """O-E3: a date family moves, a select family fills an existing one."""
    pages, changes = tasks_now(spark, sf_dir), task_changes(spark, sf_dir)
    pages, changes = ev.rename_family(pages, changes, "due_date", "deadline")
    return ev.rename_family(pages, changes, "priority", "status")[0]


@query(
    "rename_declared",
    f"""
WITH {TASK_CTES}
SELECT *, coalesce(CASE WHEN status = 'O' THEN 'kept' END, priority) AS label, priority_id AS label_id FROM now_t""",
)
def rename_declared(spark, sf_dir):
    """O-E4: NULLs of the new column are filled, a missing one is created, the old stay."""
    pages = tasks_now(spark, sf_dir).withColumn("label", F.when(F.col("status") == "O", "kept"))
    return ev.apply_declared_rename(pages, task_changes(spark, sf_dir), "priority", "label")[0]


@query(
    "history_rename",
    f"""
WITH {TASK_CTES}, c AS ({changes_sql()})
SELECT id, page_id, CASE field WHEN 'status' THEN 'state' WHEN 'due_date_start' THEN 'deadline_start' ELSE field END AS field,
  old_value, new_value FROM c""",
)
def history_rename(spark, sf_dir):
    """O-C7."""
    renamed = history.rename_fields(task_changes(spark, sf_dir), {"status": "state", "due_date_start": "deadline_start"})
    return renamed.select("id", "page_id", "field", "old_value", "new_value")


_RENAMES = {
    "swap": [("status", "priority"), ("priority", "status")],
    "chain": [("priority", "status"), ("status", "stage")],
    "auto": [("due_date", "deadline"), ("priority", "status")],
}


def _renamed(spark, sf_dir, kind):
    """One run's renames, as the schema comparison lists them."""
    rows = [
        dict(status="renamed", property_id=f"p{i}", old_name=o, new_name=n, old_column=o, new_column=n, old_type="select", new_type="select")
        for i, (o, n) in enumerate(_RENAMES[kind])
    ]
    return ev.evolve(tasks_now(spark, sf_dir), task_changes(spark, sf_dir), rows, {}, "2024-02-01T00:00:00Z")


def _renamed_history_sql(cases):
    return f"WITH {TASK_CTES}, c AS ({changes_sql()}) SELECT * REPLACE (CASE field {cases} ELSE field END AS field) FROM c"


@query(
    "rename_swap",
    f"""WITH {TASK_CTES}
SELECT * EXCLUDE (status, status_id, priority, priority_id), status AS priority, status_id AS priority_id,
  priority AS status, priority_id AS status_id FROM now_t""",
)
def rename_swap(spark, sf_dir):
    """O-E3: two properties take each other's names."""
    return _renamed(spark, sf_dir, "swap").pages


@query("rename_swap_history", _renamed_history_sql("WHEN 'status' THEN 'priority' WHEN 'priority' THEN 'status'"))
def rename_swap_history(spark, sf_dir):
    """O-E3, O-C7: their histories follow."""
    return _renamed(spark, sf_dir, "swap").changes


@query(
    "rename_chain",
    f"""WITH {TASK_CTES}
SELECT * EXCLUDE (status, status_id, priority, priority_id), status AS stage, status_id AS stage_id,
  priority AS status, priority_id AS status_id FROM now_t""",
)
def rename_chain(spark, sf_dir):
    """O-E3: a property takes the name that another one leaves."""
    return _renamed(spark, sf_dir, "chain").pages


@query("rename_chain_history", _renamed_history_sql("WHEN 'priority' THEN 'status' WHEN 'status' THEN 'stage'"))
def rename_chain_history(spark, sf_dir):
    """O-E3, O-C7."""
    return _renamed(spark, sf_dir, "chain").changes


@query(
    "rename_auto_history",
    _renamed_history_sql("WHEN 'due_date_start' THEN 'deadline_start' WHEN 'due_date_end' THEN 'deadline_end' WHEN 'priority' THEN 'status'"),
)
def rename_auto_history(spark, sf_dir):
    """O-E3, O-C7: the history of ``rename_auto``."""
    return _renamed(spark, sf_dir, "auto").changes


def _diff_row(old_type, new_type):
    return dict(
        status="type_changed", property_id="p3", old_name="Priority", new_name="Priority",
        old_column="priority", new_column="priority", old_type=old_type, new_type=new_type,
    )


def _retyped(spark, sf_dir):
    """The priority became a number: old columns set aside, a new one filled."""
    out = ev.evolve(
        tasks_now(spark, sf_dir), task_changes(spark, sf_dir), [_diff_row("select", "number")], {}, "2024-02-01T00:00:00Z"
    )
    out.pages = out.pages.withColumn("priority", F.col("total_price"))
    return out


@query(
    "backup_column",
    f"""
WITH {TASK_CTES}
SELECT * EXCLUDE (priority, priority_id), priority AS priority_bak_20240201, priority_id AS priority_id_bak_20240201,
  total_price AS priority FROM now_t""",
)
def backup_column(spark, sf_dir):
    """O-E5."""
    return _retyped(spark, sf_dir).pages


@query("backup_restore", f"WITH {TASK_CTES} SELECT * FROM now_t")
def backup_restore(spark, sf_dir):
    """O-E6: going back to the old type brings the old columns back."""
    mid = _retyped(spark, sf_dir)
    return ev.evolve(mid.pages, mid.changes, [_diff_row("number", "select")], mid.backups, "2024-03-01T00:00:00Z").pages


# --- column and history migrations -------------------------------------------------------


def _measured(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("page_id"),
        F.when(F.col("p_size") > 45, F.lit(None)).when(F.col("p_type") == "PROMO", F.lit("True"))
        .otherwise(F.concat("p_size", F.lit(" cm"))).alias("size"),
        F.concat(F.col("p_retailprice").cast("string"), F.lit("e1")).alias("price"),
        F.col("p_type").alias("grade"),
        F.col("p_brand").alias("brand"),
    )


@query(
    "column_migrate",
    """
SELECT CAST(p_partkey AS VARCHAR) AS page_id,
  CAST(CASE WHEN p_size > 45 THEN NULL WHEN p_type = 'PROMO' THEN 1 ELSE p_size END AS BIGINT) AS size,
  CAST(CAST(p_retailprice AS VARCHAR) || 'e1' AS DOUBLE) AS price,
  CAST(CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 0 END AS BIGINT) AS grade, p_brand AS brand
FROM part""",
)
def column_migrate(spark, sf_dir):
    """O-P15, O-P16: text booleans by default, a map, and lenient numbers."""
    pages = _measured(spark, sf_dir)
    pages = migrate.migrate_columns(pages, ["size", "not there"], "INTEGER", migrate.value_map_for("INTEGER"))
    pages = migrate.migrate_columns(pages, ["price"], "REAL")
    return migrate.migrate_columns(pages, ["grade"], "INTEGER", [("SMALL", "1"), ("MEDIUM", "2")])


@query(
    "migration_impact",
    """
SELECT 'grade' AS column_name, count(*) AS changed_rows,
  count(*) FILTER (WHERE p_type NOT IN ('SMALL', 'MEDIUM')) AS zeroed_rows FROM part
UNION ALL SELECT 'size', count(*) FILTER (WHERE p_size <= 45), CAST(0 AS BIGINT) FROM part""",
)
def migration_impact(spark, sf_dir):
    """O-E13 for a column migration."""
    value_map = [("SMALL", "1"), ("MEDIUM", "2"), ("True", "1")]
    return migrate.migration_impact(_measured(spark, sf_dir), ["grade", "size"], "INTEGER", value_map)


@query(
    "history_migrate",
    f"""
WITH {EVENT_LOG_CTE}
SELECT event_id, CASE WHEN old_value IN ('click', 'view') THEN 'seen' ELSE old_value END AS old_value,
  CASE WHEN new_value IN ('click', 'view') THEN 'seen' ELSE new_value END AS new_value FROM log_t""",
)
def history_migrate(spark, sf_dir):
    """O-C6: the map chains, click to view to seen."""
    migrated = history.normalise_values(event_log(spark, sf_dir), ["status"], [("click", "view"), ("view", "seen")])
    return migrated.select("event_id", "old_value", "new_value")


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_RANGE = f"{_DAY} || '/' || strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d')"


def _ranged(spark, sf_dir):
    """Due dates as text: a range, a plain date or nothing, by status."""
    day, status = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")
    end = F.date_format(F.col("o_orderdate") + F.expr("interval 2 days"), "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("page_id"),
        F.when(status == "P", F.concat(day, F.lit("/"), end)).when(status == "O", day).alias("due_date"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").alias("count"),
    )


@query(
    "date_range_split",
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS page_id, o_orderpriority AS name, o_custkey AS count,
  CASE WHEN o_orderstatus <> 'F' THEN {_DAY} END AS due_date_start,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') END AS due_date_end
FROM orders""",
)
def date_range_split(spark, sf_dir):
    """O-P17, O-U2: the detected columns and an explicit one that is not there."""
    return migrate.split_date_columns(_ranged(spark, sf_dir), ["due_date", "not_there"])


@query(
    "split_impact",
    f"""
SELECT 'pages' AS table_name, 'due_date' AS column_name,
  count(*) FILTER (WHERE o_orderstatus <> 'F') + count(*) FILTER (WHERE o_orderstatus = 'P') AS values_set,
  CAST(0 AS BIGINT) AS rows_added, CAST(0 AS BIGINT) AS rows_removed FROM orders
UNION ALL SELECT 'changes', 'due_date', 0, 2 * count(*), count(*) FROM orders WHERE o_orderstatus <> 'F'""",
)
def split_impact(spark, sf_dir):
    """O-E13: what ``date_range_split`` and ``history_split`` would do."""
    return migrate.split_impact(_ranged(spark, sf_dir), _split_changes(spark, sf_dir), ["due_date", "not_there"])


@query(
    "history_split",
    f"""
WITH h AS (SELECT CAST(o_orderkey AS VARCHAR) AS page_id, o_orderstatus AS s, {_DAY} AS day, {_RANGE} AS range,
  strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS later FROM orders)
SELECT page_id, 'status' AS field, day AS old_value, range AS new_value FROM h WHERE s = 'F'
UNION ALL SELECT page_id, 'due_date_start', CASE WHEN s = 'P' THEN day END, day FROM h WHERE s <> 'F'
UNION ALL SELECT page_id, 'due_date_end', NULL, CASE WHEN s = 'P' THEN later END FROM h WHERE s <> 'F'""",
)
def history_split(spark, sf_dir):
    """O-C5."""
    return history.split_date_fields(_split_changes(spark, sf_dir), ["due_date"]).drop("id")


def _split_changes(spark, sf_dir):
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    span = F.concat(day, F.lit("/"), F.date_format(F.col("o_orderdate") + F.expr("interval 2 days"), "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("page_id"),
        F.when(status == "F", "status").otherwise("due_date").alias("field"),
        F.when(status != "O", day).alias("old_value"),
        F.when(status == "O", day).otherwise(span).alias("new_value"),
    )


_SAMPLED = {"due_date": f"CASE o_orderstatus WHEN 'P' THEN {_RANGE} WHEN 'O' THEN {_DAY} END", "name": "o_orderpriority"}


@query(
    "detect_dates",
    "WITH s AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, arg_min({x}, CAST(o_orderkey AS VARCHAR)) FILTER (WHERE {x} <> '') AS sample FROM orders"
        for c, x in _SAMPLED.items()
    )
    + ") SELECT * FROM s WHERE regexp_matches(sample, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')",
)
def detect_dates(spark, sf_dir):
    """O-E12, O-F4, O-L1: split halves, system columns and columns without values are passed over."""
    pages = _ranged(spark, sf_dir).withColumns(
        {"created_time": F.lit("2024-01-01"), "start_start": F.lit("2024-01-01"), "nothing": F.lit(None).cast("string"), "blank": F.lit("")}
    )
    return migrate.detect_date_columns(pages)


# --- orphans -----------------------------------------------------------------------------

_SUFFIX_SQL = """CASE p_type WHEN 'SMALL' THEN '_id' WHEN 'MEDIUM' THEN '_start' WHEN 'PROMO' THEN '_bak_20240101' ELSE '' END"""
_BASE_SQL = "replace(p_name, ' ', '_') || '_' || substr(p_brand, 7)"


@query(
    "orphans",
    f"""
WITH cols AS (SELECT DISTINCT p_brand AS table_name, {_BASE_SQL} || {_SUFFIX_SQL} AS column_name FROM part
    UNION SELECT DISTINCT p_brand, 'created_time' FROM part),
reg AS (SELECT DISTINCT p_brand AS table_name, {_BASE_SQL} AS column_name FROM part WHERE p_size > 30),
bak AS (SELECT DISTINCT p_brand AS table_name, {_BASE_SQL} || '_bak_20240101' AS column_name FROM part WHERE p_size > 25)
SELECT table_name, column_name FROM cols
WHERE column_name <> 'created_time' AND (table_name, column_name) NOT IN (SELECT * FROM reg)
  AND (table_name, column_name) NOT IN (SELECT * FROM bak)
  AND (table_name, regexp_replace(column_name, '(_id|_start|_end)$', '')) NOT IN (SELECT * FROM reg)""",
)
def find_orphans(spark, sf_dir):
    """O-J4, O-L3: one table per brand, its columns named after the parts."""
    part = table(spark, sf_dir, "part")
    brand = F.col("p_brand").alias("table_name")
    base = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.substr("p_brand", F.lit(7)))
    kind = F.col("p_type")
    suffix = F.when(kind == "SMALL", "_id").when(kind == "MEDIUM", "_start").when(kind == "PROMO", "_bak_20240101").otherwise("")
    columns = part.select(brand, F.concat(base, suffix).alias("column_name")).unionByName(
        part.select(brand, F.lit("created_time").alias("column_name"))
    ).distinct()
    registry = part.where("p_size > 30").select(brand, base.alias("column_name")).distinct()
    backups = part.where("p_size > 25").select(brand, F.concat(base, F.lit("_bak_20240101")).alias("backup_column")).distinct()
    return orphans.find_orphans(columns, registry, backups)


@query(
    "orphan_impact",
    f"""
WITH {TASK_CTES}, c AS ({changes_sql()})
SELECT 'due_date_end' AS column_name, (SELECT count(due_date_end) FROM now_t) AS non_null_rows,
  (SELECT count(*) FROM c WHERE field = 'due_date_end') AS change_rows
UNION ALL SELECT 'priority', (SELECT count(priority) FROM now_t), (SELECT count(*) FROM c WHERE field = 'priority')
UNION ALL SELECT 'priority_id', (SELECT count(priority_id) FROM now_t), 0""",
)
def orphan_impact(spark, sf_dir):
    """O-A1, O-A2, O-E13."""
    return orphans.orphan_impact(
        tasks_now(spark, sf_dir), task_changes(spark, sf_dir), ["priority", "priority_id", "due_date_end"]
    )


def _dropped(spark, sf_dir):
    pages, changes = tasks_now(spark, sf_dir), task_changes(spark, sf_dir)
    registry = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("table_name"),
        F.when(F.col("p_type") == "PROMO", "priority").otherwise(F.col("p_name")).alias("column_name"),
        F.col("p_partkey").alias("property_id"),
    )
    return orphans.drop_orphans(pages, changes, registry, "Brand#1", ["priority", "priority_id"])


@query("orphan_drop", f"WITH {TASK_CTES} SELECT * EXCLUDE (priority, priority_id) FROM now_t")
def orphan_drop(spark, sf_dir):
    """O-E11: the pages without the column."""
    return _dropped(spark, sf_dir)[0]


@query("orphan_drop_history", f"WITH {TASK_CTES}, c AS ({changes_sql()}) SELECT * FROM c WHERE field <> 'priority'")
def orphan_drop_history(spark, sf_dir):
    """O-C8: its history."""
    return _dropped(spark, sf_dir)[1]


@query(
    "orphan_drop_registry",
    """SELECT p_brand AS table_name, CASE WHEN p_type = 'PROMO' THEN 'priority' ELSE p_name END AS column_name,
  p_partkey AS property_id FROM part WHERE NOT (p_brand = 'Brand#1' AND p_type = 'PROMO')""",
)
def orphan_drop_registry(spark, sf_dir):
    """O-E11: its registry row, in its own table only."""
    return _dropped(spark, sf_dir)[2]
