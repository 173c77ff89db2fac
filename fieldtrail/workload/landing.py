"""Queries that read landed JSON: flattening, rejects, schema documents, content, comments, sync."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fieldtrail.functions.names import column_name_of
from fieldtrail.operators import evolve, skew, upsert
from fieldtrail.plans import sync
from fieldtrail.session import scratch_dir
from fieldtrail.sources import content, pages
from fieldtrail.workload import query
from fieldtrail.workload.tables import (
    RUN_TS,
    TASK_CTES,
    changes_sql,
    iso,
    scratch_tables,
    table,
    tasks_before,
    tasks_now,
)


def _doc(**types: str) -> str:
    return json.dumps({"properties": {name: {"id": f"p{i}", "type": t} for i, (name, t) in enumerate(types.items())}})


def _texts(*parts):
    return F.array(*[F.struct(p.alias("plain_text")) for p in parts])


# --- flattening --------------------------------------------------------------------------

ORDER_DOC = _doc(
    **{
        "Name": "title", "Order Status": "status", "Total Price": "number", "Due Date": "date",
        "Priority": "select", "Is Urgent": "checkbox", "Customer": "relation", "Owners": "people",
        "Attachments": "files", "Notes": "rich_text", "Score": "formula", "Last Seen": "rollup",
        "1st Contact?": "email", "Created By": "created_by",
    }
)


def order_pages(spark, sf_dir):
    """Orders as raw page documents."""
    key, status, prio = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    end = F.when(status == "P", F.date_format(F.col("o_orderdate") + F.expr("interval 2 days"), "yyyy-MM-dd"))
    no_file = F.array().cast("array<struct<name:string>>")
    score = F.when(
        status == "P", F.struct(F.lit("string").alias("type"), F.lit("pending").alias("string"), F.lit(None).cast("long").alias("number"))
    ).otherwise(F.struct(F.lit("number").alias("type"), F.lit(None).cast("string").alias("string"), F.col("o_custkey").alias("number")))
    properties = F.struct(
        F.struct(_texts(F.lit("Order "), key).alias("title")).alias("Name"),
        F.struct(F.struct(F.concat(F.lit("opt_"), F.lower(status)).alias("id"), status.alias("name")).alias("status")).alias("Order Status"),
        F.struct(F.col("o_totalprice").alias("number")).alias("Total Price"),
        F.struct(F.struct(day.alias("start"), end.alias("end")).alias("date")).alias("Due Date"),
        F.struct(F.struct(F.substring(prio, 1, 1).alias("id"), F.substr(prio, F.lit(3)).alias("name")).alias("select")).alias("Priority"),
        F.struct((prio == "1-URGENT").alias("checkbox")).alias("Is Urgent"),
        F.struct(F.array(F.struct(F.col("o_custkey").cast("string").alias("id")), F.struct(F.concat(F.lit("s"), status).alias("id"))).alias("relation")).alias("Customer"),
        F.struct(F.array(F.struct(F.lit("Ada").alias("name")), F.struct(prio.alias("name"))).alias("people")).alias("Owners"),
        F.struct(F.when(status == "O", no_file).otherwise(F.array(F.struct(F.lit("a.pdf").alias("name")))).alias("files")).alias("Attachments"),
        F.struct(_texts(status, F.lit(" / "), prio).alias("rich_text")).alias("Notes"),
        F.struct(score.alias("formula")).alias("Score"),
        F.struct(F.struct(F.lit("date").alias("type"), F.struct(day.alias("start")).alias("date")).alias("rollup")).alias("Last Seen"),
        F.struct(F.concat(key, F.lit("@example.com")).alias("email")).alias("1st Contact?"),
        F.struct(F.struct(F.lit("u1").alias("id")).alias("created_by")).alias("Created By"),
    )
    return table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(
                key.alias("id"),
                iso(F.col("o_orderdate")).alias("created_time"),
                iso(F.col("o_orderdate") + F.expr("interval 1 day")).alias("last_edited_time"),
                F.concat(F.lit("https://pages.example/"), key).alias("url"),
                properties.alias("properties"),
            )
        ).alias("raw")
    )


@query(
    "page_flatten",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS page_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_time,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS last_edited_time,
  'https://pages.example/' || o_orderkey AS url, 'Order ' || o_orderkey AS name,
  o_orderstatus AS order_status, 'opt_' || lower(o_orderstatus) AS order_status_id, o_totalprice AS total_price,
  strftime(o_orderdate, '%Y-%m-%d') AS due_date_start,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') END AS due_date_end,
  substr(o_orderpriority, 3) AS priority, substr(o_orderpriority, 1, 1) AS priority_id,
  CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent, o_custkey || ', s' || o_orderstatus AS customer,
  'Ada, ' || o_orderpriority AS owners, CAST(o_orderstatus <> 'O' AS INTEGER) AS attachments,
  o_orderstatus || ' / ' || o_orderpriority AS notes,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(o_custkey AS VARCHAR) END AS score,
  strftime(o_orderdate, '%Y-%m-%d') AS last_seen, o_orderkey || '@example.com' AS _1st_contact
FROM orders""",
)
def page_flatten(spark, sf_dir):
    """O-P2 to O-P7, O-P10, O-S1."""
    return pages.flatten_pages(order_pages(spark, sf_dir), pages.parse_schema(ORDER_DOC))


@query(
    "page_flatten_projected",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS page_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_time,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS last_edited_time,
  'https://pages.example/' || o_orderkey AS url, o_totalprice AS total_price,
  CASE WHEN o_orderstatus <> 'O' THEN 'a.pdf' END AS attachments
FROM orders""",
)
def page_flatten_projected(spark, sf_dir):
    """O-P3: include, then exclude; files by name."""
    return pages.flatten_pages(
        order_pages(spark, sf_dir),
        pages.parse_schema(ORDER_DOC),
        include=["Total Price", "Attachments", "Owners"],
        exclude=["Owners"],
        files_handling="names",
    )


PART_DOC = _doc(Words="multi_select", Kind="select")


def part_pages(spark, sf_dir):
    """Parts as pages: the words of the name are the chosen options, none for large sizes."""
    word = F.split("p_name", " ")
    options = F.when(F.col("p_size") <= 40, F.transform(word, lambda w: F.struct(F.upper(w).alias("id"), w.alias("name"))))
    options = F.coalesce(options, F.array().cast("array<struct<id:string,name:string>>"))
    # A choice without an id is malformed.
    kind = F.struct(F.when(F.col("p_type") != "PROMO", F.lower("p_type")).alias("id"), F.col("p_type").alias("name"))
    props = F.struct(
        F.struct(options.alias("multi_select")).alias("Words"), F.struct(kind.alias("select")).alias("Kind")
    )
    return table(spark, sf_dir, "part").select(
        F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), props.alias("properties"))).alias("raw")
    )


@query(
    "multi_select_flatten",
    """
SELECT CAST(p_partkey AS VARCHAR) AS page_id, CAST(NULL AS VARCHAR) AS created_time,
  CAST(NULL AS VARCHAR) AS last_edited_time, CAST(NULL AS VARCHAR) AS url,
  CASE WHEN p_size <= 40 THEN replace(p_name, ' ', ', ') END AS words,
  CASE WHEN p_size <= 40 THEN replace(upper(p_name), ' ', ', ') END AS words_id,
  CASE WHEN p_type <> 'PROMO' THEN p_type END AS kind, CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS kind_id
FROM part""",
)
def multi_select_flatten(spark, sf_dir):
    """O-P5, O-P6, O-P8, O-A6."""
    return pages.flatten_pages(part_pages(spark, sf_dir), pages.parse_schema(PART_DOC))


@query(
    "rejected_values",
    """SELECT CAST(p_partkey AS VARCHAR) AS page_id, 'Kind' AS property, '{"name":"PROMO"}' AS value
FROM part WHERE p_type = 'PROMO'""",
)
def rejected_values(spark, sf_dir):
    """O-P8."""
    return pages.rejected_values(part_pages(spark, sf_dir), pages.parse_schema(PART_DOC))


# --- names -------------------------------------------------------------------------------

_NAMES_SQL = """
  SELECT p_name || '  --  ' || p_type AS name FROM part
  UNION ALL SELECT p_size || 'st ' || p_brand || '?' FROM part
  UNION ALL SELECT '__' || n_name || ' (' || n_nationkey || ')!' FROM nation
  UNION ALL SELECT repeat('_', r_regionkey + 1) || '!!' FROM region"""


@query(
    "sanitize_names",
    f"""
WITH names AS ({_NAMES_SQL}),
joined AS (SELECT name, lower(trim(regexp_replace(name, '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS j FROM names)
SELECT name, CASE WHEN j = '' THEN 'col' WHEN regexp_matches(j, '^[0-9]') THEN '_' || j ELSE j END AS column_name
FROM joined""",
)
def sanitize_names(spark, sf_dir):
    """O-P1 on names that are data."""
    part, nation, region = (table(spark, sf_dir, t) for t in ("part", "nation", "region"))
    names = (
        part.select(F.concat("p_name", F.lit("  --  "), "p_type").alias("name"))
        .unionAll(part.select(F.concat("p_size", F.lit("st "), "p_brand", F.lit("?"))))
        .unionAll(nation.select(F.concat(F.lit("__"), "n_name", F.lit(" ("), "n_nationkey", F.lit(")!"))))
        .unionAll(region.select(F.concat(F.repeat(F.lit("_"), F.col("r_regionkey") + 1), F.lit("!!"))))
    )
    return names.select("name", column_name_of(F.col("name")).alias("column_name"))


# --- schema documents --------------------------------------------------------------------


def part_documents(spark, sf_dir):
    """One schema document per part, as if each were a database: a select whose name is the
    part's, a status with groups, one skipped property and one without id."""
    text = F.col("p_partkey").cast("string")

    def option(name, oid):
        return F.struct(oid.alias("id"), name.alias("name"))

    own = F.struct(
        F.concat(F.lit("k"), text).alias("id"),
        F.lit("select").alias("type"),
        F.struct(F.array(option(F.col("p_type"), F.lower("p_type")), option(F.col("p_brand"), F.col("p_brand"))).alias("options")).alias("select"),
    )
    small = F.when(F.col("p_size") <= 25, F.array(F.lit("s1"))).otherwise(F.array(F.lit("s1"), F.lit("s2")))
    state = F.struct(
        F.concat(F.lit("s"), text).alias("id"),
        F.lit("status").alias("type"),
        F.struct(
            F.array(option(F.lit("Open"), F.lit("s1")), option(F.col("p_name"), F.lit("s2"))).alias("options"),
            F.array(F.struct(F.lit("To do").alias("name"), small.alias("option_ids"))).alias("groups"),
        ).alias("status"),
    )
    skipped = F.struct(F.lit("c").alias("id"), F.lit("created_by").alias("type"))
    nameless = F.struct(F.lit("number").alias("type"))
    # The property name is data, so the map of properties is built, not declared.
    doc = F.concat(
        F.lit('{"properties":{'), F.to_json(F.array("p_name")).substr(F.lit(2), F.length(F.to_json(F.array("p_name"))) - 2),
        F.lit(":"), F.to_json(own), F.lit(',"State":'), F.to_json(state),
        F.lit(',"By":'), F.to_json(skipped), F.lit(',"No id":'), F.to_json(nameless), F.lit("}}"),
    )
    return table(spark, sf_dir, "part").select(F.concat(F.lit("t"), text).alias("table_name"), doc.alias("doc"))


@query(
    "schema_scan",
    """
SELECT 't' || p_partkey AS table_name, 'k' || p_partkey AS property_id, p_name AS property_name,
  replace(p_name, ' ', '_') AS column_name, 'select' AS property_type FROM part
UNION ALL SELECT 't' || p_partkey, 's' || p_partkey, 'State', 'state', 'status' FROM part""",
)
def schema_scan(spark, sf_dir):
    """O-S3, O-E9."""
    return evolve.property_registry(pages.schema_rows(part_documents(spark, sf_dir)))


_STORED_SQL = """
  SELECT 'parts' AS table_name, 'p' || p_partkey AS property_id, p_name AS property_name,
    replace(p_name, ' ', '_') AS column_name, lower(p_type) AS property_type,
    '2024-01-01' AS first_seen, '2024-01-02' AS last_seen FROM part WHERE p_size <= 40"""
_CURRENT_SQL = """
  SELECT 'parts' AS table_name, 'p' || p_partkey AS property_id,
    CASE WHEN p_brand = 'Brand#1' THEN 'new ' || p_name ELSE p_name END AS property_name,
    CASE WHEN p_brand = 'Brand#1' THEN 'new_' || replace(p_name, ' ', '_') ELSE replace(p_name, ' ', '_') END AS column_name,
    CASE WHEN p_retailprice > 1000 THEN 'number' ELSE lower(p_type) END AS property_type FROM part WHERE p_size >= 5"""


def stored_properties(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_size <= 40").select(
        F.lit("parts").alias("table_name"), F.concat(F.lit("p"), "p_partkey").alias("property_id"),
        F.col("p_name").alias("property_name"), column_name_of(F.col("p_name")).alias("column_name"),
        F.lower("p_type").alias("property_type"), F.lit("2024-01-01").alias("first_seen"), F.lit("2024-01-02").alias("last_seen"),
    )


def current_properties(spark, sf_dir):
    name = F.when(F.col("p_brand") == "Brand#1", F.concat(F.lit("new "), "p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").where("p_size >= 5").select(
        F.lit("parts").alias("table_name"), F.concat(F.lit("p"), "p_partkey").alias("property_id"),
        name.alias("property_name"), column_name_of(name).alias("column_name"),
        F.when(F.col("p_retailprice") > 1000, "number").otherwise(F.lower("p_type")).alias("property_type"),
    )


@query(
    "schema_diff",
    f"""
WITH o AS ({_STORED_SQL}), c AS ({_CURRENT_SQL})
SELECT table_name, property_id, c.property_name AS new_name, c.column_name AS new_column, c.property_type AS new_type,
  o.property_name AS old_name, o.column_name AS old_column, o.property_type AS old_type,
  CASE WHEN o.property_name IS NULL THEN 'new' WHEN c.property_name IS NULL THEN 'disappeared'
    WHEN c.property_name <> o.property_name AND c.property_type <> o.property_type THEN 'renamed_and_type_changed'
    WHEN c.property_name <> o.property_name THEN 'renamed' WHEN c.property_type <> o.property_type THEN 'type_changed'
    ELSE 'same' END AS status
FROM c FULL JOIN o USING (table_name, property_id)""",
)
def schema_diff(spark, sf_dir):
    """O-J3, O-U3."""
    return evolve.schema_diff(current_properties(spark, sf_dir), stored_properties(spark, sf_dir))


@query(
    "schema_registry",
    f"""
WITH o AS ({_STORED_SQL}), c AS ({_CURRENT_SQL})
SELECT table_name, property_id, coalesce(c.property_name, o.property_name) AS property_name,
  coalesce(c.column_name, o.column_name) AS column_name, coalesce(c.property_type, o.property_type) AS property_type,
  coalesce(o.first_seen, '{RUN_TS}') AS first_seen,
  CASE WHEN c.property_name IS NOT NULL THEN '{RUN_TS}' ELSE o.last_seen END AS last_seen
FROM c FULL JOIN o USING (table_name, property_id)""",
)
def schema_registry(spark, sf_dir):
    """O-E7."""
    return evolve.upsert_registry(
        stored_properties(spark, sf_dir), current_properties(spark, sf_dir), ["table_name", "property_id"], RUN_TS
    )


@query(
    "option_registry",
    f"""
WITH c AS (
  SELECT 't' || p_partkey AS table_name, 'k' || p_partkey AS property_id, unnest([lower(p_type), p_brand]) AS option_id,
    unnest([p_type, p_brand]) AS option_name, CAST(NULL AS VARCHAR) AS option_group FROM part
  UNION ALL
  SELECT 't' || p_partkey, 's' || p_partkey, 's1', 'Open', 'To do' FROM part
  UNION ALL
  SELECT 't' || p_partkey, 's' || p_partkey, 's2', p_name, CASE WHEN p_size > 25 THEN 'To do' END FROM part),
o AS (SELECT 't' || p_partkey AS table_name, 's' || p_partkey AS property_id, unnest(['s2', 's3']) AS option_id FROM part)
SELECT table_name, property_id, option_id,
  CASE WHEN c.option_name IS NOT NULL THEN c.option_name ELSE 'Former' END AS option_name,
  CASE WHEN c.option_name IS NOT NULL THEN c.option_group ELSE 'Old group' END AS option_group,
  CASE WHEN o.option_id IS NULL THEN '{RUN_TS}' ELSE '2024-01-01' END AS first_seen,
  CASE WHEN c.option_name IS NULL THEN '2024-01-02' ELSE '{RUN_TS}' END AS last_seen
FROM c FULL JOIN o USING (table_name, property_id, option_id)""",
)
def option_registry(spark, sf_dir):
    """O-J5, O-E8."""
    current = evolve.options_of(pages.schema_rows(part_documents(spark, sf_dir)))
    stored = table(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), "p_partkey").alias("table_name"),
        F.concat(F.lit("s"), "p_partkey").alias("property_id"),
        F.explode(F.array(F.lit("s2"), F.lit("s3"))).alias("option_id"),
        F.lit("Former").alias("option_name"),
        F.lit("Old group").alias("option_group"),
        F.lit("2024-01-01").alias("first_seen"),
        F.lit("2024-01-02").alias("last_seen"),
    )
    return evolve.upsert_registry(stored, current, ["table_name", "property_id", "option_id"], RUN_TS)


# --- content and comments ----------------------------------------------------------------


def conversation_blocks(spark, sf_dir):
    """Turns as blocks: system = callout, user = paragraph, assistant = to-do when late,
    code when long, quote otherwise."""
    role, text = F.col("role"), F.col("text")
    kind = (
        F.when(role == "system", "callout").when(role == "user", "paragraph")
        .when(F.col("turn") >= 5, "to_do").when(F.length("text") > 400, "code").otherwise("quote")
    )
    rich = F.to_json(F.struct(_texts(text).alias("rich_text")))
    body = F.substr(rich, F.lit(2))
    extra = F.when(kind == "to_do", F.format_string('"checked":%s,', F.when(F.col("turn") > 6, "true").otherwise("false"))).when(
        kind == "code", F.lit('"language":"python",')
    ).otherwise(F.lit(""))
    raw = F.concat(F.lit('{"type":"'), kind, F.lit('","'), kind, F.lit('":{'), extra, body, F.lit("}"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("page_id"), F.col("turn").alias("position"), raw.alias("raw")
    )


@query(
    "content_text",
    """
SELECT CAST(conv_id AS VARCHAR) AS page_id, string_agg(
  CASE WHEN role = 'system' THEN '| ' || text WHEN role = 'user' THEN text
    WHEN turn > 6 THEN '[x] ' || text WHEN turn >= 5 THEN '[ ] ' || text
    WHEN length(text) > 400 THEN '[code:python] ' || text ELSE '> ' || text END, chr(10) ORDER BY turn) AS content_text
FROM conversations GROUP BY conv_id""",
)
def content_text(spark, sf_dir):
    """O-S4, O-A6."""
    return content.content_text(conversation_blocks(spark, sf_dir))


def comment_documents(spark, sf_dir):
    """Per turn a document with its comment, delivered a second time in an edited form. The draft spells its
    moment five hours further east, so its text sorts after that of the later edit."""
    day = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_interval(hours=F.col("turn").cast("int"))
    cid = F.concat("conv_id", F.lit("-"), "turn")

    def comment(edited, text):
        return F.struct(
            cid.alias("id"), iso(day).alias("created_time"), edited.alias("last_edited_time"), _texts(F.col("role"), text).alias("rich_text")
        )

    later = iso(day + F.expr("interval 30 minutes"))
    earlier = F.date_format(day + F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss'+05:00'")
    results = F.array(comment(later, F.concat(F.lit(": "), F.col("text"))), comment(earlier, F.lit(": draft")))
    return table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct(F.col("conv_id").cast("string").alias("page_id"), results.alias("results"))).alias("raw")
    )


_COMMENT_SQL = """
SELECT conv_id || '-' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS page_id,
  strftime(TIMESTAMP '2024-01-01' + to_hours(turn), '%Y-%m-%dT%H:%M:%SZ') AS created_time,
  strftime(TIMESTAMP '2024-01-01' + to_hours(turn) + INTERVAL {later}, '%Y-%m-%dT%H:%M:%S{zone}') AS last_edited_time,
  role || ': ' || {text} AS text
FROM conversations"""


@query(
    "comment_rows",
    _COMMENT_SQL.format(later="30 MINUTE", zone="Z", text="text") + " UNION ALL " + _COMMENT_SQL.format(later="5 HOUR", zone="+05:00", text="'draft'"),
)
def comment_rows(spark, sf_dir):
    """O-S5."""
    return content.comment_rows(comment_documents(spark, sf_dir))


@query(
    "comment_upsert",
    _COMMENT_SQL.format(later="30 MINUTE", zone="Z", text="text")
    + """ UNION ALL SELECT 'old-' || conv_id, CAST(conv_id AS VARCHAR), '2023-01-01', '2023-01-01', 'kept'
FROM conversations WHERE role = 'system'""",
)
def comment_upsert(spark, sf_dir):
    """O-K3 on O-S5: the store holds outdated user comments and some that get no update."""
    old = table(spark, sf_dir, "conversations")
    day = F.lit("2023-01-01")
    page = F.col("conv_id").cast("string").alias("page_id")
    outdated = old.where("role = 'user'").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("comment_id"), page, day.alias("created_time"),
        day.alias("last_edited_time"), F.lit("outdated").alias("text"),
    )
    kept = old.where("role = 'system'").select(
        F.concat(F.lit("old-"), "conv_id").alias("comment_id"), page, day.alias("created_time"),
        day.alias("last_edited_time"), F.lit("kept").alias("text"),
    )
    return upsert.upsert_comments(outdated.unionByName(kept), content.comment_rows(comment_documents(spark, sf_dir)))


# --- scans and sync ----------------------------------------------------------------------


@query(
    "incremental_scan",
    "SELECT event_id, user_id, ts AS last_edited_time FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 60 SECOND",
)
def incremental_scan(spark, sf_dir):
    """O-S2, O-E10: the watermark is stored by one run and read by the next."""
    store = scratch_tables(spark, "incremental")
    store.publish(meta={"last_sync:events": "2024-01-15T00:00:00+00:00"})
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").alias("last_edited_time"))
    return pages.edited_since(events, store.meta("last_sync:events"))


@query(
    "snapshot_lookup",
    f"""
WITH {TASK_CTES}
SELECT n.page_id, p.status, p.total_price FROM now_t n LEFT JOIN before_t p USING (page_id)""",
)
def snapshot_lookup(spark, sf_dir):
    """O-S7: stored rows of every id of the batch, NULL for unseen ones."""
    store = scratch_tables(spark, "lookup")
    store.publish(replace={"tasks_pages": tasks_before(spark, sf_dir)}, bucket_by={"tasks_pages": "page_id"})
    return store.pages_by_id("tasks", tasks_now(spark, sf_dir).select("page_id")).select("page_id", "status", "total_price")


TASK_DOC = _doc(
    **{"Status": "status", "Total Price": "number", "Due Date": "date", "Priority": "select", "Is Urgent": "checkbox"}
)


def task_documents(tasks):
    """Flat task rows back to raw page documents."""
    option = lambda name: F.when(F.col(name).isNotNull(), F.struct(F.col(f"{name}_id").alias("id"), F.col(name).alias("name")))
    props = F.struct(
        F.struct(option("status").alias("status")).alias("Status"),
        F.struct(F.col("total_price").alias("number")).alias("Total Price"),
        F.struct(F.struct(F.col("due_date_start").alias("start"), F.col("due_date_end").alias("end")).alias("date")).alias("Due Date"),
        F.struct(option("priority").alias("select")).alias("Priority"),
        F.struct(F.col("is_urgent").cast("boolean").alias("checkbox")).alias("Is Urgent"),
    )
    return tasks.select(
        F.to_json(F.struct(F.col("page_id").alias("id"), "created_time", "last_edited_time", "url", props.alias("properties"))).alias("raw")
    )


def _synced(spark, sf_dir, full):
    """Two runs over one store: the earlier state, then the current one."""
    store = scratch_tables(spark, "sync")
    cfg = sync.DatabaseConfig("tasks")
    first = sync.Landed(TASK_DOC, task_documents(tasks_before(spark, sf_dir)))
    second = sync.Landed(TASK_DOC, task_documents(tasks_now(spark, sf_dir)))
    sync.sync_database(store, cfg, first, "2000-01-01T00:00:00+00:00")
    sync.sync_database(store, cfg, second, RUN_TS, full=full)
    return store


def _typed_landing(spark, label, **dumps):
    """Dumps of documents landed as typed Parquet, a day each (``d2000_01_31``)."""
    path = scratch_dir(spark, label)
    for day, documents in dumps.items():
        pages.land_pages(documents, path, day[1:].replace("_", "-"))
    return pages.read_landed(spark, path)


@query(
    "landing_scan",
    f"""WITH {TASK_CTES}
SELECT page_id, last_edited_time, status, total_price FROM now_t WHERE last_edited_time >= '1999-12-31T23:59:00Z'""",
)
def landing_scan(spark, sf_dir):
    """O-S1, O-S2: an incremental scan of a typed landing reads no dump of an earlier day, and of the
    others only what was edited since the last run."""
    landed = _typed_landing(
        spark, "typed-landing", d1999_12_30=task_documents(tasks_before(spark, sf_dir)), d2024_02_01=task_documents(tasks_now(spark, sf_dir))
    )
    taken = sync.taken_pages(sync.Landed(TASK_DOC, landed), "2000-01-01T00:00:00+00:00", full=False)
    flat = pages.flatten_pages(taken, pages.parse_schema(TASK_DOC))
    return flat.select("page_id", "last_edited_time", "status", "total_price")


@query(
    "sync_rejects",
    f"""WITH {TASK_CTES}
SELECT page_id, 'Total Price' AS property, 'unpriced' AS value, '{RUN_TS}' AS detected_at
FROM now_t WHERE is_urgent AND total_price IS NOT NULL AND last_edited_time >= '1999-12-31T23:59:00Z'""",
)
def sync_rejects(spark, sf_dir):
    """O-P8, O-C9: an incremental run over a typed landing stores the values it could not read."""
    tables, cfg = scratch_tables(spark, "sync-rejects"), sync.DatabaseConfig("tasks")
    now = tasks_now(spark, sf_dir)
    unpriced = now.where("is_urgent")
    broken = task_documents(unpriced).select(F.regexp_replace("raw", '"number":[^}]*', '"number":"unpriced"').alias("raw"))
    landed = _typed_landing(
        spark, "rejects-landing", d1999_12_30=task_documents(tasks_before(spark, sf_dir)),
        d2024_02_01=broken.unionAll(task_documents(now.where("NOT is_urgent OR is_urgent IS NULL"))),
    )
    first = sync.Landed(TASK_DOC, landed.where("ingest_day < DATE '2000-01-01'"))
    sync.sync_database(tables, cfg, first, "2000-01-01T00:00:00+00:00")
    sync.sync_database(tables, cfg, sync.Landed(TASK_DOC, landed), RUN_TS)
    return tables.read("tasks_rejects")


@query("sync_batch", f"WITH {TASK_CTES}\n{changes_sql()}")
def sync_batch(spark, sf_dir):
    """O-C9, O-A4, O-E1, O-E10, O-E14, O-K1, O-K2, O-S7: the records of a second, full run."""
    changes = _synced(spark, sf_dir, full=True).read("tasks_changes")
    return changes.where(F.col("detected_at") == RUN_TS).drop("detected_date")


@query(
    "sync_incremental",
    f"""
WITH {TASK_CTES}, cols AS (
  SELECT *, CAST(is_urgent AS INTEGER) AS flag, last_edited_time >= '1999-12-31T23:59:00Z' AS recent FROM now_t
  UNION ALL
  SELECT *, CAST(is_urgent AS INTEGER), NULL FROM before_t
  WHERE page_id NOT IN (SELECT page_id FROM now_t WHERE last_edited_time >= '1999-12-31T23:59:00Z'))
SELECT * EXCLUDE (is_urgent, flag, recent), flag AS is_urgent, CAST(NULL AS VARCHAR) AS content_text
FROM cols WHERE recent IS NULL OR recent""",
)
def sync_incremental(spark, sf_dir):
    """O-C9, O-S2: the pages after an incremental second run."""
    return _synced(spark, sf_dir, full=False).read("tasks_pages")


@query("sync_empty", f"WITH {TASK_CTES}, none_t AS (SELECT * FROM before_t WHERE false)\n{changes_sql(before='none_t')}")
def sync_empty(spark, sf_dir):
    """O-C9, O-E14: a first run without pages, then the records of one with all of them."""
    store, cfg = scratch_tables(spark, "sync-empty"), sync.DatabaseConfig("tasks")
    documents = task_documents(tasks_now(spark, sf_dir))
    sync.sync_database(store, cfg, sync.Landed(TASK_DOC, documents.where("false")), "2000-01-01T00:00:00+00:00")
    sync.sync_database(store, cfg, sync.Landed(TASK_DOC, documents), RUN_TS, full=True)
    return store.read("tasks_changes").drop("detected_date")


@query(
    "sync_late",
    f"""WITH {TASK_CTES}
SELECT * REPLACE (CAST(is_urgent AS INTEGER) AS is_urgent), CAST(NULL AS VARCHAR) AS content_text FROM now_t""",
)
def sync_late(spark, sf_dir):
    """O-C9, O-K1: a full run that delivers older versions again changes no page."""
    store, cfg = scratch_tables(spark, "sync-late"), sync.DatabaseConfig("tasks")
    older = tasks_before(spark, sf_dir).withColumn("last_edited_time", F.col("created_time"))
    sync.sync_database(store, cfg, sync.Landed(TASK_DOC, task_documents(tasks_now(spark, sf_dir))), "2000-01-01T00:00:00+00:00")
    sync.sync_database(store, cfg, sync.Landed(TASK_DOC, task_documents(older)), RUN_TS, full=True)
    return store.read("tasks_pages")


@query(
    "latest_delivery",
    """
SELECT CAST(user_id AS VARCHAR) AS page_id, max(ts) AS last_edited_time, arg_max(event_type, (ts, event_id)) AS status,
  arg_max(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY user_id""",
)
def latest_delivery(spark, sf_dir):
    """One row per page within a batch, the newest delivery."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("page_id"), F.col("ts").alias("last_edited_time"), F.col("event_type").alias("status"), "event_id"
    )
    return skew.latest_per_key(rows, ["page_id"], ["last_edited_time", "event_id"])
