"""The incremental sync of one or more databases (O-C9, O-A4, O-E13)."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldtrail.functions.dates import to_timestamp
from fieldtrail.functions.names import column_name, excluded_fields, expand_split_dates, shadow_id_columns
from fieldtrail.operators import diff, evolve, history, skew, upsert
from fieldtrail.sources import content, pages as page_source
from fieldtrail.sources.tables import BACKUP_REGISTRY, PART, Tables, in_buckets, in_parts

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DatabaseConfig:
    """The options of one database; names in the lists are property names."""

    name: str
    include_columns: Sequence[str] = ()
    exclude_columns: Sequence[str] = ()
    include_content: bool = True
    include_comments: bool = True
    track_changes: bool = True
    change_fields: Sequence[str] = ()
    exclude_change_fields: Sequence[str] = ()
    column_renames: Mapping[str, str] = field(default_factory=dict)
    files_handling: str = "bool"
    upsert_mode: str = "merge"


@dataclass(frozen=True)
class Landed:
    """What was landed for one run: the schema document and, as DataFrames, raw page
    documents (``raw``, or typed as ``read_landed`` gives them), blocks (``page_id, position, raw``)
    and comment documents."""

    schema_doc: str
    pages: DataFrame
    blocks: DataFrame | None = None
    comments: DataFrame | None = None


@dataclass
class SyncResult:
    name: str
    version: int | None
    pages: int = 0
    changes: int = 0
    comments: int = 0
    backfilled: int = 0
    rejected: int = 0
    seconds: float = 0.0
    messages: list[str] = field(default_factory=list)


@dataclass
class SyncPlan:
    """The lazy outcome of a run; publishing it is the only side effect there is. The flat
    rows it was made from are staged until ``close``, also by a dry run."""

    store: Tables
    staged: str
    delivered: DataFrame
    #: The delivered rows that are not older than the stored ones.
    batch: DataFrame
    pages: DataFrame
    #: Key buckets ``pages`` covers; None when it is the whole table.
    buckets: list[int] | None
    new_changes: DataFrame | None
    #: The rewritten rows of the history parts a rename or refresh touches, and those
    #: parts; the others stay as they are.
    rewritten_changes: DataFrame | None
    rewritten_parts: list[str]
    #: Values of the pages taken in that could not be read.
    rejects: DataFrame
    comments: DataFrame | None
    registries: dict[str, DataFrame]
    messages: list[str]
    backfilled: int = 0
    renamed_options: bool = False

    def close(self) -> None:
        self.store.unstage(self.staged)

    def __enter__(self) -> SyncPlan:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def taken_pages(landed: Landed, last_sync: str | None, full: bool) -> DataFrame:
    """O-S2: the landed documents to take in. Of a typed landing only the days and row groups
    that can hold them are read; of raw text the edit time alone is read first, so that only
    these are parsed with all properties."""
    pages = landed.pages
    if "last_edited_time" not in pages.columns:
        pages = pages.withColumn("last_edited_time", page_source.edit_time())
    return page_source.edited_since(pages, last_sync, full=full).select("raw")


def flatten_batch(landed: Landed, cfg: DatabaseConfig, last_sync: str | None, full: bool) -> DataFrame:
    """Flat rows of the pages to take in, the newest delivery of each page, with content."""
    props = page_source.parse_schema(landed.schema_doc)
    rows = page_source.flatten_pages(
        taken_pages(landed, last_sync, full), props, cfg.include_columns, cfg.exclude_columns, cfg.files_handling
    ).withColumn("_edited", to_timestamp(F.col("last_edited_time")))
    recent = page_source.edited_since(
        rows.withColumnRenamed("last_edited_time", "_edited_text").withColumnRenamed("_edited", "last_edited_time"),
        last_sync,
        full=full,
    )
    rows = recent.withColumnRenamed("last_edited_time", "_edited").withColumnRenamed("_edited_text", "last_edited_time")
    batch = skew.latest_per_key(rows, ["page_id"], ["_edited"]).drop("_edited")
    if cfg.include_content and landed.blocks is not None:
        # The ids alone are read for this, without picking the newest deliveries again.
        wanted = landed.blocks.join(rows.select("page_id"), "page_id", "left_semi")
        batch = batch.join(content.content_text(wanted), "page_id", "left")
    return batch


def plan_sync(store: Tables, cfg: DatabaseConfig, landed: Landed, run_ts: str, full: bool = False) -> SyncPlan:
    """Evolve, read, flatten, compare and upsert one database; nothing is published."""
    spark, name = store.spark, cfg.name
    pages = store.read(f"{name}_pages")
    # The name a record had is kept beside it, to see which parts a rename reaches.
    changes = history.with_option_ids(store.read(f"{name}_changes", layout=True)).withColumn("_field", F.col("field"))
    messages: list[str] = []
    reshaped = fields_moved = False

    for old, new in cfg.column_renames.items():
        pages, changes, moved = evolve.apply_declared_rename(pages, changes, column_name(old), column_name(new))
        if moved:
            reshaped = fields_moved = True
            messages.append(f"applied declared rename '{old}' to '{new}'")

    # Schema: a handful of rows per database, so the differences are planned on the driver.
    docs = spark.createDataFrame([(name, landed.schema_doc)], "table_name string, doc string")
    schema_rows = page_source.schema_rows(docs)
    current = evolve.property_registry(schema_rows)
    stored = store.read("_schema").where(F.col("table_name") == name)
    all_backups = store.read("_backups")
    known_backups = all_backups.where(F.col("table_name") == name).collect()  # at most one per column and type
    backups = {(r.column_name, r.type): r.backup_column for r in known_backups}
    made = {r.backup_column: r.created_at for r in known_backups}
    differences = [r.asDict() for r in evolve.schema_diff(current, stored).collect()]
    evolved = evolve.evolve(pages, changes, differences, backups, run_ts)
    pages, changes = evolved.pages, evolved.changes
    reshaped = reshaped or evolved.changed_pages
    fields_moved = fields_moved or evolved.moved_fields
    messages += evolved.messages

    keys = {"_schema": ["table_name", "property_id"], "_options": ["table_name", "property_id", "option_id"]}
    registries = {
        "_schema": evolve.upsert_registry(store.read("_schema"), current, keys["_schema"], run_ts),
        "_options": evolve.upsert_registry(
            store.read("_options"), evolve.options_of(schema_rows), keys["_options"], run_ts
        ),
    }
    if evolved.backups != backups:
        # A backup keeps the time it was made, also when its column was renamed since.
        rows = [(name, c, b, t, made.get(b, run_ts)) for (c, t), b in evolved.backups.items()]
        own = spark.createDataFrame(rows, BACKUP_REGISTRY)
        registries["_backups"] = all_backups.where(F.col("table_name") != name).unionByName(own)

    staged = store.stage(f"{name}_delivered", flatten_batch(landed, cfg, store.meta(f"last_sync:{name}"), full))
    try:
        return _compared(store, cfg, landed, run_ts, full, staged, pages, changes, registries, messages, reshaped, fields_moved)
    except Exception:
        store.unstage(staged)
        raise


def _compared(
    store: Tables, cfg: DatabaseConfig, landed: Landed, run_ts: str, full: bool, staged: str, pages: DataFrame,
    changes: DataFrame, registries: dict[str, DataFrame], messages: list[str], reshaped: bool,
    fields_moved: bool,
) -> SyncPlan:
    """The part of a plan that reads pages."""
    name, delivered = cfg.name, store.staged(staged)
    small = skew.fits_broadcast(delivered.select("page_id"))
    unreadable = delivered.where(to_timestamp(F.col("last_edited_time")).isNull()).limit(1000).count()
    if unreadable:
        messages.append(f"{unreadable if unreadable < 1000 else 'at least 1000'} pages without a readable last_edited_time were taken in")

    # A run that reshapes no column reads and rewrites only the buckets of its pages. A column
    # of another type than the stored one reshapes all of them.
    types = {f.name: f.dataType for f in pages.schema}
    reshaped = reshaped or any(types.get(f.name, f.dataType) != f.dataType for f in delivered.schema)
    buckets = None if reshaped else store.touched_buckets(f"{name}_pages", delivered, "page_id")
    if buckets is not None:
        pages = store.read_buckets(f"{name}_pages", buckets)
    batch = upsert.not_older(delivered, pages, "page_id", [lambda c: to_timestamp(c)], ["last_edited_time"], small)

    backfilled, new_changes, rewritten, parts = 0, None, None, []
    options = registries["_options"].where(F.col("table_name") == name)
    known = store.read("_options").where(F.col("table_name") == name)
    renamed_options = cfg.track_changes and history.names_differ(known, options)
    # Records made in a run still hold the names before it, so the run after a rename looks again.
    refresh = renamed_options or store.meta(f"options_renamed:{name}") == "yes"
    if store.exists(f"{name}_changes") and (refresh or fields_moved):
        if refresh:
            changes = history.backfill_option_names(changes, options)
        else:
            changes = changes.withColumns({"old_updated": F.lit(False), "new_updated": F.lit(False)})
        refreshed = F.col("old_updated").cast("long") + F.col("new_updated").cast("long")
        moved = F.col("field") != F.col("_field")
        reached = (
            changes.groupBy(PART)
            .agg(F.sum(refreshed).alias("refreshed"), F.count_if(moved).alias("moved"))
            .where("refreshed > 0 OR moved > 0")
            .collect()  # at most one row per earlier run
        )
        parts, backfilled = [r[PART] for r in reached], sum(r["refreshed"] for r in reached)
        if parts:
            helpers = (PART, "_field", "old_updated", "new_updated", "detected_date")
            rewritten = changes.where(F.col(PART).isin(parts)).drop(*helpers)
    if cfg.track_changes:
        props = page_source.projected(
            page_source.parse_schema(landed.schema_doc), cfg.include_columns, cfg.exclude_columns
        )
        tracked = expand_split_dates([column_name(f) for f in cfg.change_fields], batch.columns)
        excluded = expand_split_dates(
            excluded_fields(cfg.exclude_change_fields, shadow_id_columns(props)), batch.columns
        )
        new_changes = diff.detect_changes(batch, pages, run_ts, tracked, excluded, batch_is_small=small)

    comments = None
    if cfg.include_comments and landed.comments is not None:
        rows = content.comment_rows(landed.comments)
        if not full:
            rows = rows.join(batch.select("page_id"), "page_id", "left_semi")
        comments = rows
    return SyncPlan(
        store=store,
        staged=staged,
        delivered=delivered,
        batch=batch,
        renamed_options=renamed_options,
        pages=upsert.upsert(pages, batch, mode=cfg.upsert_mode, batch_is_small=small),
        buckets=buckets,
        new_changes=new_changes,
        rewritten_changes=rewritten,
        rewritten_parts=parts,
        rejects=page_source.rejected_values(
            taken_pages(landed, store.meta(f"last_sync:{name}"), full), page_source.parse_schema(landed.schema_doc),
            cfg.include_columns, cfg.exclude_columns, cfg.files_handling,
        ).withColumn("detected_at", F.lit(run_ts)),
        comments=comments,
        registries=registries,
        messages=messages,
        backfilled=backfilled,
    )


def sync_database(store: Tables, cfg: DatabaseConfig, landed: Landed, run_ts: str, full: bool = False) -> SyncResult:
    """One run: plan, then publish pages, history, comments, unread values, registries and
    the watermark together. ``run_ts`` is the moment before the pages were landed."""
    start = time.monotonic()
    plan = plan_sync(store, cfg, landed, run_ts, full)
    name = cfg.name
    result = SyncResult(name, None, messages=plan.messages, backfilled=plan.backfilled)
    seen = {}

    def observed(what: str, df: DataFrame) -> DataFrame:
        seen[what] = Observation(what)
        return df.observe(seen[what], F.count(F.lit(1)).alias("n"))

    try:
        replace, append, retire = dict(plan.registries), {}, {}
        if plan.buckets is None:
            replace[f"{name}_pages"] = plan.pages
        else:
            append[f"{name}_pages"] = plan.pages
            retire[f"{name}_pages"] = in_buckets(plan.buckets)
        append[f"{name}_rejects"] = observed("rejects", plan.rejects)
        records = []
        if plan.new_changes is not None:
            records.append(observed("changes", plan.new_changes))
        if plan.rewritten_changes is not None:
            records.append(plan.rewritten_changes)
            retire[f"{name}_changes"] = in_parts(plan.rewritten_parts)
        if records:
            append[f"{name}_changes"] = _dated(reduce(DataFrame.unionByName, records))
        if plan.comments is not None:
            fresh = observed("comments", plan.comments)
            touched = store.touched_buckets(f"{name}_comments", plan.comments, "comment_id")
            comments = upsert.upsert_comments(store.read_buckets(f"{name}_comments", touched), fresh)
            if touched is None:
                replace[f"{name}_comments"] = comments
            else:
                append[f"{name}_comments"] = comments
                retire[f"{name}_comments"] = in_buckets(touched)
        result.version = store.publish(
            replace,
            append,
            {f"last_sync:{name}": run_ts, f"options_renamed:{name}": "yes" if plan.renamed_options else "no"},
            partition_by={f"{name}_changes": ["detected_date"]},
            bucket_by={f"{name}_pages": "page_id", f"{name}_comments": "comment_id"},
            retire=retire,
        )
        result.pages = plan.batch.count()
        result.rejected = seen["rejects"].get["n"]
        if result.rejected:
            result.messages.append(f"{result.rejected} values could not be read; see {name}_rejects")
        result.changes = seen["changes"].get["n"] if "changes" in seen else 0
        result.comments = seen["comments"].get["n"] if "comments" in seen else 0
    finally:
        plan.close()
    result.seconds = time.monotonic() - start
    log.info("[%s] %d pages, %d changes, %d comments in %.1f s", name, result.pages, result.changes, result.comments, result.seconds)
    return result


def _dated(changes: DataFrame) -> DataFrame:
    return changes.withColumn("detected_date", F.substring("detected_at", 1, 10))


def sync_all(
    store: Tables, databases: Mapping[str, tuple[DatabaseConfig, Landed]], run_ts: str, full: bool = False
) -> dict[str, SyncResult | Exception]:
    """Every database in turn; one that fails keeps its old version and watermark and
    does not stop the others."""
    outcome: dict[str, SyncResult | Exception] = {}
    for name, (cfg, landed) in databases.items():
        try:
            outcome[name] = sync_database(store, cfg, landed, run_ts, full)
        except Exception as e:
            log.error("[%s] sync failed: %s", name, e)
            outcome[name] = e
    return outcome


