"""Tracked tables as Spark tables of one database, and the table of finished runs (O-S6, O-S7, O-E10, O-E14).

A run only ever appends: to each table a part, the value of its first partition column, named
by the run and the key bucket. The ``runs`` table gets the run's rows last: the parts that make up
each table from then on, and the watermark. Readers take the newest row of each table and
filter by its parts, which prunes partitions, so a run that failed before its last write is
never seen, whatever it left behind.

Large keyed tables are dealt into buckets of their key. A run that touches few keys reads and
writes only their buckets; the parts of the others stay listed. A table whose buckets have outgrown
their size is written anew by the next run. ``compact`` joins small parts, ``vacuum`` drops the
Spark tables that are no longer named.

The catalog must outlive the session (a Hive metastore, say) for the tables to do so. Writers take
turns: the schedule keeps to one active run, and one that finds a newer version than it began
with is refused.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from dataclasses import replace as changed

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.operators.diff import CHANGES_SCHEMA


def _text_table(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


PAGES_SCHEMA = _text_table("page_id", "created_time", "last_edited_time", "url", "content_text")
COMMENTS_SCHEMA = _text_table("comment_id", "page_id", "created_time", "last_edited_time", "text")
REJECTS_SCHEMA = _text_table("page_id", "property", "value", "detected_at")
SCHEMA_REGISTRY = _text_table(
    "table_name", "property_id", "property_name", "column_name", "property_type", "first_seen", "last_seen"
)
OPTION_REGISTRY = _text_table(
    "table_name", "property_id", "option_id", "option_name", "option_group", "first_seen", "last_seen"
)
BACKUP_REGISTRY = _text_table("table_name", "column_name", "backup_column", "type", "created_at")

_EMPTY = {"_schema": SCHEMA_REGISTRY, "_options": OPTION_REGISTRY, "_backups": BACKUP_REGISTRY}
_SUFFIXES = {
    "_pages": PAGES_SCHEMA, "_changes": CHANGES_SCHEMA, "_comments": COMMENTS_SCHEMA, "_rejects": REJECTS_SCHEMA,
}
#: Tables of one run written at the same time; those that held more than a bucket before take turns.
WRITERS = 4
#: Half a history are the hex digits of its ids, which zstd packs into half their bytes and Spark's default does not.
CODEC = "zstd"
#: Rows a bucket of a keyed table should hold; a run writes a table anew once its buckets
#: hold twice as many.
BUCKET_ROWS = 2_000_000
#: The partition column that names run and bucket.
PART = "_part"
#: One row per table or setting a run changed; ``value`` is a table's columns or a setting's value.
RUNS = "runs"
RUNS_SCHEMA = (
    "version bigint, run string, kind string, name string, value string, data_table string, "
    "partition_by array<string>, bucket_key string, buckets int, parts array<struct<part: string, row_count: bigint>>"
)


class ConflictError(RuntimeError):
    """Another run has finished since these tables were looked at; nothing was published."""


@dataclass(frozen=True)
class Entry:
    """What the newest finished run says of a table. ``parts`` maps a part to its rows."""

    kind: str
    columns: T.StructType
    data_table: str
    partition_by: tuple[str, ...] = ()
    bucket_key: str | None = None
    buckets: int = 1
    parts: Mapping[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.parts.values())


@dataclass(frozen=True)
class State:
    version: int = 0
    tables: Mapping[str, Entry] = field(default_factory=dict)
    settings: Mapping[str, str] = field(default_factory=dict)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def merged_schema(name: str, old: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both. A column cannot change its type in an append: the parts that
    stay could no longer be read with it."""
    types = {f.name: f.dataType for f in old}
    clash = [f.name for f in new if types.get(f.name, f.dataType) != f.dataType]
    if clash:
        raise ValueError(f"table {name!r} has other types for {clash}; replace it instead of appending")
    return T.StructType([*_nullable(old), *[f for f in _nullable(new) if f.name not in types]])


def bucket_of(part: str) -> int:
    return int(part.rsplit("-", 1)[1])


class Tables:
    """The tables of one database; any number of readers, writers take turns."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark, self.database = spark, database
        self._current: State | None = None
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")

    # -- reading ---------------------------------------------------------------------

    def refresh(self) -> None:
        """Look for newer runs at the next read; until then the version found first stays."""
        self._current = None

    def _at(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _newest(self) -> State:
        """The newest row per table and per setting; at most a row per table reaches the driver."""
        runs = self._at(RUNS)
        if not self.spark.catalog.tableExists(runs):
            return State()
        self.spark.catalog.refreshTable(runs)
        is_setting = (F.col("kind") == "setting").alias("is_setting")
        newest = self.spark.table(runs).groupBy(is_setting, "name").agg(
            F.max_by(F.struct("*"), F.struct("version", "run")).alias("row")
        )
        rows = [r["row"] for r in newest.collect()]
        tables = {
            r.name: Entry(
                r.kind, T.StructType.fromJson(json.loads(r.value)), r.data_table, tuple(r.partition_by), r.bucket_key,
                r.buckets, {p.part: p.row_count for p in r.parts},
            )
            for r in rows
            if r.kind not in ("setting", "dropped", "run")
        }
        settings = {r.name: r.value for r in rows if r.kind == "setting"}
        return State(max(r.version for r in rows), tables, settings)

    def _state(self) -> State:
        if self._current is None:
            self._current = self._newest()
            for entry in self._current.tables.values():
                self.spark.catalog.refreshTable(self._at(entry.data_table))
        return self._current

    def tables(self, kind: str | None = None) -> list[str]:
        return sorted(n for n, t in self._state().tables.items() if kind in (None, t.kind))

    def exists(self, name: str) -> bool:
        return name in self._state().tables

    def parts(self, name: str) -> list[str]:
        """The parts that make up a table now."""
        entry = self._state().tables.get(name)
        return sorted(entry.parts) if entry else []

    def schema(self, name: str) -> T.StructType:
        """The stored columns, or the fixed ones of a table never written."""
        entry = self._state().tables.get(name)
        if entry is not None:
            return entry.columns
        schema = _EMPTY.get(name) or next((s for suffix, s in _SUFFIXES.items() if name.endswith(suffix)), None)
        if schema is None:
            raise KeyError(f"table {name!r} does not exist")
        return schema

    def read(self, name: str, layout: bool = False, parts: Sequence[str] | None = None) -> DataFrame:
        """The current rows, or those of some parts; with ``layout`` the part stays as a column."""
        entry, extra = self._state().tables.get(name), [PART] if layout else []
        chosen = sorted(entry.parts if parts is None else parts) if entry else []
        if not chosen:
            columns = [*self.schema(name), *(T.StructField(c, T.StringType()) for c in extra)]
            return self.spark.createDataFrame([], T.StructType(columns))
        data = self.spark.table(self._at(entry.data_table))
        return data.where(F.col(PART).isin(chosen)).select(*entry.columns.names, *extra)

    def buckets(self, name: str) -> int:
        """How many key buckets a table is dealt into."""
        entry = self._state().tables.get(name)
        return entry.buckets if entry else 1

    def outgrown(self, name: str) -> bool:
        """Whether a table's buckets hold so much that it should be written anew."""
        entry = self._state().tables.get(name)
        return entry is not None and entry.rows > 2 * BUCKET_ROWS * entry.buckets

    def touched_buckets(self, name: str, keys: DataFrame, key: str) -> list[int] | None:
        """The buckets of the given keys; None if the whole table is to be written: it has
        one bucket, or has outgrown those it has."""
        if self.buckets(name) == 1 or self.outgrown(name):
            return None
        return [r[0] for r in keys.select(_bucket(key, self.buckets(name))).distinct().collect()]

    def read_buckets(self, name: str, buckets: Sequence[int] | None) -> DataFrame:
        """The rows of some buckets; the partitions of the others are not read."""
        if buckets is None:
            return self.read(name)
        wanted = set(buckets)
        return self.read(name, parts=[p for p in self.parts(name) if bucket_of(p) in wanted])

    def page_ids(self, table: str) -> DataFrame:
        """O-S7: the known keys."""
        return self.read(f"{table}_pages").select("page_id")

    def pages_by_id(self, table: str, ids: DataFrame) -> DataFrame:
        """O-S7: stored rows of the given ids, NULL columns for unseen ones."""
        return ids.join(self.read(f"{table}_pages"), "page_id", "left")

    def meta(self, key: str) -> str | None:
        """O-E10: a setting of the newest finished run, such as a watermark."""
        return self._state().settings.get(key)

    def register_views(self) -> list[str]:
        """O-S6, O-S8: every table as a temporary view of the version current now."""
        names = self.tables()
        for name in names:
            self.read(name).createOrReplaceTempView(name)
        return names

    # -- publishing ------------------------------------------------------------------

    def publish(
        self,
        replace: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame] | None = None,
        meta: Mapping[str, str] | None = None,
        drop: Sequence[str] = (),
        partition_by: Mapping[str, Sequence[str]] | None = None,
        bucket_by: Mapping[str, str] | None = None,
        retire: Mapping[str, Callable[[str], bool]] | None = None,
        kind: str = "table",
    ) -> int:
        """Appends every table's new part, then the rows of the run; returns the new version.

        ``append`` adds parts to a table; ``retire`` tells which of its older parts the added
        rows supersede. ``bucket_by`` names the key of a table dealt into buckets: a replaced
        one gets as many as its rows need, an appended one keeps them.
        """
        before = self._state()
        run = f"{before.version + 1:012d}_{uuid.uuid4().hex[:8]}"
        fresh = {**(replace or {}), **(append or {})}

        def write(name: str) -> Entry:
            known = before.tables.get(name)
            old = known if name in (append or {}) else None
            columns = _nullable(fresh[name].schema)
            if old:
                superseded = (retire or {}).get(name, lambda part: False)
                stay = {p: n for p, n in old.parts.items() if not superseded(p)}
                entry = changed(old, columns=merged_schema(name, old.columns, columns), parts=stay)
            else:
                key = (bucket_by or {}).get(name)
                buckets = 1 if known is None or not key else max(known.buckets, math.ceil(known.rows / BUCKET_ROWS))
                layout = tuple((partition_by or {}).get(name, ()))
                entry = Entry(kind, columns, self._data_table(name, known, columns, layout), layout, key, buckets)
            return changed(entry, parts={**entry.parts, **self._append(fresh[name], entry, run)})

        # The tables do not depend on each other, so small ones fill the gaps of large ones. Those come one
        # by one: the shuffle files of the one before are gone then.
        large = [n for n in fresh if n in before.tables and before.tables[n].rows > BUCKET_ROWS]
        turns = [large, *([n] for n in fresh if n not in large)]
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:
            done = pool.map(lambda names: {n: write(n) for n in names}, turns)
            written = {n: entry for turn in done for n, entry in turn.items()}
        after = State(
            before.version + 1,
            {**{n: t for n, t in before.tables.items() if n not in drop}, **written},
            {**before.settings, **(meta or {})},
        )
        self._finish(after.version, run, written, meta or {}, drop)
        self._current = after
        return after.version

    def _data_table(self, name: str, known: Entry | None, columns: T.StructType, layout: tuple[str, ...]) -> str:
        """The Spark table that holds a replaced table: the one it had if no column goes or changes its type."""
        if known is not None and known.partition_by == layout:
            types = {f.name: f.dataType for f in columns}
            if all(types.get(f.name) == f.dataType for f in known.columns):
                return known.data_table
        plain = re.sub(r"\W", "_", name, flags=re.ASCII).lower()
        return f"data_{plain}_{uuid.uuid4().hex[:8]}"

    def _append(self, df: DataFrame, entry: Entry, run: str) -> dict[str, int]:
        """Writes one part per bucket; returns those that got rows."""
        where = self._at(entry.data_table)
        part = F.lit(f"{run}-0")
        if entry.buckets > 1:
            part = F.concat(F.lit(f"{run}-"), _bucket(entry.bucket_key, entry.buckets).cast("string"))
        df = df.withColumn(PART, part)
        if entry.buckets > 1:
            # Buckets meet by chance in a few of so few hash partitions; rebalancing splits what is too large.
            df = df.hint("rebalance", PART)
        if not self.spark.catalog.tableExists(where):
            df.write.format("parquet").option("compression", CODEC).partitionBy(PART, *entry.partition_by).saveAsTable(where)
        else:
            held = set(self.spark.table(where).columns)
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entry.columns if f.name not in held)
            if added:
                self.spark.sql(f"ALTER TABLE {where} ADD COLUMNS ({added})")
            given = set(df.columns)
            row = [F.col(f"`{c}`") if c in given else F.lit(None).alias(c) for c in self.spark.table(where).columns]
            df.select(*row).write.insertInto(where)
        counted = self.spark.table(where).where(F.col(PART).startswith(run)).groupBy(PART).count()
        return {r[PART]: r["count"] for r in counted.collect()}  # one row per bucket

    def _finish(self, version: int, run: str, written: Mapping[str, Entry], meta: Mapping[str, str], drop: Sequence[str]) -> None:
        """The last write of a run: one file with its rows."""
        empty = (None, None, None, None, None)
        rows = [
            (
                version, run, e.kind, n, e.columns.json(), e.data_table, list(e.partition_by), e.bucket_key, e.buckets,
                [Row(part=p, row_count=c) for p, c in sorted(e.parts.items())],
            )
            for n, e in written.items()
        ]
        rows += [(version, run, "setting", k, v, *empty) for k, v in meta.items()]
        rows += [(version, run, "dropped", n, None, *empty) for n in drop if n not in written]
        rows.append((version, run, "run", "", None, *empty))
        if self._newest().version != version - 1:
            raise ConflictError(f"version {version} of {self.database!r} was published by another run")
        df = self.spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1)
        df.write.format("parquet").mode("append").saveAsTable(self._at(RUNS))

    # -- rows of a run in progress ---------------------------------------------------

    def stage(self, name: str, df: DataFrame) -> str:
        """Writes rows that a run reads several times as a Spark table of its own; returns its name. What an
        executor keeps instead takes several times the space, and its shuffle files stay as long."""
        table = f"stage_{re.sub(r'\W', '_', name, flags=re.ASCII).lower()}_{uuid.uuid4().hex[:8]}"
        df.write.format("parquet").option("compression", CODEC).saveAsTable(self._at(table))
        return table

    def staged(self, table: str) -> DataFrame:
        return self.spark.table(self._at(table))

    def unstage(self, table: str) -> None:
        """Drops staged rows; those of a run that did not come to it are dropped by ``vacuum``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._at(table)}")

    # -- upkeep ----------------------------------------------------------------------

    def compact(self, name: str, below_rows: int = BUCKET_ROWS) -> int:
        """Joins the parts of an appended table that hold fewer rows; the larger ones are not
        read. Returns how many were joined. Tables in buckets have one part per bucket already."""
        entry = self._state().tables[name]
        small = [p for p, n in entry.parts.items() if n < below_rows] if entry.bucket_key is None else []
        if len(small) > 1:
            self.publish(append={name: self.read(name, parts=small)}, retire={name: in_parts(small)})
        return len(small) if len(small) > 1 else 0

    def vacuum(self) -> list[str]:
        """Drops the Spark tables that no table is held in any more. Not beside readers of older
        versions or a run in progress."""
        self.refresh()
        named = {RUNS, *(t.data_table for t in self._state().tables.values())}
        listed = self.spark.catalog.listTables(self.database)
        stale = sorted(t.name for t in listed if not t.isTemporary and t.name not in named)
        for table in stale:
            self.spark.sql(f"DROP TABLE {self._at(table)}")
        return stale


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def in_parts(parts: Sequence[str]) -> Callable[[str], bool]:
    """The given parts."""
    return set(parts).__contains__


def in_buckets(buckets: Sequence[int]) -> Callable[[str], bool]:
    """Parts of the given key buckets."""
    wanted = set(buckets)
    return lambda part: bucket_of(part) in wanted
