"""Upserts by key (O-K1, O-K3, O-E1, O-M10)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions.dates import to_timestamp
from fieldtrail.operators import skew


def widened(df: DataFrame, like: DataFrame) -> DataFrame:
    """O-E1: ``df`` with the columns of ``like`` it lacks, NULL in its rows."""
    have = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in like.schema if f.name not in have}
    return df.withColumns(missing) if missing else df


def aligned_types(prev: DataFrame, batch: DataFrame) -> DataFrame:
    """``prev`` with the type of each shared column taken from the batch, whose types are
    the declared ones. A stored value that does not fit the new type becomes NULL; a
    type change is backed up before it comes to this."""
    fresh = {f.name: f.dataType for f in batch.schema}

    def fitted(field: T.StructField):
        want = fresh.get(field.name, field.dataType)
        return F.col(field.name) if want == field.dataType else F.col(field.name).try_cast(want).alias(field.name)

    return prev.select(*[fitted(f) for f in prev.schema])


def not_older(
    batch: DataFrame, prev: DataFrame, key: str, order: Sequence[Callable[[Column], Column]], columns: Sequence[str],
    batch_is_small: bool = False, unread_as_given: bool = False,
) -> DataFrame:
    """The batch without rows older than the stored version of their key, so that a late or
    repeated delivery never wins. ``order`` reads a rank from each of ``columns``; a row whose
    first rank is NULL on either side stays. With ``unread_as_given`` two given values that both cannot
    be read are compared as ``latest_per_key`` does: by the other ranks, then as text."""
    have = [c for c in columns if c in prev.columns]
    if len(have) < len(columns):
        return batch

    first = columns[0]

    def unread(of: str) -> Column:
        return order[0](F.col(f"{of}{first}")).isNull()

    def rank(of: str) -> Column:
        ranks = [read(F.col(f"{of}{c}")).alias(c) for read, c in zip(order, columns)]
        given = F.when(unread(of), F.col(f"{of}{first}").cast("string")).alias("_given")
        return F.struct(*ranks, *([given] if unread_as_given else []))

    stored = prev.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_stored_{c}") for c in columns])
    if batch_is_small:
        stored = stored.join(F.broadcast(batch.select(F.col(key).alias("_key"))), "_key", "left_semi")
    unknown = unread("_stored_") | unread("")
    if unread_as_given:
        unknown &= ~(unread("_stored_") & unread("") & F.col(f"_stored_{first}").isNotNull() & F.col(first).isNotNull())
    joined = batch.join(stored, F.col(key) == F.col("_key"), "left")
    return joined.where(F.col("_key").isNull() | unknown | (rank("") >= rank("_stored_"))).select(*batch.columns)


def upsert(
    prev: DataFrame,
    batch: DataFrame,
    key: str = "page_id",
    mode: str = "merge",
    batch_is_small: bool = False,
) -> DataFrame:
    """O-K1. The batch holds one row per key; ``latest_per_key`` makes it so.

    ``merge`` overwrites the batch's columns and keeps the others; ``replace`` sets the
    others to NULL. With ``batch_is_small`` (a counted size) the stored rows are split by
    a broadcast of the batch keys and only the touched ones are joined, so a large table
    is not shuffled.
    """
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown upsert mode {mode!r}")
    prev = aligned_types(prev, batch)
    names = [*prev.columns, *[c for c in batch.columns if c not in prev.columns]]
    if mode == "replace":
        keys = batch.select(key)
        kept = prev.join(F.broadcast(keys) if batch_is_small else keys, key, "left_anti")
        return kept.unionByName(batch, allowMissingColumns=True).select(*names)
    if batch_is_small:
        keys = F.broadcast(batch.select(key))
        kept = prev.join(keys, key, "left_anti")
        touched = prev.join(keys, key, "left_semi")
        return kept.unionByName(_merged(touched, batch, key, names, "right"), allowMissingColumns=True).select(*names)
    return _merged(prev, batch, key, names, "full")


def _merged(prev: DataFrame, batch: DataFrame, key: str, names: list[str], how: str) -> DataFrame:
    fresh = batch.select(
        F.col(key).alias("_key"),
        F.struct(*[c for c in batch.columns if c != key], F.lit(True).alias("_b")).alias("_batch"),
    )
    joined = prev.join(fresh, prev[key] == fresh["_key"], how)
    in_batch = F.col("_batch").isNotNull()
    out = []
    for name in names:
        if name == key:
            out.append(F.coalesce(F.col("_key"), prev[key]).alias(key))
        elif name not in batch.columns:
            out.append(F.col(name))
        elif name not in prev.columns:
            out.append(F.col(f"_batch.{name}").alias(name))
        else:
            out.append(F.when(in_batch, F.col(f"_batch.{name}")).otherwise(F.col(name)).alias(name))
    return joined.select(*out)


def upsert_comments(prev: DataFrame, batch: DataFrame, batch_is_small: bool = False) -> DataFrame:
    """O-K3: the last edit of each comment wins within the batch, by the moment its text names, and the
    batch over the store."""
    latest = skew.latest_per_key(batch, ["comment_id"], ["last_edited_time"], [to_timestamp])
    return upsert(prev, latest, "comment_id", "replace", batch_is_small)


def mark_deleted(prev: DataFrame, present: DataFrame, run_ts: str, key: str = "page_id") -> DataFrame:
    """O-M10: pages missing from a full snapshot get ``deleted_at``; one that is back
    loses it. Never call this with an incremental batch."""
    here = present.select(F.col(key).alias("_here"))
    joined = prev.join(here, prev[key] == here["_here"], "left")
    before = F.col("deleted_at") if "deleted_at" in prev.columns else F.lit(None).cast("string")
    deleted_at = F.when(F.col("_here").isNull(), F.coalesce(before, F.lit(run_ts)))
    rest = [c for c in prev.columns if c != "deleted_at"]
    return joined.select(*rest, deleted_at.alias("deleted_at"))


def purge_deleted(pages: DataFrame, run_ts: str, lifespan_days: int) -> DataFrame:
    """O-M10: drops pages deleted longer ago than their lifespan."""
    age = F.lit(run_ts).cast("timestamp") - F.col("deleted_at").cast("timestamp")
    return pages.where(F.col("deleted_at").isNull() | (age <= F.expr(f"interval {int(lifespan_days)} days")))
