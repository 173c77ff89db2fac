"""Change detection over newly landed pages as a stream (O-T1, O-T2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtrail.functions.dates import to_timestamp
from fieldtrail.operators import diff, skew, upsert
from fieldtrail.sources.tables import Tables, in_buckets


def without_redeliveries(stream: DataFrame, key: str = "page_id", edited: str = "last_edited_time") -> DataFrame:
    """O-T2: edits arriving up to 60 seconds late are taken, each edit once. For sources
    that deliver again; file sources deliver once."""
    return stream.withWatermark(edited, "60 seconds").dropDuplicatesWithinWatermark([key, edited])


def _moment(c: Column) -> Column:
    return to_timestamp(c.cast("string"))


def batch_writer(
    store: Tables,
    table: str,
    run_ts: Callable[[DataFrame, int], str],
    order: Sequence[str] = ("last_edited_time",),
    change_fields: Sequence[str] = (),
    exclude_change_fields: Sequence[str] = (),
    moments: Sequence[str] = ("last_edited_time",),
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: newest version per page, compared with the stored
    pages, both published in one commit with the batch number. Text in the ``moments`` columns of
    ``order`` is compared as the moment it names, whatever its offset; two that name none are compared as
    text. A version older than the stored one of its page is passed over. A batch that is replayed
    after a failure finds its number published and does nothing, so the history gets
    every record once."""

    marker = f"stream_batch:{table}"
    reads = [_moment if c in moments else (lambda c: c) for c in order]

    def write(batch: DataFrame, number: int) -> None:
        done = store.meta(marker)
        if done is not None and int(done) >= number:
            return
        newest = latest = skew.latest_per_key(batch, ["page_id"], order, reads).persist()
        try:
            if latest.isEmpty():
                return
            small = skew.fits_broadcast(latest.select("page_id"))
            now = run_ts(latest, number)
            buckets = store.touched_buckets(f"{table}_pages", latest, "page_id")
            stored = store.read_buckets(f"{table}_pages", buckets)
            latest = upsert.not_older(latest, stored, "page_id", reads, list(order), small, unread_as_given=True)
            changes = diff.detect_changes(latest, stored, now, change_fields, exclude_change_fields, small)
            pages = {f"{table}_pages": upsert.upsert(stored, latest, batch_is_small=small)}
            records = {f"{table}_changes": changes.withColumn("detected_date", F.substring("detected_at", 1, 10))}
            store.publish(
                replace=pages if buckets is None else {},
                append=records if buckets is None else {**records, **pages},
                meta={marker: str(number)},
                partition_by={f"{table}_changes": ["detected_date"]},
                bucket_by={f"{table}_pages": "page_id"},
                retire={} if buckets is None else {f"{table}_pages": in_buckets(buckets)},
            )
        finally:
            newest.unpersist()

    return write


def run_available(
    stream: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """O-T1: takes in everything landed since the last call and returns when done; the
    checkpoint holds the position, the tables the state."""
    query = (
        stream.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
