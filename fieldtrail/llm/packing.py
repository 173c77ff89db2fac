"""Bounded-space online packing of token sequences.

``pack`` tokenises whole documents and fills sequences of at most ``seq_len`` ids. Each partition
reads its documents once and keeps ``open_windows`` windows open. A document's full windows leave
at once; its rest goes where it leaves the least room (best fit). When it fits nowhere, the fullest
window takes a piece of it that fills it and is emitted, so windows leave a partition without
padding. What is still open at the end of a partition is merged: the leftovers of ``MERGE``
partitions at a time go through the same packer, and the last windows of a merge are cut into
sequences of a power of two, which need no padding.

Memory is one document, one Arrow batch and the open windows; a merge task holds
``MERGE * open_windows`` windows at most, whatever the size of the input.

Cases: a NULL or empty text is the end id alone; an empty table gives no rows; repeated rows are
packed as often as they occur; a NULL id stays NULL; a text longer than a window is cut; other
columns are ignored, also when they are named like the result's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored, text_batches, workers_can_import
from fieldtrail.llm.tokens import encoder

#: Partitions whose leftovers meet in one task.
MERGE = 8
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, part int"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int32()),
])


class Packer:
    """Open windows, and the pieces of closed ones in ``rows``.

    A piece is (doc_id, start, ids, doc_tokens); a row adds sequence id and offset.
    """

    def __init__(self, seq_len: int, open_windows: int, first_sequence: int):
        self.seq_len, self.open_windows, self.next_sequence = seq_len, open_windows, first_sequence
        self.windows: list[tuple[int, list]] = []  # (free ids, pieces)
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, ids, total, self.next_sequence, offset))
            offset += len(ids)
        self.next_sequence += 1

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.seq_len:
            self.close([(doc_id, start, ids[: self.seq_len], total)])
            start, ids = start + self.seq_len, ids[self.seq_len :]
        while len(ids):
            n = len(ids)
            best = min((i for i, w in enumerate(self.windows) if w[0] >= n), key=lambda i: self.windows[i][0], default=None)
            if best is not None:
                free, pieces = self.windows[best]
                pieces.append((doc_id, start, ids, total))
                if free == n:
                    self.close(self.windows.pop(best)[1])
                else:
                    self.windows[best] = (free - n, pieces)
                return
            if len(self.windows) < self.open_windows:
                self.windows.append((self.seq_len - n, [(doc_id, start, ids, total)]))
                return
            free, pieces = self.windows.pop(min(range(len(self.windows)), key=lambda i: self.windows[i][0]))
            self.close([*pieces, (doc_id, start, ids[:free], total)])
            start, ids = start + free, ids[free:]

    def finish(self) -> None:
        """Empties the open windows: full sequences first, then powers of two."""
        waiting = [piece for _, pieces in self.windows for piece in pieces]
        self.windows = []
        left = sum(len(p[2]) for p in waiting)
        room, pieces = 0, []
        for doc_id, start, ids, total in waiting:
            while len(ids):
                if not room:
                    room = min(self.seq_len, 1 << (left.bit_length() - 1))
                    left -= room
                take = ids[:room]
                pieces.append((doc_id, start, take, total))
                start, ids, room = start + len(take), ids[len(take) :], room - len(take)
                if not room:
                    self.close(pieces)
                    pieces = []


def _table(rows: list[tuple], part: int) -> pa.RecordBatch:
    doc_id, start, ids, total, sequence, offset = zip(*rows) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([
        pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
        pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array([part] * len(rows), pa.int32()),
    ], schema=_ARROW)


def _pack_partition(tokenizer_path: str, seq_len: int, open_windows: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, end = Packer(seq_len, open_windows, part << 33), np.array([end_id], np.uint32)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b, texts in text_batches(batch, "text"):
                for doc_id, ids in zip(doc_ids[a:b], encoder(tokenizer_path).encode(texts)):
                    ids = np.concatenate([ids, end])
                    packer.add(doc_id, 0, ids, len(ids))
                yield _table(packer.rows, -1)
                packer.rows = []
        for _, pieces in packer.windows:  # left over: sequence ids only tell the windows apart
            packer.close(pieces)
        yield _table(packer.rows, part)

    return run


def _merge_leftovers(seq_len: int, open_windows: int) -> Callable:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        packer = Packer(seq_len, open_windows, (1 << 62) | (key[0].as_py() << 33))
        for row in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            packer.add(row["doc_id"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"])
        packer.finish()
        return pa.Table.from_batches([_table(packer.rows, -1)]).drop_columns(["part"])

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, open_windows: int = 32, end_id: int = 1
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    workers_can_import(spark)
    packed = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_pack_partition(tokenizer_path, seq_len, open_windows, end_id), _SCHEMA),
        "packed",
    )
    leftovers = packed.filter("part >= 0").withColumn("merge", F.expr(f"part div {MERGE}")).drop("part")
    merged = leftovers.groupBy("merge").applyInArrow(
        _merge_leftovers(seq_len, open_windows), _SCHEMA.replace(", part int", "")
    )
    return packed.filter("part < 0").drop("part").unionByName(merged)
