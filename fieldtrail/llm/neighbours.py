"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions ``curves`` times, each time by another orthonormal
matrix and with another shift, and ordered along a Hilbert curve. Spark range-partitions every
ordering, which is cut into blocks; a query meets the blocks around its own on every curve. Within
a block the exact cosines of original vectors are computed, a block keeps each query's best, and the
best of all blocks are merged.

The window is fitted on a bounded sample (``sample_rows``): it is the smallest of ``WINDOWS``, a
share of all rows on either side, with which the sample's own neighbours are found at
``target_recall``, by their distance in rank and not by whole blocks, which add to it in small tables.
Neighbours in a sample lie further off than in the whole table, so the recall there is higher, but
no higher among near copies of one vector: points of one cell are ordered by a finer curve within it,
and by a hash that differs per curve where that ties too, so that curves order them differently. Data without structure needs wide windows, clustered data narrow ones; blocks
bound the memory in either case.

Equal vectors are one class: it stands for them on the curves with its ``k + 1`` smallest ids,
more than which no query can return.

Cases: vectors that are NULL, zero, of another length than most, or that hold NULL or non-finite
components take no part, nor do rows without an id; rows alike in id and vector count once; fewer
than ``k`` candidates give fewer rows, an empty table none; ties go to the smaller id; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored, workers_can_import
from fieldtrail.llm.words import mix

WINDOWS = (0.005, 0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.25, 0.5, 1.0)  # the last sees every row
FINE_BITS = 15  # of each axis within a cell


@dataclass(frozen=True)
class Settings:
    curves: int = 8
    axes: int = 4
    bits: int = 12
    block_rows: int = 1024
    sample_rows: int = 4096
    sample_queries: int = 256
    target_recall: float = 0.95
    seed: int = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer cells (rows x axes), each below ``2**bits``.

    Gray-code construction: from the highest bit down, each axis either reflects the first axis'
    lower bits or swaps them with its own; the transposed digits are then Gray-decoded.
    """
    axes = [cells[:, a].astype(np.int64) for a in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for a in range(len(axes)):
            inverted = (axes[a] >> level) & 1 == 1
            swap = np.where(inverted, 0, (axes[0] ^ axes[a]) & low)
            axes[0] = np.where(inverted, axes[0] ^ low, axes[0] ^ swap)
            axes[a] = axes[a] ^ swap
    for a in range(1, len(axes)):
        axes[a] = axes[a] ^ axes[a - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((axes[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | (axis ^ flip) >> level & 1
    return key


@dataclass(frozen=True)
class Index:
    """Projections, shifts and the fitted spread of each curve, and the window."""

    matrices: np.ndarray  # curves x dimensions x axes
    shifts: np.ndarray  # curves x axes, 0 to 0.5
    centre: np.ndarray
    spread: np.ndarray
    bits: int
    window: float = WINDOWS[-1]

    def keys(self, unit: np.ndarray, curve: int) -> tuple[np.ndarray, np.ndarray]:
        """Place along the curve, and along a finer one within the cell."""
        y = (unit @ self.matrices[curve] - self.centre[curve]) / self.spread[curve]
        share = 1 / (1 + np.exp(-1.702 * np.clip(y, -20, 20)))  # close to the normal distribution's
        place = (share + self.shifts[curve]) / 1.5 * (1 << self.bits)
        cells = np.clip(place.astype(np.int64), 0, (1 << self.bits) - 1)
        within = np.clip(((place - cells) * (1 << FINE_BITS)).astype(np.int64), 0, (1 << FINE_BITS) - 1)
        return hilbert_keys(cells, self.bits), hilbert_keys(within, FINE_BITS)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_index(sample: np.ndarray, k: int, s: Settings) -> Index:
    rng = np.random.default_rng(s.seed)
    dims = sample.shape[1]
    axes = min(s.axes, dims)
    matrices = np.stack([np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, :axes] for _ in range(s.curves)])
    shifts = rng.uniform(0, 0.5, size=(s.curves, axes))
    unit = unit_rows(sample)
    projected = np.einsum("nd,cda->cna", unit, matrices)
    index = Index(matrices, shifts, projected.mean(1, keepdims=True), projected.std(1, keepdims=True) + 1e-12, s.bits)
    n, queries = len(unit), min(s.sample_queries, len(unit))
    near = unit[:queries] @ unit.T
    near[np.arange(queries), np.arange(queries)] = -2
    truth = np.argsort(-near, axis=1)[:, : min(k, n - 1)]
    ranks = np.empty((s.curves, n), np.int64)
    for c in range(s.curves):
        key, fine = index.keys(unit, c)
        ranks[c, np.lexsort((rng.permutation(n), fine, key))] = np.arange(n)
    distance = np.abs(ranks[:, truth] - ranks[:, :queries, None]).min(0)
    window = next((w for w in WINDOWS if not truth.size or (distance <= w * n).mean() >= s.target_recall), WINDOWS[-1])
    return Index(index.matrices, index.shifts, index.centre, index.spread, s.bits, window)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 1))


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
        .filter(F.exists("v", lambda x: x != 0))
    )
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("v") == (sizes["size"] if sizes else -1))


def _classes(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """One row per distinct vector: its smallest ids and whether a query has it."""
    order = Window.partitionBy("v").orderBy("id")
    smallest = rows.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    ids = smallest.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("v").agg(F.max(is_query).alias("asked"))
    return ids.join(asked, "v").select(F.col("ids")[0].alias("rep"), "ids", "asked", "v")


_POINTS = "curve int, key long, fine long, tie long, rep long, ids array<long>, asked boolean, v binary"


def _points(index: Index) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"))
            unit, packed = unit_rows(x), pa.array([r.tobytes() for r in x], pa.binary())
            reps = batch.column("rep").to_numpy().view(np.uint64)
            for c in range(len(index.matrices)):
                key, fine = index.keys(unit, c)
                tie = mix(mix(reps + np.uint64(1)) + np.uint64(c)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(key), pa.array(fine), pa.array(tie), batch.column("rep"),
                     batch.column("ids"), batch.column("asked"), packed],
                    names=["curve", "key", "fine", "tie", "rep", "ids", "asked", "v"],
                )

    return run


_BLOCKS = "curve int, part int, seq int, reps binary, ids array<array<long>>, asked binary, v binary"


def _blocks(block_rows: int) -> Callable:
    """Sorted points of a partition, up to ``block_rows`` of a curve to a row."""

    def pack(part: int, seq: int, rows: list[tuple]) -> pa.RecordBatch:
        curve, _, _, _, reps, ids, asked, v = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array([curve[0]], pa.int32()), pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
            pa.array([np.array(reps, np.int64).tobytes()], pa.binary()), pa.array([list(ids)], pa.list_(pa.list_(pa.int64()))),
            pa.array([np.array(asked, bool).tobytes()], pa.binary()), pa.array([b"".join(v)], pa.binary()),
        ], names=["curve", "part", "seq", "reps", "ids", "asked", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, waiting = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if waiting and (row[0] != waiting[0][0] or len(waiting) == block_rows):
                    yield pack(part, seq, waiting)
                    seq, waiting = seq + 1, []
                waiting.append(row)
        if waiting:
            yield pack(part, seq, waiting)

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order: equal vectors get equal values."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def _best_in_blocks(k: int) -> Callable:
    """The k + 1 nearest classes of each query vector within each block it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reps, asking = np.frombuffer(row["reps"], np.int64), np.frombuffer(row["q_reps"], np.int64)
                rows = np.frombuffer(row["v"], np.float64).reshape(len(reps), -1)
                queries = np.frombuffer(row["q_v"], np.float64).reshape(len(asking), -1)
                near = unit_rows(queries) @ unit_rows(rows).T
                keep = min(k + 1, len(reps))
                least = np.partition(near, len(reps) - keep, axis=1)[:, len(reps) - keep]
                q, r = np.nonzero(near >= least[:, None] - 1e-9)
                exact = cosines(queries[q], rows[r])
                order = np.lexsort((reps[r], -exact, q))
                q, r, exact = q[order], r[order], exact[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, r, exact = q[place <= k], r[place <= k], exact[place <= k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asking[q]), pa.array(reps[r]), pa.array(exact),
                     pa.array([row["ids"][i] for i in r.tolist()], pa.list_(pa.int64()))],
                    names=["q_rep", "rep", "score", "ids"],
                )

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` nearest found; ``is_query`` is over ``id``."""
    spark = vectors.sparkSession
    workers_can_import(spark)
    rows = _usable(vectors, id_col, vec_col)
    classes = stored(_classes(rows, is_query, k), "vectors")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(settings.sample_rows).select("v").toArrow()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit_index(_matrix(sample.column("v").combine_chunks()), k, settings)
    points = classes.mapInArrow(_points(index), _POINTS)
    tasks = max(1, math.ceil(n * settings.curves / (8 * settings.block_rows)))
    along = ["curve", "key", "fine", "tie", "rep"]
    blocks = stored(
        points.repartitionByRange(tasks, *along).sortWithinPartitions(*along)
        .mapInArrow(_blocks(settings.block_rows), _BLOCKS),
        "blocks",
    )
    order = Window.partitionBy("curve").orderBy("part", "seq")
    numbered = blocks.select("curve", "part", "seq").withColumn("block", F.row_number().over(order))
    counts = numbered.groupBy("curve").agg(F.max("block").alias("n_blocks"))
    numbered = numbered.join(F.broadcast(counts), "curve")  # one row per curve
    blocks = blocks.join(numbered, ["curve", "part", "seq"])

    def asked_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chosen = np.frombuffer(row["asked"], bool)
                if chosen.any():
                    reps = np.frombuffer(row["reps"], np.int64)
                    v = np.frombuffer(row["v"], np.float64).reshape(len(reps), -1)
                    yield pa.RecordBatch.from_pylist([
                        {"curve": row["curve"], "block": row["block"], "n_blocks": row["n_blocks"],
                         "q_reps": reps[chosen].tobytes(), "q_v": v[chosen].tobytes()}
                    ], schema=pa.schema([("curve", pa.int32()), ("block", pa.int32()), ("n_blocks", pa.int32()), ("q_reps", pa.binary()), ("q_v", pa.binary())]))

    asking = blocks.select("curve", "block", "n_blocks", "reps", "asked", "v").mapInArrow(
        asked_only, "curve int, block int, n_blocks int, q_reps binary, q_v binary"
    )
    reach = F.ceil(F.col("n_blocks") * index.window).cast("int")
    visits = asking.withColumn(
        "block", F.explode(F.sequence(F.greatest(F.col("block") - reach, F.lit(1)), F.least(F.col("block") + reach, F.col("n_blocks"))))
    ).drop("n_blocks")
    found = (
        visits.join(blocks.select("curve", "block", "reps", "ids", "v"), ["curve", "block"])
        .mapInArrow(_best_in_blocks(k), "q_rep long, rep long, score double, ids array<long>")
    )
    # a class may be found on several curves; its score is the same on each
    best = Window.partitionBy("q_rep").orderBy(F.desc("score"), "id")
    ids = (
        found.groupBy("q_rep", "rep").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        .withColumn("id", F.explode("ids")).drop("ids", "rep")
        .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
        .groupBy("q_rep").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    )
    queries = rows.filter(is_query).distinct().join(classes.select("rep", "v"), "v").select(F.col("id").alias("query_id"), "rep")
    own = queries.join(ids, F.col("rep") == F.col("q_rep")).select(
        "query_id", F.slice(F.filter("near", lambda s: s["id"] != F.col("query_id")), 1, k).alias("near")
    )
    return own.select("query_id", F.posexplode("near").alias("rank", "s")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("s.id").alias("vec_id"), F.col("s.score").alias("score")
    )
