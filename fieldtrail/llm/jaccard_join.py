"""N-gram Jaccard join: documents whose shingle sets are alike, exactly, and their components.

Two sets link when ``100 * intersection >= percent * union``. Their symmetric difference is then at
most ``d = (x + y) * (100 - percent) / (100 + percent)`` shingles. Sets are put in bands by size; in
a band with at most ``d`` differences every set is cut into ``d + 1`` parts (and some to spare) by
its shingles' hash, so linked sets agree in a whole part. A (band, part, content) is a tile; a set
also goes to the next band's tiles when a larger set there could link with it. Parts without a
shingle are left out: there are as many spare parts, and a set with more empty parts than that puts
them in as well.

Few tiles hold more than one distinct set. Of those:

1. Every set is compared with one other: the set that lies in most of its tiles and is central to
   them (the source of a group of near copies, say). Verified links give first components.
2. In tiles that still hold several components, sets are sorted by size and cut into blocks; blocks
   whose sizes could link are compared by bitmaps of hashed shingles. Bits of one set that the other
   lacks bound the overlap from above. Sets that could link across components form groups, which
   are the same in many tiles and kept once.
3. Within a group the sorted shingle arrays are intersected, for two sets as long as nothing has
   joined them yet, and the links that join are returned: fewer than the group has sets.

After that every two sets of a tile were compared or are in one component, so the components are
exact, and no group is written out as all of its pairs. Equal sets are one vertex throughout, known by a 64-bit hash of the set;
shingles are 64-bit hashes too.

Cases: a text of fewer words than ``n`` is one shingle; NULL or empty text has none and links with
nothing; rows alike in all columns get the same result; documents without an id take part, but
never name a component that has an id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored, text_batches, workers_can_import
from fieldtrail.llm.graph import components
from fieldtrail.llm.words import Words, mix

RATIO = 1.5  # between the bounds of size bands
BLOCK = 1 << 20  # shingles of a block in step 2, a set counting as ``SET_COST`` more
SET_COST = 512
_STEP = 0xA24BAED4963EE407


@cache
def band(index: int) -> tuple[int, int]:
    """Smallest and largest size of a band."""
    low = 1 if not index else band(index - 1)[1] + 1
    return low, max(low, math.ceil(low * RATIO) - 1)


@cache
def parts(index: int, percent: int) -> tuple[int, int]:
    """(parts, spare parts) of a band's tiles."""
    low, high = band(index)
    differences = 2 * high * (100 - percent) // (100 + percent)
    least, spare = max(1, low * percent // 100), 0
    while True:
        count = differences + 1 + spare
        empty = count * math.exp(-least / count) if count > 1 else 0.0
        need = math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.01 else 0
        if need <= spare or spare > differences + 8:
            return count, spare
        spare += 1


def bands_of(size: int, percent: int) -> list[int]:
    """The bands whose tiles a set of ``size`` goes to: its own, and larger ones it could link into."""
    own = 0
    while band(own)[1] < size:
        own += 1
    out = [own]
    while 100 * size >= percent * band(out[-1] + 1)[0]:
        out.append(out[-1] + 1)
    return out


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64)]) + np.uint64(len(shingles)))[0].view(np.int64))


def tiles(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the tiles of a sorted set."""
    out, total = [], np.concatenate([np.zeros(1, np.uint64), np.cumsum(shingles, dtype=np.uint64)])
    for index in bands_of(len(shingles), percent):
        count, spare = parts(index, percent)
        place = (shingles >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)  # ascending, as the hashes are
        edge = np.searchsorted(place, np.arange(count + 1, dtype=np.uint64))
        salt = np.uint64(((index << 32) + 1) * _STEP % (1 << 64)) + np.arange(count, dtype=np.uint64)
        tile = mix(mix(total[edge[1:]] - total[edge[:-1]]) + salt)
        empty = edge[1:] == edge[:-1]
        out.append(tile[~empty] if empty.sum() <= spare else tile)
    return np.concatenate(out)


def _describe(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, _, texts in text_batches(batch, "text") for s in Words(texts).shingle_sets(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "text_key", "n_shingles", "v"],
            )

    return run


def _emit_tiles(n: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_batches(batch, "text"):
                sets = [s for s in Words(texts).shingle_sets(n) if len(s)]
                found = [tiles(s, percent) for s in sets]
                ids = np.array([set_id(s) for s in sets], np.int64)
                tile = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
                v = np.repeat(ids, [len(t) for t in found]) if found else ids
                yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(v)], names=["tile", "v"])

    return run


def _shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (tile, v): the tiles with several sets, named by their members so that
    tiles with the same ones fall together. Holds the ids of one tile at a time."""
    kept_tile, kept_v = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def close(tile: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(tile), bool)
        fresh[1:] = (tile[1:] != tile[:-1]) | (v[1:] != v[:-1])
        tile, v = tile[fresh], v[fresh]
        start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])) if len(tile) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([start, [len(tile)]]))
        names = np.add.reduceat(mix(v.view(np.uint64)), start) if len(start) else np.zeros(0, np.uint64)
        several = np.repeat(size > 1, size)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(mix(names), size)[several].view(np.int64)), pa.array(v[several]),
             pa.array(np.repeat(size, size)[several])], names=["tile", "v", "size"],
        )

    for batch in batches:
        tile = np.concatenate([kept_tile, batch.column("tile").to_numpy()])
        v = np.concatenate([kept_v, batch.column("v").to_numpy()])
        if len(tile):
            last = int(np.searchsorted(tile, tile[-1]))
            yield close(tile[:last], v[:last])
            kept_tile, kept_v = tile[last:], v[last:]
    yield close(kept_tile, kept_v)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(n: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                left = Words([t or b"" for t in part.column("text_a").cast(pa.binary()).to_pylist()]).shingle_sets(n)
                right = Words([t or b"" for t in part.column("text_b").cast(pa.binary()).to_pylist()]).shingle_sets(n)
                out += [linked(x, y, percent) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())], names=["a", "b", "linked"]
            )

    return run


def _bitmaps(n: int) -> Callable:
    """Of each text, its sorted shingles, and a bitmap with four to eight bits for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, _, texts in text_batches(batch, "text") for s in Words(texts).shingle_sets(n)]
            maps = []
            for s in sets:
                bits = np.zeros(max(64, 1 << (4 * len(s) - 1).bit_length()), np.uint8)
                bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
                maps.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), pa.array([len(s) for s in sets], pa.int64()), pa.array(maps, pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["v", "n", "bits", "shingles"],
            )

    return run


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def may_link(sizes: np.ndarray, maps: list[np.ndarray], one: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Of ``others``, sets that by size and bit counts could link with the set ``one``."""
    x, y = sizes[one], sizes[others]
    others = others[100 * np.minimum(x, y) >= percent * np.maximum(x, y)]
    kept = []
    by_width: dict[int, list[int]] = {}
    for o in others.tolist():
        by_width.setdefault(min(len(maps[o]), len(maps[one])), []).append(o)
    for words, group in by_width.items():
        mine = _fold(maps[one], words)
        theirs = np.stack([maps[o] if len(maps[o]) == words else _fold(maps[o], words) for o in group])
        only_mine = np.bitwise_count(mine & ~theirs).sum(1).astype(np.int64)
        only_theirs = np.bitwise_count(theirs & ~mine).sum(1).astype(np.int64)
        n = sizes[group]
        both = np.minimum(x - only_mine, n - only_theirs)  # the overlap is at most this
        kept.append(np.array(group)[100 * both >= percent * (x + n - both)])
    return np.concatenate(kept) if kept else others[:0]


class Union:
    """Labels that are merged, of a few thousand members."""

    def __init__(self, label: np.ndarray):
        self.label = np.unique(label, return_inverse=True)[1]

    def merge(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            self.label[self.label == b] = a


def _candidate_groups(v, label, sizes, side, maps, i: int, j: int, percent: int) -> list[np.ndarray]:
    """Members that could link with one of another component, as connected groups, between blocks
    ``i`` and ``j`` (one of the two for each row in ``side``)."""
    union, touched = Union(v), np.zeros(len(v), bool)
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    for one in left.tolist():
        others = right[(label[right] != label[one]) & ((v[right] > v[one]) | (i != j))]
        if len(others):
            for other in may_link(sizes, maps, one, others, percent).tolist():
                union.merge(one, other)
                touched[one] = touched[other] = True
    return [v[touched & (union.label == g)] for g in np.unique(union.label[touched]).tolist()]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str], binaries: list[str], work: Callable) -> Iterator[pa.RecordBatch]:
    """Calls ``work`` with the columns of each group of rows that agree in ``keys``, by which the rows
    are sorted; holds one group, besides the batch. ``work`` returns pairs of numbers."""
    kept: list | None = None

    def done(columns: list) -> Iterator[pa.RecordBatch]:
        fresh = np.zeros(len(columns[0]), bool)
        for c in columns[: len(keys)]:
            fresh[1:] |= c[1:] != c[:-1]
        edge = [0, *np.flatnonzero(fresh).tolist(), len(fresh)]
        out = [work(*(c[a:b] for c in columns)) for a, b in zip(edge, edge[1:])]
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *out])
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names] + [batch.column(c).to_pylist() for c in binaries]
        if kept is not None:
            columns = [np.concatenate([k, c]) if isinstance(c, np.ndarray) else k + c for k, c in zip(kept, columns)]
        if not len(columns[0]):
            continue
        last = np.ones(len(columns[0]), bool)
        for c in columns[: len(keys)]:
            last &= c == c[-1]
        cut = int(np.argmax(last))  # the last group may go on in the next batch
        if cut:
            yield from done([c[:cut] for c in columns])
        kept = [c[cut:] for c in columns]
    if kept is not None and len(kept[0]):
        yield from done(kept)


def _compare_blocks(percent: int) -> Callable:
    """(group, set) of candidate groups, over rows sorted by (tile, i, j)."""

    def work(tile, i, j, v, label, n, block, bits) -> np.ndarray:
        maps = [np.frombuffer(b, np.uint64) for b in bits]
        groups = _candidate_groups(v, label, n, block, maps, int(i[0]), int(j[0]), percent)
        named = [np.column_stack([np.full(len(g), mix(mix(g.view(np.uint64)).sum(dtype=np.uint64)[None])[0].view(np.int64)), g]) for g in groups]
        return np.concatenate([np.zeros((0, 2), np.int64), *named])

    names = ["tile", "i", "j", "v", "label", "n", "block"]
    return lambda batches: _grouped(batches, ["tile", "i", "j"], names, ["bits"], work)


def _joining_links(percent: int) -> Callable:
    """The links that join the components of a group, over rows sorted by (group, n, v)."""

    def work(group, v, label, n, bits, shingles) -> np.ndarray:
        union, out = Union(label), []
        maps, sets = [np.frombuffer(b, np.uint64) for b in bits], [np.frombuffer(b, np.uint64) for b in shingles]
        for one in range(len(v)):
            others = np.flatnonzero(union.label != union.label[one])
            for other in may_link(n, maps, one, others[others > one], percent).tolist() if len(others) else ():
                if union.label[one] != union.label[other] and linked(sets[one], sets[other], percent):
                    union.merge(one, other)
                    out.append((v[one], v[other]))
        return np.array(out, np.int64).reshape(-1, 2)

    return lambda batches: _grouped(batches, ["group"], ["group", "v", "label", "n"], ["bits", "shingles"], work)


def _central_pairs(members: DataFrame) -> DataFrame:
    """Every set with the one it shares most tiles with, as far as that one is central to them."""
    weight = members.groupBy("v").agg(F.sum("size").alias("weight"))
    weighted = members.join(weight, "v")
    centre = weighted.groupBy("tile").agg(F.max(F.struct("weight", "v")).alias("c")).select("tile", F.col("c.v").alias("centre"))
    votes = members.join(centre, "tile").filter("v != centre").groupBy("v", "centre").agg(F.count("*").alias("n"))
    best = votes.groupBy("v").agg(F.max(F.struct("n", "centre")).alias("best"))
    centre = F.col("best.centre")
    return best.select(F.least("v", centre).alias("a"), F.greatest("v", centre).alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    left = texts.select(F.col("v").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("v").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_verify(n, percent), "a long, b long, linked boolean")


def _bridges(members: DataFrame, labels: DataFrame, texts: DataFrame, tested: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) that join components within a tile."""
    labelled = members.join(labels, "v", "left").select("tile", "v", F.coalesce("label", "v").alias("label"))
    mixed = labelled.groupBy("tile").agg(
        F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("size"), F.min("label").alias("x"), F.max("label").alias("y"),
    ).filter("x != y")
    # a tile of two sets that were themselves compared is done, whatever their components are called
    open_tiles = (
        mixed.join(tested.select("a", "b", F.lit(True).alias("done")), ["a", "b"], "left")
        .filter("size > 2 OR done IS NULL").select("tile")
    )
    described = texts.select("v", "text").mapInArrow(_bitmaps(n), "v long, n long, bits binary, shingles binary")
    weight = F.sum(F.col("n") + SET_COST).over(Window.partitionBy("tile").orderBy("n", "v"))
    numbered = (
        labelled.join(open_tiles, "tile").join(texts.select("v", "n"), "v")
        .withColumn("block", F.floor(weight / BLOCK).cast("int"))
    )
    spans = stored(numbered.groupBy("tile", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")), "blocks")
    one, two = spans.alias("one"), spans.alias("two")
    # blocks of a tile, not its rows: sorted by size, so only neighbouring ones can link
    meet = one.join(two, "tile").filter(
        f"one.block <= two.block AND 100 * one.high >= {percent} * two.low"
    ).select("tile", F.col("one.block").alias("i"), F.col("two.block").alias("j"))
    visits = meet.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    # bitmaps come last, so that they are moved once
    groups = (
        numbered.join(visits, ["tile", "block"]).join(described.select("v", "bits"), "v")
        .select("tile", "i", "j", "v", "label", "n", "block", "bits")
        .repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")
        .mapInArrow(_compare_blocks(percent), "a long, b long").toDF("group", "v").distinct()
    )
    return (
        stored(groups, "candidates").join(labels, "v", "left").withColumn("label", F.coalesce("label", "v")).join(described, "v")
        .select("group", "v", "label", "n", "bits", "shingles")
        .repartition("group").sortWithinPartitions("group", "n", "v")
        .mapInArrow(_joining_links(percent), "a long, b long").distinct()
    )


def link_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, component_id and keeper of every row.

    ``component_id`` and ``keeper`` are the doc_id and text_key of the component's first row: smallest id
    (rows without one come last), then smallest text_key. They tell one row of a group from
    the others also where ids repeat or are NULL."""
    workers_can_import(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    sets = stored(
        docs.mapInArrow(_describe(n), "doc_id long, text_key long, n_shingles long, v long"), "sets"
    )
    members = stored(
        docs.select("text").mapInArrow(_emit_tiles(n, percent), "tile long, v long")
        .repartition("tile").sortWithinPartitions("tile", "v")
        .mapInArrow(_shared_tiles, "tile long, v long, size long").distinct(),
        "tiles",
    )
    # one text of each set that shares a tile
    keys = sets.filter("v IS NOT NULL").groupBy("v").agg(F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n"))
    keys = members.select("v").distinct().join(keys, "v")
    texts = stored(
        docs.select("text_key", "text").join(keys, "text_key")
        .groupBy("v").agg(F.min("text").alias("text"), F.min("n").alias("n")),
        "texts",
    )
    first = stored(_verified(_central_pairs(members), texts, n, percent), "links")
    links = first.filter("linked").select("a", "b")
    labels = components(links)
    bridges = stored(_bridges(members, labels, texts, first, n, percent), "links")
    if bridges.limit(1).count():
        labels = components(links.union(bridges))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    ids = sets.filter("v IS NOT NULL").groupBy("v").agg(F.min(place).alias("own"))
    named = ids.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    smallest = named.groupBy("label").agg(F.min("own").alias("first"))
    first_row = [F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("keeper")]
    of_set = stored(named.join(smallest, "label").select("v", *first_row), "components")
    linked_rows = sets.filter("v IS NOT NULL").join(of_set, "v")
    alone = sets.filter("v IS NULL").withColumns({"component_id": F.col("doc_id"), "keeper": F.col("text_key")})
    columns = ["doc_id", "text_key", "n_shingles", "component_id", "keeper"]
    return linked_rows.select(*columns).union(alone.select(*columns))
