"""Suffix-array dedup: bytes covered by strings of ``length`` bytes that also start elsewhere.

Only suffixes that may repeat are sorted. Of the ``length`` bytes from a place, the k-gram with the
least hash is the place's anchor. Equal strings have equal anchors, so a string can only start
again under an anchor of the same class (k-gram). Neighbouring places with one anchor form a piece.

1. Classes that occur once are dropped; nothing but hashes has been moved by then.
2. A piece that occurs several times as a whole is repeated in all of its places. Classes of very
   many places (at most ``HOT_CLASSES`` of them) are spread over tasks and counted by partial sums.
3. The distinct pieces of a class are brought together with their bytes, read from the texts once. Within a class the places
   are sorted by the bytes that follow (the suffix array), and the longest previous factor of each is
   the longer match with its previous or next smaller position in suffix order; the longest next
   factor is the same for later positions. A factor of ``length`` bytes is a repeat.
4. A class of more than ``hot`` distinct pieces (say, a third of all documents are near copies) is
   cut finer first: its pieces are split by their distance from the anchor, in ranges, and the class
   by the bytes that all strings of a range share; in the last round a piece is one string.

With ``keep="first"`` a string's first occurrence stays, by (doc_id, key of the text, place); with
``keep="none"`` all go. Strings are judged on the input, not on what is left, and never cross texts.

Cases: NULL counts as empty; texts shorter than ``length`` keep all; repeated rows are repeats of
each other (under ``first`` they are one document); NULL ids come first; an empty table gives no
rows; ``kept``, ``removed`` and ``n_bytes`` replace columns of these names, all others stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, stored, text_batches, workers_can_import
from fieldtrail.llm.spans import merged_spans
from fieldtrail.llm.words import mix, powers, prefix_hash

GRAM = 32
#: Distinct pieces of a class that are compared as they are.
HOT = 8_192
ROUNDS = (32, 4, 1)  # widths of the ranges into which larger classes are cut, one after the other
#: A class is spread over tasks from so many places on, or from its share of all places that only
#: so many classes can have.
HOT_ROWS, HOT_CLASSES, SALTS = 100_000, 10_000, 256
_KEY = ["k1", "k2"]
_PLACE = ["doc_id", "k1", "k2", "lo"]


class Places:
    """The places of several texts where a string of ``length`` bytes starts, with their anchors."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        self.total = prefix_hash(self.buf)
        self.inverse = powers(len(self.buf))[1]
        count = np.maximum(sizes - length + 1, 0)
        first = np.cumsum(count) - count
        self.text = np.repeat(np.arange(len(texts)), count)
        self.start = np.arange(int(count.sum())) - np.repeat(first, count) + np.repeat(self.base[:-1], count)

    def span_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.total[b] - self.total[a]) * self.inverse[a] + (b - a).astype(np.uint64))

    def anchors(self) -> np.ndarray:
        """Place of the k-gram with the least hash, the leftmost of equals, for each start."""
        n, gram = len(self.buf), min(GRAM, self.length)
        window = self.length - gram + 1
        if not len(self.start):
            return np.zeros(0, np.int64)
        at = np.arange(n - gram + 1)
        bits = np.uint64(max(24, n.bit_length()))
        ranked = self.span_hash(at, at + gram) >> bits << bits | at.astype(np.uint64)
        # least of each window: the least from it to its block's end, and from the next block's begin
        padded = np.full(-(-len(ranked) // window) * window + window, np.uint64(2**64 - 1))
        padded[: len(ranked)] = ranked
        blocks = padded.reshape(-1, window)
        to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        from_begin = np.minimum.accumulate(blocks, axis=1).ravel()
        least = np.minimum(to_end[self.start], from_begin[self.start + window - 1])
        return (least & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)

    def pieces(self) -> tuple[np.ndarray, ...]:
        """(text, first start within it, starts, distance to the anchor, class, hash of the bytes)."""
        anchor = self.anchors()
        if not len(anchor):
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
        fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (self.text[1:] != self.text[:-1])])
        edge = np.flatnonzero(fresh)
        starts = np.diff(np.concatenate([edge, [len(anchor)]]))
        a, at, text = self.start[edge], anchor[edge], self.text[edge]
        gram = min(GRAM, self.length)
        return text, a - self.base[text], starts, at - a, self.span_hash(at, at + gram), self.span_hash(a, a + starts + self.length - 1)


def _emit_classes(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_batches(batch, "text"):
                cls, n = np.unique(Places(texts, length).pieces()[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cls.view(np.int64)), pa.array(n)], names=["cls", "n"])

    return run


_PIECES = "doc_id long, k1 long, k2 int, lo long, starts int, reach int, cls long, piece long"


def _emit_pieces(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_batches(batch, "text"):
                text, lo, starts, reach, cls, piece = Places(texts, length).pieces()
                rows = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in ("doc_id", "k1", "k2")), pa.array(lo),
                     pa.array(starts.astype(np.int32)), pa.array(reach.astype(np.int32)),
                     pa.array(cls.view(np.int64)), pa.array(piece.view(np.int64))],
                    names=["doc_id", "k1", "k2", "lo", "starts", "reach", "cls", "piece"],
                )

    return run


_CUT = "cls long, doc_id long, k1 long, k2 int, lo long, starts int, reach int, distinct long, data binary"
_CUT_NAMES = ["cls", "doc_id", "k1", "k2", "lo", "starts", "reach", "distinct", "data"]


def _cut(length: int) -> Callable:
    """The bytes of each listed piece of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pieces, n = row["pieces"], len(row["pieces"])

                def column(name: str, kind: pa.DataType) -> pa.Array:
                    return pa.array([p[name] for p in pieces], kind)

                yield pa.RecordBatch.from_arrays(
                    [column("cls", pa.int64()), *(pa.array([row[c]] * n, t) for c, t in (("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int32()))),
                     column("lo", pa.int64()), column("starts", pa.int32()), column("reach", pa.int32()), column("distinct", pa.int64()),
                     pa.array([row["text"][p["lo"] : p["lo"] + p["starts"] + length - 1] for p in pieces], pa.binary())],
                    names=_CUT_NAMES,
                )

    return run


_FINER = "cls long, piece long, doc_id long, k1 long, k2 int, lo long, starts int, reach int, data binary"


def _refine(length: int, width: int) -> Callable:
    """Pieces cut by distance from the anchor into ranges of ``width``. The class of a range is its
    number and the bytes that all strings of the range share: from its nearest possible start to
    the end of a string from its farthest."""

    def finer(row: dict) -> Iterator[tuple]:
        data, reach, starts = row["data"], row["reach"], row["starts"]
        # starts lie at distances ``reach`` down to ``reach - starts + 1`` from the anchor
        for number in range((reach - starts + 1) // width, reach // width + 1):
            near, far = number * width, number * width + width - 1
            first, last = max(0, reach - far), min(starts - 1, reach - near)
            yield number, data[reach - near : reach - far + length], first, last - first + 1, data[first : last + length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for number, shared, first, starts, part in finer(row):
                    rows.append((
                        _hash64(b"%d:%d:" % (row["cls"], number) + shared), _hash64(part), row["doc_id"], row["k1"], row["k2"],
                        row["lo"] + first, starts, row["reach"] - first, part,
                    ))
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds_ = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds_)],
                names=["cls", "piece", "doc_id", "k1", "k2", "lo", "starts", "reach", "data"],
            )

    return run


def _hash64(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def suffix_ranks(buf: np.ndarray, group: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Rank of (group, next ``length`` bytes) of each start, by doubling; equal ranks: equal strings."""
    size, rank = 1, buf.astype(np.int64)
    while size * 2 <= length:
        pair = rank * (int(rank.max()) + 1) if len(rank) else rank
        pair[:-size] += rank[size:]
        rank, size = np.unique(pair, return_inverse=True)[1], size * 2
    wide = int(rank.max()) + 1 if len(rank) else 1
    both = np.unique(rank[start] * wide + rank[start + length - size], return_inverse=True)[1]
    return np.unique(group * np.int64(int(both.max()) + 1 if len(both) else 1) + both, return_inverse=True)[1]


def nearest_smaller(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with its previous smaller position in suffix order.

    ``common[i]`` is the prefix that i shares with i - 1. Pointers jump over larger positions; what
    a pointer skips is larger than where it starts, so jumping along others' pointers is safe.
    """
    n = len(position)
    to, shared = np.arange(n) - 1, common.copy()
    open_ = np.flatnonzero(to >= 0)
    open_ = open_[position[to[open_]] >= position[open_]]
    while len(open_):
        j = to[open_]
        shared[open_] = np.minimum(shared[open_], shared[j])
        to[open_] = to[j]
        open_ = open_[to[open_] >= 0]
        open_ = open_[position[to[open_]] >= position[open_]]
    shared[to < 0] = 0
    return shared


def longest_factors(position: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous factor, longest next factor) of suffixes in suffix order."""
    back = np.concatenate([common[1:], [0]])[::-1] if len(common) else common

    def factor(p: np.ndarray) -> np.ndarray:
        return np.maximum(nearest_smaller(p, common), nearest_smaller(p[::-1], back)[::-1])

    return factor(position), factor(-position)


def repeated_starts(
    pieces: list[bytes], starts: np.ndarray, group: np.ndarray, order: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start within it, occurs earlier, occurs later) of the starts that repeat in their group.

    ``order`` ranks the pieces' places in the corpus; equal places are the same string, no repeat.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    base = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    piece = np.repeat(np.arange(len(pieces)), starts)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(starts) - starts, starts)
    at = base[piece] + offset
    # strings whose hash is alone in the group have no factor of that length and are not sorted
    total, inverse = prefix_hash(buf), powers(len(buf))[1]
    hashes = mix((total[at + length] - total[at]) * inverse[at]) + group[piece].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    by_hash = np.argsort(hashes, kind="stable")
    alike = hashes[by_hash][1:] == hashes[by_hash][:-1]
    chosen = np.zeros(len(at), bool)
    chosen[by_hash[1:][alike]] = chosen[by_hash[:-1][alike]] = True
    piece, offset = piece[chosen], offset[chosen]
    used = np.unique(piece)
    if not len(used):
        return piece, offset, np.zeros(0, bool), np.zeros(0, bool)
    new = np.cumsum(np.isin(np.arange(len(pieces)), used)) - 1
    buf = np.frombuffer(b"".join(pieces[i] for i in used.tolist()), np.uint8)
    base = np.cumsum(sizes[used]) - sizes[used]
    rank = suffix_ranks(buf, group[piece], base[new[piece]] + offset, length)
    position = order[piece] * np.int64(int(starts.max()) + 1) + offset
    suffixes = np.lexsort((position, rank))
    rank, position = rank[suffixes], position[suffixes]
    common = np.concatenate([[0], np.where(rank[1:] == rank[:-1], length, 0)])  # up to what matters
    before, after = longest_factors(position, common)
    return piece[suffixes], offset[suffixes], before >= length, after >= length


def _resolve(length: int, keep: str, chunk: int = 1 << 20) -> Callable:
    """Spans of repeats, over rows sorted by class. Holds ``chunk`` places and one class."""

    def resolved(rows: list[dict]) -> pa.RecordBatch:
        places = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["k1"], r["k2"], r["lo"]) for r in rows})
        ranks = {p: i for i, p in enumerate(places)}
        order = np.array([ranks[(r["doc_id"] is not None, r["doc_id"] or 0, r["k1"], r["k2"], r["lo"])] for r in rows])
        group = np.unique(np.array([r["cls"] for r in rows]), return_inverse=True)[1]
        starts = np.array([r["starts"] for r in rows], np.int64)
        piece, offset, earlier, later = repeated_starts([r["data"] for r in rows], starts, group, order, length)
        hit = earlier if keep == "first" else earlier | later
        found = np.unique(np.column_stack([piece[hit], offset[hit]]), axis=0) if hit.any() else np.zeros((0, 2), np.int64)
        edge = np.flatnonzero(np.concatenate([[True], (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1] + 1)])) if len(found) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([edge, [len(found)]])) if len(found) else edge
        which, first = found[edge, 0].tolist(), found[edge, 1]
        lo = np.array([rows[i]["lo"] for i in which], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i]["k1"] for i in which], pa.int64()), pa.array([rows[i]["k2"] for i in which], pa.int32()),
             pa.array(lo + first), pa.array(lo + first + size + length - 1)], names=["k1", "k2", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, places = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if places >= chunk and row["cls"] != rows[-1]["cls"]:
                    yield resolved(rows)
                    rows, places = [], 0
                rows.append(row)
                places += row["starts"]
        if rows:
            yield resolved(rows)

    return run


def _marked(docs: DataFrame, length: int) -> DataFrame:
    """Pieces of repeated classes: every place of a piece that occurs several times, and of each
    class with several distinct pieces their first places.

    Classes of very many places (``hot``) are only brought in here, all of them, spread over tasks.
    """
    again = stored(
        docs.select("text").mapInArrow(_emit_classes(length), "cls long, n long")
        .groupBy("cls").agg(F.sum("n").alias("n")).filter("n > 1"),
        "classes",
    )
    places = again.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    floor = max(HOT_ROWS, places // HOT_CLASSES)
    hot = again.filter(F.col("n") > floor).select("cls", F.lit(True).alias("hot"))  # HOT_CLASSES rows at most
    salts = F.when(F.col("n") > floor, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = again.select("cls", F.explode(salts).alias("salt"))
    spread = F.pmod(F.xxhash64("k1", "lo"), F.lit(SALTS)).cast("int")
    seen = (
        docs.mapInArrow(_emit_pieces(length), _PIECES).join(F.broadcast(hot), "cls", "left")
        .withColumn("hot", F.col("hot").isNotNull()).withColumn("salt", F.when(F.col("hot"), spread).otherwise(0))
        .join(keys, ["cls", "salt"])
    )
    # one shuffle, by class: the windows of calm classes need no other
    same, whole = Window.partitionBy("cls", "salt", "piece"), Window.partitionBy("cls", "salt")
    number = F.row_number().over(same.orderBy(*_PLACE))
    calm = (
        seen.withColumns({"number": number, "n": F.count("*").over(same), "first": F.min(F.struct(*_PLACE)).over(same)})
        .withColumn("distinct", F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).over(whole))
    )
    kept = calm.filter("hot OR n > 1 OR (number = 1 AND distinct > 1)")
    return stored(kept.select("cls", "piece", *_PLACE, "starts", "reach", "hot", "number", "n", "first", "distinct"), "pieces")


def _counted(pieces: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct pieces with their first place and the number of their class, places of copies), by
    partial sums, so that a class or a piece of any size is spread."""
    whole = F.struct(*_PLACE, "starts", "reach", *carry)
    distinct = pieces.groupBy("cls", "piece").agg(F.count("*").alias("n"), F.min(whole).alias("first"))
    per_class = distinct.groupBy("cls").agg(F.count("*").alias("distinct"))
    distinct = stored(distinct.join(per_class, "cls").filter("n > 1 OR distinct > 1"), "distinct")
    several = distinct.filter("n > 1").select("cls", "piece", "n", F.struct(*(f"first.{c}" for c in _PLACE)).alias("first"))
    copies = pieces.select("cls", "piece", *_PLACE, "starts").join(several, ["cls", "piece"])
    return distinct.filter("distinct > 1").select("cls", "first.*", "distinct"), copies


def repeat_spans(docs: DataFrame, length: int, keep: str, hot: int = HOT) -> DataFrame:
    """Spans (a, b) of repeated strings under each document key; they may overlap."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", F.length("text")).alias("k2"))
    docs = docs.filter(F.octet_length("text") >= length)
    marked = _marked(docs, length)
    columns = ["cls", *_PLACE, "starts", "reach", "distinct"]

    def copied(places: DataFrame) -> DataFrame:
        if keep == "first":
            places = places.filter(~F.struct(*_PLACE).eqNullSafe(F.col("first")))
        return places.select(*_KEY, F.col("lo").alias("a"), (F.col("lo") + F.col("starts") + length - 1).alias("b"))

    out = [copied(marked.filter("NOT hot AND n > 1"))]
    compared = marked.filter("NOT hot AND number = 1 AND distinct > 1").select(*columns)
    if marked.filter("hot").limit(1).count():
        large, copies = _counted(marked.filter("hot").select("cls", "piece", *_PLACE, "starts", "reach"), [])
        out.append(copied(copies))
        compared = compared.union(large.select(*columns))
    listed = compared.groupBy(*_KEY).agg(F.collect_list(F.struct("cls", "lo", "starts", "reach", "distinct")).alias("pieces"))
    texts = docs.join(listed, _KEY).select("doc_id", *_KEY, F.col("text").cast("binary").alias("text"), "pieces")
    cut = stored(texts.mapInArrow(_cut(length), _CUT), "cut")
    for width in (*ROUNDS, None):
        few = cut if width is None else cut.filter(F.col("distinct") <= hot)
        out.append(
            few.repartition("cls").sortWithinPartitions("cls")
            .mapInArrow(_resolve(length, keep), "k1 long, k2 int, a long, b long")
        )
        many = cut.filter(F.col("distinct") > hot)
        if width is None or not many.limit(1).count():
            break
        cut, copies = _counted(many.mapInArrow(_refine(length, width), _FINER), ["data"])
        out.append(copied(copies))
    return reduce(DataFrame.union, out)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("kept")
        kept = []
        for data, spans in zip(batch.column(at).to_pylist(), batch.column("removed").to_pylist()):
            if spans:
                ends = [0, *(s["b"] for s in spans)]
                begins = [*(s["a"] for s in spans), len(data)]
                data = b"".join(data[x:y] for x, y in zip(ends, begins))
            kept.append(data)
        yield batch.set_column(at, "kept", pa.array(kept, pa.binary()))


def dedup(docs: DataFrame, length: int = 200, keep: str = "first", hot: int = HOT) -> DataFrame:
    """``docs`` with n_bytes, removed (maximal spans of removed bytes) and kept (the bytes left)."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep {keep!r}")
    workers_can_import(docs.sparkSession)
    docs = docs.drop("n_bytes", "removed", "kept")
    spans = merged_spans(repeat_spans(docs.select("doc_id", "text"), length, keep, hot), _KEY).toDF("__s1", "__s2", "__spans")
    text = F.coalesce("text", F.lit(""))
    joined = docs.withColumns({
        "__k1": F.xxhash64(F.col("doc_id").cast("long"), text), "__k2": F.hash(text, F.length(text)),
    }).join(spans, [F.col("__k1") == F.col("__s1"), F.col("__k2") == F.col("__s2")], "left")
    none = F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")
    cut = joined.select(
        *docs.columns, F.octet_length(text).cast("long").alias("n_bytes"),
        F.coalesce("__spans", none).alias("removed"), text.cast("binary").alias("kept"),
    )
    return cut.mapInArrow(_remove, kinds(cut))
