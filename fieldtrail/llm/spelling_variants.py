"""Spelling variants: words one edit apart, and the frequent form each rare one stands for.

1. Words are counted per task first, then summed over all texts.
2. Two words one edit apart agree in the first half or in the rest, halves being those of the shorter
   one. So each word is filed by the halves of its own length and, as a longer partner, by those of
   the length below: a block holds words of two adjacent lengths.
3. Within a block, words are rows of letter counts; NumPy products of row blocks (Gram matrices) give
   all squared distances, |x|^2 + |y|^2 - 2xy. An edit changes them by at most two. Only pairs up to two
   are verified letter by letter.
4. Pairs are reduced to one row per word and block before they are shuffled: number and best partner.
   A pair that agrees in both halves counts in the block of the first half only.
5. A block of more than ``tile`` words is salted: its words are dealt into tiles, and every pair of tiles
   is one group.

A word's form is its near word of largest count (ties: smallest in code-point order), if that count is
at least ``ratio`` times its own. Forms grow by that factor, so roots need few rounds of doubled steps.

Cases: NULL and empty texts have no words; repeated rows count each; a NULL id reads as an empty one
in ``damage``; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored, workers_can_import

#: Letter counts are kept for so many classes; letters beyond share one by remainder, which can only
#: bring words closer, never apart.
CLASSES = 48
#: Words counted in a task before they are handed on.
HELD_WORDS = 400_000
GROUPS = 4096
_RUN = regex.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def count_words(docs: DataFrame, min_length: int, damage: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """(word, n) of all lower-cased letter runs of at least ``min_length`` signs; ``damage`` turns
    a (doc_id, run) into the word that is counted."""
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                for word, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
                    if len(word) >= min_length:
                        word = damage(i, word) if damage else word
                        if len(word) >= min_length:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        yield flush()

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def one_edit(x: str, y: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns x into y."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return x[i + 1 :] == y[i + 1 :] if len(x) == len(y) else x[i:] == y[i + 1 :]


def letter_counts(words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), CLASSES), np.float32)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    np.add.at(out, (np.repeat(np.arange(len(words)), [len(w) for w in words]), codes % CLASSES), 1)
    return out


def near_counts(x: np.ndarray, y: np.ndarray, rows: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, rows of y) whose letter counts lie at a squared distance of at most two."""
    squares = (y * y).sum(1)
    for a in range(0, len(x), rows):
        block = x[a : a + rows]
        distance = (block * block).sum(1)[:, None] + squares[None, :] - 2 * (block @ y.T)
        i, j = np.nonzero(distance < 2.5)
        yield i + a, j


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _verified(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of code points are one edit apart; rows of ``y`` are as long, or one longer."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    size = x.shape[1]
    from_left = np.logical_and.accumulate(x == y[:, :size], axis=1).sum(1)
    from_right = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return from_left + from_right >= size


def block_pairs(words: list[str], tiles: np.ndarray, length: int, front: bool, pair: tuple[int, int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of a block, each once, as positions in ``words``. Of a pair of tiles, pairs within
    one of them belong to the group of that tile with itself."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    short, long, cut = np.flatnonzero(sizes == length), np.flatnonzero(sizes == length + 1), length // 2
    if not len(short):
        return
    texts = [words[i] for i in short]
    counts, codes = letter_counts(texts), _codes(texts, length)
    for others in (short, long):
        if not len(others):
            continue
        same = others is short
        texts = [words[i] for i in others]
        to_counts, to_codes = (counts, codes) if same else (letter_counts(texts), _codes(texts, length + 1))
        for i, j in near_counts(counts, to_counts):
            fits = i < j if same else np.ones(len(i), bool)
            if pair is not None:
                s, t = tiles[short[i]], tiles[others[j]]
                fits &= (np.minimum(s, t) == pair[0]) & (np.maximum(s, t) == pair[1])
            i, j = i[fits], j[fits]
            if not front:
                fits = (codes[i, :cut] != to_codes[j, :cut]).any(1)
                i, j = i[fits], j[fits]
            fits = _verified(codes[i], to_codes[j])
            yield short[i[fits]], others[j[fits]]


_OUT = "word string, n_near long, form string, form_n long"


def near_words(words: DataFrame, tile: int = 4096) -> DataFrame:
    """(word, n_near, form, form_n) of all words with a near one, from (word, n)."""
    size = F.length("word")
    roles = F.array(F.struct(size.alias("length")), F.struct((size - 1).alias("length")))
    filed = words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", F.col("r.length").alias("length"))
    cut = F.floor(F.col("length") / 2).cast("int")
    halves = F.array(
        F.struct(F.lit(True).alias("front"), F.col("word").substr(F.lit(1), cut).alias("half")),
        F.struct(F.lit(False).alias("front"), F.expr("right(word, length - cast(floor(length / 2) as int))").alias("half")),
    )
    filed = filed.where("length >= 1").select("word", "n", "length", F.explode(halves).alias("h")).select("word", "n", "length", "h.*")
    key = ["length", "front", "half"]
    blocks = filed.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    # blocks of one word, or without a word of the shorter length, hold no pair
    large = stored(blocks.where(F.col("size") > tile), "large-blocks")
    tiles = F.ceil(F.col("size") / tile).cast("int")
    filed = filed.join(large, key, "left").withColumn("tiles", F.coalesce(tiles, F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    filed = filed.withColumn("tile", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    place = F.pmod(F.xxhash64(*key, low, high), F.lit(GROUPS)).cast("int")
    dealt = filed.select(
        "word", "n", *key, "tile", F.when(F.col("tiles") > 1, low).alias("low"), F.when(F.col("tiles") > 1, high).alias("high"), place.alias("place")
    )
    # a partition's blocks lie one after the other; only one block is held at a time
    ordered = dealt.repartition("place").sortWithinPartitions(*key, "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_now, held = None, []
        best: dict[str, tuple[int, str]] = {}
        near: defaultdict[str, int] = defaultdict(int)

        def compare() -> None:
            length, front, _, low, high = key_now
            words, ns, tiles = zip(*held)
            order = sorted(range(len(words)), key=lambda i: (-ns[i], words[i]))
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            number, first = np.zeros(len(words), np.int64), np.full(len(words), len(words))
            for a, b in block_pairs(words, np.array(tiles), length, front, None if low is None else (low, high)):
                for x, y in ((a, b), (b, a)):
                    number += np.bincount(x, minlength=len(words))
                    np.minimum.at(first, x, rank[y])
            for i in np.flatnonzero(number).tolist():
                y = order[first[i]]
                near[words[i]] += int(number[i])
                rival = (-ns[y], words[y])
                best[words[i]] = min(rival, best.get(words[i], rival))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(near.keys(), pa.string()), pa.array(near.values(), pa.int64()),
                 pa.array([best[w][1] for w in near], pa.string()), pa.array([-best[w][0] for w in near], pa.int64())],
                names=["word", "n_near", "form", "form_n"],
            )
            near.clear(), best.clear()
            return out

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "low", "high", "word", "n", "tile")]
            for *k, word, n, t in zip(*columns):
                if k != key_now:
                    if len(held) > 1:
                        compare()
                    key_now, held = k, []
                held.append((word, n, t))
            if len(near) >= HELD_WORDS:
                yield flush()
        if len(held) > 1:
            compare()
        yield flush()

    found = ordered.mapInArrow(run, _OUT)
    rank = F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form"))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(rank).alias("best"))
    return summed.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))


def group_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, damage=None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs``."""
    words = stored(count_words(docs, min_length, damage).where(F.col("n") >= min_count), "words")
    near = near_words(words)
    accepted = F.col("form_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(accepted, F.col("form")).alias("form"), F.when(accepted, F.col("form_n")).alias("form_n"),
    )
    judged = stored(judged, "forms")
    links = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = judged.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, max(ratio, 2))) + 1)  # each step multiplies the count by the ratio
    for _ in range(math.ceil(math.log2(steps))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = stored(links.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    roots = links.select("word", "root")
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
