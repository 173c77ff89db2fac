"""Periodic runs of words: stretches that repeat one block at least ``exponent`` times.

A run of smallest period q from word s on, L words long, is a maximal pair: the words at s and s + q
continue alike for exactly L - q words, and the words before them differ. So runs are the maximal
pairs (i, j) with common length m and distance d = j - i <= m / (exponent - 1); nothing is extended.

1. Words become numbers per text; only texts with a repeated gram of ``min_common`` words, the least
   common length a run can have, go on.
2. Prefix doubling sorts the suffixes of such texts; those of length-1 groups are settled at once.
3. Longest common prefixes of neighbours give the LCP-interval tree, walked bottom-up. Each interval
   keeps its places listed by their left word. Where two children meet, every place of the smaller
   one looks for places of the larger within the distance, of other left words only.
4. Of pairs with the same stretch the one with the smallest period is the run.

Step 3 looks at the left-word lists or at the few places within the distance, whichever is less;
as places of a string closer than a third of its length form one progression, both stay small.

A word is dropped if a run contains it after the run's first period. Common lengths are found by 64-bit
hashes of word numbers. A text lies in one task with a few numbers per word.

Cases: NULL or blank texts have no words and no run, and collapse to an empty text; texts are
judged row by row, so repeated rows and NULL ids do not matter; an empty table gives no rows;
``n_words``, ``runs`` and ``collapsed`` replace columns of these names, all others stay.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldtrail.llm.common import kinds, text_batches, workers_can_import
from fieldtrail.llm.words import mix, powers

Run = tuple[int, int, int]  # start, length, period
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number per distinct word."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def repeated_grams(ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Places whose n-gram starts at another place of its text, too."""
    size = len(ids) - n + 1
    if size <= 1:
        return np.zeros(0, np.int64)
    grams = mix(text[:size].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55) + np.uint64(1))
    for k in range(n):
        grams = mix(grams + ids[k : k + size].astype(np.uint64) * np.uint64(2 * k + 3))
    inside = np.flatnonzero(text[:size] == text[n - 1 :])
    grams = grams[inside]
    ranked = np.sort(grams)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    return inside[twice[at] == grams]


def suffix_ranks(ids: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rank of each suffix among those of all texts; ``end`` is where the text of a place ends.
    Numbers of different texts are different, so their suffixes share nothing."""
    _, rank, sizes = np.unique(ids, return_inverse=True, return_counts=True)
    rank = (np.cumsum(sizes) - sizes)[rank]
    open_ = np.flatnonzero(sizes[np.searchsorted(np.cumsum(sizes), rank, side="right")] > 1)
    step, n = 1, len(ids)
    while len(open_):
        then = open_ + step
        second = np.where(then < end[open_], rank[np.minimum(then, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[open_]))
        open_, second = open_[order], second[order]
        first = rank[open_]
        new_group = np.concatenate([[True], first[1:] != first[:-1]])
        new_part = new_group | np.concatenate([[True], second[1:] != second[:-1]])
        index = np.arange(len(open_))
        group_at = np.maximum.accumulate(np.where(new_group, index, 0))
        part_at = np.maximum.accumulate(np.where(new_part, index, 0))
        rank[open_] = first + part_at - group_at
        alone = new_part & np.concatenate([new_part[1:], [True]])
        open_ = open_[~alone]
        step *= 2
    return rank


def common_lengths(ids: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share, up to the end of either text."""
    up, inverse = powers(len(ids))
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * up[: len(ids)], out=total[1:])
    limit = np.minimum(end[a] - a, end[b] - b)
    same = np.zeros(len(a), np.int64)
    step = 1 << int(limit.max(initial=0)).bit_length()
    while step:
        longer = same + step
        x, y = a + same, b + same
        fits = np.flatnonzero(longer <= limit)
        x, y = x[fits], y[fits]
        equal = (total[x + step] - total[x]) * inverse[x] == (total[y + step] - total[y]) * inverse[y]
        same[fits[equal]] += step
        step >>= 1
    return same


class _Interval:
    """Places below an LCP interval, listed by their left word."""

    __slots__ = ("size", "lists")

    def __init__(self, place: int, left: int):
        self.size, self.lists = 1, {left: [place]}


def close_pairs(order: list[int], lcp: list[int], left: dict[int, int], least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Maximal pairs (first place, distance, common length m) with ``times`` * distance <= m and m >= ``least``.

    ``lcp[k]`` belongs to ``order[k]`` and the place after it.
    """
    owner: dict[int, _Interval] = {}

    def meet(m: int, x: _Interval, y: _Interval) -> Iterator[tuple[int, int, int]]:
        small, large = (x, y) if x.size < y.size else (y, x)
        reach = m // times
        for word, places in small.lists.items():
            if len(large.lists) <= 2 * reach:
                for other, there in large.lists.items():
                    if other != word:
                        for p in places:
                            for q in there[bisect_left(there, p - reach) : bisect_right(there, p + reach)]:
                                yield min(p, q), abs(p - q), m
            else:
                for p in places:
                    for q in range(p - reach, p + reach + 1):
                        if owner.get(q) is large and left[q] != word:
                            yield min(p, q), abs(p - q), m
        for word, places in small.lists.items():
            there = large.lists.setdefault(word, [])
            for p in places:
                insort(there, p)
                owner[p] = large
        large.size += small.size
        merged.append(large)

    merged: list[_Interval] = []
    stack: list[tuple[int, _Interval]] = []
    for place, shared in zip(order, lcp):
        now = _Interval(place, left[place])
        owner[place] = now
        while stack and stack[-1][0] > shared:
            m, before = stack.pop()
            yield from meet(m, before, now)
            now = merged.pop()
        if stack and stack[-1][0] == shared:
            yield from meet(shared, stack.pop()[1], now)
            now = merged.pop()
        if shared >= least:
            stack.append((shared, now))
        else:
            owner.clear()


def runs_of(texts: list[np.ndarray], min_length: int = 6, exponent: int = 4) -> list[list[Run]]:
    """The runs of each text of word numbers, by (start, period)."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    # m = L - q >= max(min_length, exponent * q) - q is least at one of these periods
    least = min(max(min_length, exponent * q) - q for q in range(1, min_length // exponent + 2))

    def joined(chosen: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(texts[i]) for i in chosen], np.int64)
        most = np.array([texts[i].max(initial=-1) + 1 for i in chosen], np.int64)
        ids = np.concatenate([texts[i] for i in chosen]) + np.repeat(np.cumsum(most) - most, sizes)
        return ids, np.repeat(np.arange(len(chosen)), sizes), np.cumsum(sizes)

    if not any(len(t) for t in texts):
        return [[] for _ in texts]
    ids, text, _ = joined(list(range(len(texts))))
    chosen = np.unique(text[repeated_grams(ids, text, least)]).tolist()
    if chosen:
        ids, text, ends = joined(chosen)
        end = ends[text]
        places = repeated_grams(ids, text, least)
        order = places[np.argsort(suffix_ranks(ids, end)[places])]
        lcp = np.concatenate([common_lengths(ids, end, order[:-1], order[1:]), [0]])
        begin = np.concatenate([[0], ends[:-1]])[text[order]]
        left = np.where(order > begin, ids[order - 1], -1)
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        owner_text = text.tolist()
        for i, d, m in close_pairs(order.tolist(), lcp.tolist(), dict(zip(order.tolist(), left.tolist())), least, exponent - 1):
            if m + d >= max(min_length, exponent * d):
                t = owner_text[i]
                key, runs = (i - starts[t], m + d), found[chosen[t]]
                runs[key] = min(d, runs.get(key, d))
    return [sorted(((s, n, q) for (s, n), q in runs.items()), key=lambda r: (r[0], r[2])) for runs in found]


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Without the words that a run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def find_runs(
    docs: DataFrame, min_length: int = 6, exponent: int = 4,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``docs`` with n_words, runs (by start, then period) and collapsed, the kept words joined by spaces.

    A run has at least ``min_length`` words and ``exponent`` periods. ``rewrite`` turns the words of
    a (doc_id, words) into those that are judged.
    """
    workers_can_import(docs.sparkSession)
    kept = docs.drop("n_words", "runs", "collapsed")
    names = kept.columns
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in text_batches(batch, "text"):
                part = batch.slice(first, last - first)
                words = [t.split() for t in texts]  # of bytes: at space and \t..\r only
                if rewrite is not None:
                    words = [rewrite(i, w) for i, w in zip(part.column("doc_id").to_pylist(), words)]
                runs = runs_of([numbered(w) for w in words], min_length, exponent)
                rows = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs]
                left = [b" ".join(kept_words(w, r)).decode() for w, r in zip(words, runs)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names]
                    + [pa.array(map(len, words), pa.int64()), pa.array(rows, _RUNS), pa.array(left, pa.string())],
                    names=[*names, "n_words", "runs", "collapsed"],
                )

    return kept.mapInArrow(run, f"{kinds(kept)}, n_words long, runs {RUNS}, collapsed string")
