"""Benchmark decontamination: shared n-grams as seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. Every n-gram of every test item is a seed, so a
copy is met wherever edits left ``n`` words in a row, however often they are found elsewhere; one
without such a run, a word changed in every three, say, is not. A seed found in a document proposes
the passage around it, as long as the item and some slack; proposals that overlap merge. A passage
that shares fewer words with the item than a match needs is left out, as it cannot be one. Each other
is aligned with the item word by word (match 2, mismatch -1, gap -1), and the score is that of the
best local alignment as a share of the item's own, 0 to 1.

Items are taken in blocks of ``BLOCK_BYTES`` of text, each broadcast in turn, so that what a worker
holds is bounded; documents are scanned, never shuffled.

Cases: NULL or empty texts and items match nothing, nor do items of fewer than ``n`` words; an
empty table of either kind gives no match; repeated items and rows are judged alike; the column
``contamination`` of the result replaces one of that name, all others stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, text_batches, workers_can_import
from fieldtrail.llm.words import PLAIN, Words

BLOCK_BYTES = 8 << 20
PAIRS = 1 << 18  # of a shared n-gram and its place in an item, expanded at a time
MATCH, MISS, GAP = 2, -1, -1
_HIT = pa.struct([
    ("item_id", pa.int64()), ("score", pa.float64()), ("matched", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32()),
])
_HIT_SQL = "array<struct<item_id:bigint,score:double,matched:int,first_word:int,last_word:int>>"


@dataclass(frozen=True)
class Settings:
    n: int = 3
    slack: float = 0.5  # of the item's length, on both sides
    min_score: float = 0.5
    min_matched: int = 6  # equal words, or the whole item when it is shorter


class Items:
    """Word hashes of a block of test items, and the n-grams of all of them."""

    def __init__(self, rows: list[tuple[int | None, str]], n: int):
        words = Words([text.encode() for _, text in rows], PLAIN, latin=True)
        grams, bounds = words.shingles(n), words.first.tolist()
        self.ids = [item for item, _ in rows]
        self.words = [words.hash[a:b] for a, b in zip(bounds, bounds[1:])]
        self.grams = [grams[a : max(a, b - n + 1)] for a, b in zip(bounds, bounds[1:])]

    def seeds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of all n-grams with the item and place of each."""
        sizes = [len(g) for g in self.grams]
        hashes = np.concatenate([np.zeros(0, np.uint64), *self.grams])
        items = np.repeat(np.arange(len(sizes)), sizes)
        places = np.concatenate([np.zeros(0, np.int64), *map(np.arange, sizes)])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], items[order], places[order]


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n of ``counts``, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: (score, equal words, first, last place in ``passage``)."""
    m = len(passage)
    steps = np.arange(m + 1) * -GAP
    table = np.zeros((len(item) + 1, m + 1), np.int32)
    for i, word in enumerate(item, 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == word, MATCH, MISS))
        table[i] = np.maximum.accumulate(row + steps) - steps  # gaps along the passage
    i, j = np.unravel_index(int(np.argmax(table)), table.shape)
    score, last, equal, first = int(table[i, j]), int(j) - 1, 0, int(j)
    while i and j and table[i, j]:
        same = passage[j - 1] == item[i - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISS):
            i, j, equal, first = i - 1, j - 1, equal + bool(same), int(j) - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, equal, first, last


class Matcher:
    """Matches of texts with a block of items."""

    def __init__(self, items: Items, settings: Settings):
        self.items, self.s = items, settings
        hashes, self.item_of, self.place_of = items.seeds()
        self.hashes, self.first, self.count = np.unique(hashes, return_index=True, return_counts=True)
        self.sizes = np.array([len(w) for w in items.words], np.int64)
        self.slack = np.ceil(self.s.slack * self.sizes).astype(np.int64)
        self.counted = [np.unique(w, return_counts=True) for w in items.words]

    def _proposals(self, words: Words) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """(text, item) -> passages around shared n-grams, overlapping ones merged."""
        grams, text_of = words.shingles(self.s.n), words.text_of()
        ends = words.first[1:][text_of]
        low = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[low] == grams) & (np.arange(len(grams)) + self.s.n <= ends))
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        many = np.cumsum(self.count[low[hit]]) // PAIRS
        for some in np.split(hit, np.flatnonzero(many[1:] != many[:-1]) + 1):
            n = self.count[low[some]]
            seed = np.repeat(self.first[low[some]], n) + _ranges(n)
            text, item = np.repeat(text_of[some], n), self.item_of[seed]
            begin = np.repeat(some, n) - self.place_of[seed]
            order = np.lexsort((begin, item, text))
            text, item, begin = text[order], item[order], begin[order]
            size, slack = self.sizes[item], self.slack[item]
            a = np.maximum(begin - slack, words.first[text])
            b = np.minimum(begin + size + slack, words.first[text + 1])
            new = np.ones(len(a), bool)
            new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            for t, i, x, y, limit in zip(*(c[new].tolist() for c in (text, item, a, b, 4 * (size + 2 * slack)))):
                spans = out.setdefault((t, i), [])
                if spans and x <= spans[-1][1] and y >= spans[-1][0] and max(y, spans[-1][1]) - min(x, spans[-1][0]) <= limit:
                    spans[-1] = (min(x, spans[-1][0]), max(y, spans[-1][1]))
                else:
                    spans.append((x, y))
        return out

    def _needed(self, item: int) -> int:
        """Equal words without which no alignment with the item counts."""
        size = len(self.items.words[item])
        return max(math.ceil(self.s.min_score * size - 1e-9), min(self.s.min_matched, size))

    def _common(self, passage: np.ndarray, item: int) -> int:
        """Words that passage and item share in any order; no alignment has more equal ones."""
        known, count = self.counted[item]
        at = np.minimum(np.searchsorted(known, passage), len(known) - 1)
        return int(np.minimum(np.bincount(at[known[at] == passage], minlength=len(known)), count).sum())

    def __call__(self, texts: list[bytes]) -> list[list[dict]]:
        words = Words(texts, PLAIN, latin=True)
        out: list[list[dict]] = [[] for _ in texts]
        if not len(self.hashes) or not len(words.hash):
            return out
        for (text, item), spans in sorted(self._proposals(words).items()):
            target, needed = self.items.words[item], self._needed(item)
            spans = [(a, b) for a, b in spans if self._common(words.hash[a:b], item) >= needed]
            if not spans:
                continue
            best = max(
                ((*align(words.hash[a:b], target), a - int(words.first[text])) for a, b in spans),
                key=lambda x: (x[0], x[1], -x[4]),
            )
            score = best[0] / (MATCH * len(target))
            if score >= self.s.min_score and best[1] >= min(self.s.min_matched, len(target)):
                out[text].append({
                    "item_id": self.items.ids[item], "score": score, "matched": best[1],
                    "first_word": best[2] + best[4], "last_word": best[3] + best[4],
                })
        return out


def _match_block(docs: DataFrame, rows: list[tuple[int | None, str]], settings: Settings) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((Items(rows, settings.n), settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*shared.value)
        for batch in batches:
            hits = [h for _, _, texts in text_batches(batch, "text") for h in matcher(texts)]
            at = batch.schema.get_field_index("contamination")
            hits = [old + new for old, new in zip(batch.column(at).to_pylist(), hits)]
            yield batch.set_column(at, "contamination", pa.array(hits, pa.list_(_HIT)))

    return docs.mapInArrow(run, kinds(docs))


def find_contamination(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``contamination``, the matched items of each document (an empty list: clean)."""
    workers_can_import(docs.sparkSession)
    out = docs.drop("contamination").withColumn("contamination", F.expr(f"cast(array() as {_HIT_SQL})"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = math.ceil(size / BLOCK_BYTES)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        if rows:
            out = _match_block(out, rows, settings)
    return out
