"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models. Each model sees the
words of a text and the probabilities of the categories before it; in training those are
out-of-fold predictions, so that a later model learns from earlier ones as they will err on new
texts. At prediction all rows' final models are used.

A text's features are the distinct words (runs of letters, runs of signs) it holds, and the first
four to six bytes of longer words, each as a 64-bit hash. The models are fitted on a bounded
sample: the ``sample_docs`` labelled rows with the smallest hash of their id. Of its features the
``features`` that tell most about a category (by likelihood ratio, each category an equal share)
are kept. Sample and feature count are parameters; scoring covers whole texts of all rows and
shuffles nothing.

Cases: NULL or empty text gets the models' prior, hence not toxic; a category without both
outcomes in the sample is its constant rate (0 without labels); labels of unknown or NULL ids are ignored, of repeated
ids the largest counts; an empty table gives no rows; columns named like the result's are replaced,
all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, text_batches, workers_can_import
from fieldtrail.llm.words import RUNS, Words

PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 8_000
    #: Sample documents that must hold a feature; what fewer hold tells too little to be weighed.
    min_feature_docs: int = 4
    features: int = 3_000
    folds: int = 3
    steps: int = 300
    l2: float = 1.0


def hashed_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature hash) of every word and prefix; may repeat."""
    words = Words(texts, RUNS, latin=True)
    text_of = words.text_of()
    parts = [(text_of, words.hash)]
    for n in PREFIXES:
        long, hashes = words.prefixes(n)
        parts.append((text_of[long], hashes))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def known_features(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, index in ``known``), distinct and sorted."""
    text, hashes = hashed_features(texts)
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
    pairs = np.unique(text[hit] * np.int64(max(len(known), 1)) + at[hit])
    return pairs // max(len(known), 1), pairs % max(len(known), 1)


class Rows:
    """Sparse 0/1 rows with some dense columns."""

    def __init__(self, n: int, row: np.ndarray, feature: np.ndarray, width: int):
        self.n, self.row, self.feature, self.width = n, row, feature, width
        self.dense = np.zeros((n, 0))

    def with_column(self, values: np.ndarray) -> Rows:
        out = Rows(self.n, self.row, self.feature, self.width)
        out.dense = np.column_stack([self.dense, values])
        return out

    def take(self, chosen: np.ndarray) -> Rows:
        new = np.cumsum(chosen) - 1
        hit = chosen[self.row]
        out = Rows(int(chosen.sum()), new[self.row[hit]], self.feature[hit], self.width)
        out.dense = self.dense[chosen]
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, weights=w[self.feature], minlength=self.n)
        return sparse + self.dense @ w[self.width : -1] + w[-1]

    def back(self, r: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.feature, weights=r[self.row], minlength=self.width)
        return np.concatenate([sparse, self.dense.T @ r, [r.sum()]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: Rows, y: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights (features, dense columns, intercept) of a logistic model with an L2 penalty."""
    w = np.zeros(rows.width + rows.dense.shape[1] + 1)
    rate = (y.sum() + 0.01) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if not 0 < y.sum() < len(y):
        return w
    # steps per weight, from a bound of the curvature; Nesterov's momentum
    ones = np.ones(rows.n)
    per_row = np.bincount(rows.row, minlength=rows.n) + np.abs(rows.dense).sum(1) + 1
    bound = np.concatenate([
        np.bincount(rows.feature, weights=per_row[rows.row], minlength=rows.width),
        np.abs(rows.dense).T @ per_row, [ones @ per_row],
    ]) / 4 + settings.l2
    penalty = np.full(len(w), settings.l2)
    penalty[-1] = 0
    ahead, before = w.copy(), w.copy()
    for step in range(settings.steps):
        gradient = rows.back(sigmoid(rows.times(ahead)) - y) + penalty * ahead
        w = ahead - gradient / bound
        ahead = w + step / (step + 3) * (w - before)
        before = w
    return w


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    known: np.ndarray
    weights: tuple[np.ndarray, ...]
    thresholds: tuple[float, ...]

    def predict(self, texts: list[bytes]) -> list[np.ndarray]:
        """Probabilities per category."""
        rows, out = Rows(len(texts), *known_features(texts, self.known), len(self.known)), []
        for w in self.weights:
            out.append(sigmoid(rows.times(w)))
            rows = rows.with_column(out[-1])
        return out


def best_threshold(y: np.ndarray, p: np.ndarray) -> float:
    """The middle of the gap in ``p`` that splits it with the best F1, between 0.1 and 0.9."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    best = int(np.argmax(2 * hits / (np.arange(1, len(y) + 1) + y.sum())))
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float(np.clip((p[order[best]] + below) / 2, 0.1, 0.9))


def fit_chain(rows: Rows, labels: np.ndarray, settings: Settings) -> tuple[tuple[np.ndarray, ...], tuple[float, ...]]:
    """One model per column of ``labels``; earlier ones enter later ones out of fold. Also the
    threshold of each, from its out-of-fold predictions."""
    fold, weights, thresholds = np.arange(rows.n) % settings.folds, [], []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        weights.append(fit(rows, y, settings))
        unseen = np.zeros(rows.n)
        for f in range(settings.folds):
            if (fold == f).any() and (fold != f).any():
                unseen[fold == f] = sigmoid(rows.take(fold == f).times(fit(rows.take(fold != f), y[fold != f], settings)))
        rows = rows.with_column(unseen)
        thresholds.append(best_threshold(y, unseen))
    return tuple(weights), tuple(thresholds)


def _pick_features(sample: DataFrame, categories: list[str], settings: Settings) -> np.ndarray:
    """Sorted hashes of the features that tell most about the categories."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [np.array(batch.column(c).to_pylist(), np.int64) for c in categories]
            for a, b, texts in text_batches(batch, "text"):
                text, hashes = hashed_features(texts)
                distinct, where = np.unique(hashes, return_inverse=True)
                pairs = np.unique(where * np.int64(len(texts)) + text)
                which, of = pairs // len(texts), pairs % len(texts)
                counts = [np.bincount(which, minlength=len(distinct))]
                counts += [np.bincount(which, weights=y[a:b][of], minlength=len(distinct)).astype(np.int64) for y in labels]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), *map(pa.array, counts)], names=["feature", "n", *categories]
                )

    names = ["n", *categories]
    counted = (
        sample.mapInArrow(run, "feature long, " + ", ".join(f"`{c}` long" for c in names))
        .groupBy("feature").agg(*(F.sum(c).alias(c) for c in names)).filter(F.col("n") >= settings.min_feature_docs).persist()
    )
    totals = sample.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).first()
    chosen: set[int] = set()
    for c in categories:
        positive, all_rows = totals[c] or 0, totals["n"]
        if not 0 < positive < all_rows:
            continue

        def part(observed, expected):
            return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

        a, b, rate = F.col(c), F.col("n") - F.col(c), positive / all_rows
        told = part(a, F.col("n") * rate) + part(b, F.col("n") * (1 - rate))
        best = counted.select("feature", told.alias("told")).orderBy(F.desc("told"), "feature")
        chosen.update(r["feature"] for r in best.limit(settings.features // len(categories)).collect())
    counted.unpersist()
    return np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], settings: Settings = Settings()) -> Chain:
    """A chain over 0/1 columns of ``labels``, in the given order."""
    workers_can_import(docs.sparkSession)
    known_labels = labels.filter(" AND ".join(["doc_id IS NOT NULL", *(f"`{c}` IN (0, 1)" for c in categories)]))
    # labels without a document take no place in the sample; only ids are moved for that
    present = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    some = (
        known_labels.groupBy("doc_id").agg(*(F.max(c).cast("long").alias(c) for c in categories))
        .join(present, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_docs)
    )
    # one row per id, reduced before it is shuffled: an id may be on many rows
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
        .groupBy("doc_id", *categories).agg(F.min("text").alias("text"))
        .select("doc_id", "text", *categories)
    )
    known = _pick_features(sample, categories, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, texts in text_batches(batch, "text"):
                row, feature = known_features(texts, known)
                found += np.split(feature, np.searchsorted(row, np.arange(1, len(texts))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())), *(batch.column(c) for c in categories)],
                names=["found", *categories],
            )

    schema = "found array<int>, " + ", ".join(f"`{c}` long" for c in categories)
    table = sample.mapInArrow(run, schema).toArrow()  # sample_docs rows of at most ``features`` numbers
    lists, n = table.column("found").combine_chunks(), table.num_rows
    sizes = np.array([len(x) for x in lists.to_pylist()], np.int64)
    feature = np.array(lists.flatten().to_pylist(), np.int64)
    rows = Rows(n, np.repeat(np.arange(n), sizes), feature, len(known))
    values = np.column_stack([np.array(table.column(c).to_pylist(), np.int64) for c in categories])
    return Chain(tuple(categories), known, *fit_chain(rows, values.reshape(n, len(categories)), settings))


def score(docs: DataFrame, chain: Chain, decisive: str, threshold: float | None = None) -> DataFrame:
    """``docs`` with ``p_<category>`` of each category, and ``is_<decisive>``: at ``threshold``, or at
    the one that separated the training rows best out of fold."""
    workers_can_import(docs.sparkSession)
    names = [f"p_{c}" for c in chain.categories]
    docs = docs.drop(*names, f"is_{decisive}")
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = chain.categories.index(decisive)
    threshold = chain.thresholds[at] if threshold is None else threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.predict(texts) for _, _, texts in text_batches(batch, "text")]
            if not parts:
                continue
            p = [np.concatenate(c) for c in zip(*parts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, p), pa.array(p[at] >= threshold)],
                names=[*batch.schema.names, *names, f"is_{decisive}"],
            )

    schema = ", ".join([kinds(docs), *(f"`{c}` double" for c in names), f"`is_{decisive}` boolean"])
    return docs.mapInArrow(run, schema)
