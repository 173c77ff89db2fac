"""Licence scan: a positional index of the rarest words of licence templates.

1. Document frequencies of all words of the templates are counted over all rows; only that many
   counts reach the driver. They give each word's inverse document frequency (IDF).
2. Each template is filed under the highest-IDF word of its key phrases, with the word's position: any
   file that holds the phrases holds that word. Equally rare words: the earlier position.
3. A file's places of filed words fetch (template, offset) postings. The other words of the key
   phrases must stand at their relative positions.
4. Of what is left, the score is the IDF-weighted share of the template's words at their relative
   positions; from ``min_score`` on it is a match. A template that is one key phrase scores 1.

Every place in a text is found. Words are runs of a-z, 0-9 and non-ASCII signs, A-Z lower-cased; they
are compared by 64-bit hashes. Templates are broadcast within the tasks' code, a few kB.

Cases: NULL or empty texts have no words and no match; rows are judged one by one, so repeated rows
and NULL ids do not matter; an empty table gives no rows; ``n_words`` and ``matches`` replace
columns of these names, all others stay. No template, no match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, text_batches, workers_can_import
from fieldtrail.llm.words import PLAIN, Words


class Template(NamedTuple):
    label: str
    text: str
    #: Parts of ``text`` that must stand in a file as they are.
    phrases: tuple[str, ...]


def phrase(label: str, text: str) -> Template:
    """A template that is nothing but its key phrase."""
    return Template(label, text, (text,))


# Phrases whose labels are given.
BASE = (phrase("cc-by", "cc by"), phrase("gpl", "general public license"), phrase("reserved", "all rights reserved"))

#: Notices of common licences.
NOTICES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("bsd", "released under the bsd license", ("bsd license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("gpl-2", "gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("cc", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)


def _hashes(text: str) -> np.ndarray:
    return Words([text.encode()], PLAIN).hash


class _Filed(NamedTuple):
    words: np.ndarray  # numbers of the template's words
    weights: np.ndarray
    must: np.ndarray  # positions of key phrases
    rare: int  # position of the rarest of them


class Index:
    """Templates filed under their rarest key word."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        hashed = [_hashes(t.text) for t in self.templates]
        self.vocabulary = np.unique(np.concatenate([*hashed, np.zeros(0, np.uint64)]))
        self.words = [np.searchsorted(self.vocabulary, h) for h in hashed]
        self.must = [self._positions(t, h) for t, h in zip(self.templates, hashed)]
        self.filed: list[_Filed] = []

    @staticmethod
    def _positions(template: Template, words: np.ndarray) -> np.ndarray:
        at: set[int] = set()
        for p in template.phrases:
            part = _hashes(p)
            hits = [i for i in range(len(words) - len(part) + 1) if (words[i : i + len(part)] == part).all()]
            if not hits or not len(part):
                raise ValueError(f"{p!r} is no part of {template.text!r}")
            at.update(range(hits[0], hits[0] + len(part)))
        if not at:
            raise ValueError(f"{template.text!r} needs a key phrase")
        return np.array(sorted(at))

    def numbers(self, words: Words) -> np.ndarray:
        """Each word's number in the vocabulary, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(words.hash), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words.hash, at, -1)

    def file(self, frequency: dict[int, int], rows: int) -> None:
        idf = np.array([math.log((rows + 1) / (frequency.get(i, 0) + 1)) + 1 for i in range(len(self.vocabulary))])
        for words, must in zip(self.words, self.must):
            self.filed.append(_Filed(words, idf[words], must, int(must[np.argmax(idf[words[must]])])))

    def matches(self, words: Words, min_score: float) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """(texts, template, words where it would start, scores); a start may lie before the text."""
        number, text = self.numbers(words), words.text_of()
        known = np.flatnonzero(number >= 0)
        first, end = words.first[:-1], words.first[1:]
        for t, filed in enumerate(self.filed):
            place = known[number[known] == filed.words[filed.rare]]
            start, owner = place - filed.rare, text[place]

            def stands(p: int) -> np.ndarray:
                at = start + p
                inside = (at >= first[owner]) & (at < end[owner])
                return inside & (number[np.where(inside, at, 0)] == filed.words[p])

            for p in filed.must.tolist():
                fits = stands(p)
                start, owner = start[fits], owner[fits]
            if len(start):
                share = sum(stands(p) * w for p, w in enumerate(filed.weights.tolist())) / filed.weights.sum()
                good = share >= min_score
                # a place is named by its first key word, which does stand in the text
                yield owner[good], t, (start + filed.must[0] - first[owner])[good], np.minimum(share, 1.0)[good]


def frequencies(docs: DataFrame, index: Index) -> tuple[dict[int, int], int]:
    """(rows that hold each word of the vocabulary, all rows)."""
    size = len(index.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, texts in text_batches(batch, "text"):
                words = Words(texts, PLAIN)
                number = index.numbers(words)
                known = np.flatnonzero(number >= 0)
                pairs = np.unique(words.text_of()[known] * (size + 1) + number[known])
                held += np.bincount(pairs % (size + 1), minlength=size + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(size), -1], pa.int32()), pa.array([*held[:size], rows], pa.int64())], names=["word", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counted.collect()}  # one row per word of the templates
    return found, found.pop(-1, 0)


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + NOTICES, min_score: float = 0.5) -> DataFrame:
    """``docs`` with n_words and matches (template number, label, word, score) by word, then template."""
    workers_can_import(docs.sparkSession)
    index = Index(templates)
    index.file(*frequencies(docs, index))
    labels = [t.label for t in templates]
    kept = docs.drop("n_words", "matches")
    names = kept.columns
    kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_batches(batch, "text"):
                words = Words(texts, PLAIN)
                rows: list[list[dict]] = [[] for _ in texts]
                for owners, t, starts, scores in index.matches(words, min_score):
                    for i, start, score in zip(owners.tolist(), starts.tolist(), scores.tolist()):
                        rows[i].append({"template": t, "label": labels[t], "word": start, "score": score})
                for found in rows:
                    found.sort(key=lambda m: (m["word"], m["template"]))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names] + [pa.array(np.diff(words.first), pa.int64()), pa.array(rows, kind)],
                    names=[*names, "n_words", "matches"],
                )

    fields = "array<struct<template:int,label:string,word:bigint,score:double>>"
    return kept.mapInArrow(run, f"{kinds(kept)}, n_words long, matches {fields}")
