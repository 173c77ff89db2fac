"""Suffix dedup, line dedup and the Jaccard join against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldtrail.llm import graph, jaccard_join, line_dedup, suffix_dedup
from fieldtrail.llm.words import Words
from tests.llm.fixtures import SCHEMA, documents, frame


def brute_bytes(rows, length, keep):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen, first = Counter(), {}
    for d, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] += 1
            first.setdefault(t[i : i + length], (d, i))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if seen[s] > 1 and (keep == "none" or first[s] != (d, i)):
                gone[i : i + length] = b"\1" * length
        out.append((d, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("keep", "hot", "length"), [("none", 4096, 60), ("none", 2, 60), ("first", 4096, 60), ("first", 2, 60), ("none", 4096, 200), ("none", 1, 33)])
def test_suffix_dedup(spark, keep, hot, length, monkeypatch):
    if hot < 3:  # also spread the larger classes
        monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 2)
        monkeypatch.setattr(suffix_dedup, "HOT_CLASSES", 1 << 40)
        monkeypatch.setattr(suffix_dedup, "SALTS", 4)
    rows = [r for r in documents() if keep == "none" or r[:1] != (3,) or r[4] != 0]
    got = suffix_dedup.dedup(frame(spark, rows), length, keep, hot).collect()
    assert sorted(((r["doc_id"], bytes(r["kept"])) for r in got), key=str) == brute_bytes(rows, length, keep)
    for r in got:
        assert r["n_bytes"] == len((r["text"] or "").encode()) == len(r["kept"]) + sum(s["b"] - s["a"] for s in r["removed"])
        assert all(x["b"] < y["a"] for x, y in zip(r["removed"], r["removed"][1:]))


def test_suffix_dedup_repeated_rows_are_one_document_when_the_first_stays(spark):
    rows = documents()
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(frame(spark, rows), 60, "first").filter("doc_id = 3").collect()}
    assert kept[3] == rows[3][1].encode()


def test_longest_factors():
    import numpy as np

    text = b"abracadabra$abrac"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
    before, after = suffix_dedup.longest_factors(np.array(order), lcp)
    for i, p, n in zip(order, before.tolist(), after.tolist()):
        assert p == max([common(i, j) for j in range(i)], default=0)
        assert n == max([common(i, j) for j in range(i + 1, len(text))], default=0)


def brute_lines(rows, size):
    docs = {(r[0], r[1]) for r in rows}
    found = []
    for d, t in docs:
        lines = [(i, x.strip(" \t\r\f\v")) for i, x in enumerate((t or "").split("\n"))] if t is not None else []
        lines = [x for x in lines if x[1]]
        found += [((d is not None, d or 0), t, w[0][0], w[-1][0], tuple(x for _, x in w)) for w in (lines[i : i + size] for i in range(len(lines) - size + 1))]
    seen, out = set(), {(d, t): set() for d, t in docs}
    for (has, d), t, a, b, w in sorted(found, key=lambda x: (x[0], x[2])):
        if w in seen:
            out[(d if has else None, t)].update(range(a, b + 1))
        seen.add(w)
    return {k: None if k[1] is None else "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in v) for k, v in out.items()}, out


def test_line_dedup(spark):
    rows = documents()
    want, gone = brute_lines(rows, 3)
    got = line_dedup.dedup_lines(frame(spark, rows).withColumn("n_lines", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    for r in got:
        key = (r["doc_id"], r["text"])
        assert (r["kept_text"], r["n_removed"]) == (want[key], len(gone[key]))
    assert any(gone.values())


def brute_components(rows, n, percent):
    sets = [set(s.tolist()) for s in Words([(r[1] or "").encode() for r in rows]).shingle_sets(n)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if x and y and 100 * len(x & y) >= percent * len(x | y) and label[i] != label[j]:
                    low, high = sorted((label[i], label[j]))
                    label = [low if v == high else v for v in label]
                    changed = True
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[label[i]] = min(smallest.get(label[i], r[0]), r[0])
    return sorted(((r[0], len(sets[i]), smallest.get(label[i], r[0])) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize(("n", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (3, 50, 3), (1, 70, 4)])
def test_jaccard_join(spark, n, percent, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 1500)
    rows = documents(seed)
    got = jaccard_join.link_documents(frame(spark, rows), n, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_components(rows, n, percent)


def test_jaccard_join_compares_the_members_of_a_tile(spark):
    """u links with v and y, v with x; x and y, which name the components, were compared in vain."""
    rng, rows = random.Random(2), []
    for case in range(150):
        parts = [[], [], [], []]
        for j in range(400):
            shingle = int(Words([f"c{case}w{j}".encode()]).shingle_sets(1)[0][0])
            parts[(shingle >> 32) * 4 >> 32].append(f"c{case}w{j}")
        e, f, g, h = parts
        y = {*e[:5], *f[:5], *g[:5], *h[:5]}
        a, b, c, d = e[0], g[5], f[0], h[5]
        sets = [y, y - {a} | {b}, y - {c} | {d, b}, y - {a, c} | {b, d}]
        sets += [{*e[:5], *f[k : k + 5], *g[k : k + 5], *h[k : k + 5]} for k in range(10, 50, 10)]
        rows += [(8 * case + k, " ".join(rng.sample(sorted(s), len(s))), "en", "s", 0, "x") for k, s in enumerate(sets)]
    assert jaccard_join.parts(6, 90)[0] == 4 and jaccard_join.band(6) == (18, 26)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(frame(spark, rows), 1, 90).collect()}
    assert got == {d: d if d % 8 > 3 else d - d % 8 for d in range(len(rows))}


def test_shingles_of_short_texts():
    sets = Words([b"", b"  ", b"A b", b"a B", b"a b c", b"a b c a b c", b"ab"]).shingle_sets(3)
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 3, 1]
    assert sets[2] == sets[3] and sets[2] != sets[6] and sets[2] != sets[4]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = {r["v"]: r["label"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.dedup(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert jaccard_join.link_documents(empty).count() == 0
