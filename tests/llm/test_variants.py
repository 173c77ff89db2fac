"""Spelling variants, licence scan and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldtrail.llm import license_scan, periodic_runs, queries, spelling_variants
from tests.llm.fixtures import SCHEMA, documents, frame


def brute_runs(words, least, times):
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least,times", [(6, 4), (4, 2), (9, 3), (1, 2)])
def test_runs_of_random_texts(least, times):
    rng = random.Random(least)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            t = []
            while len(t) < rng.randint(0, 60):
                t += [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
            texts.append(np.array(t, np.int64))
        assert periodic_runs.runs_of(texts, least, times) == [brute_runs(t.tolist(), least, times) for t in texts]


def test_runs_of_long_texts():
    assert periodic_runs.runs_of([np.zeros(50_000, np.int64)]) == [[(0, 50_000, 1)]]
    block = np.arange(700)
    assert periodic_runs.runs_of([np.concatenate([np.tile(block, 9), [-1 + 700]])]) == [[(0, 6300, 700)]]


def repeated():
    rng = random.Random(5)
    rows = documents(seed=3)
    for i in range(100, 130):
        block = " ".join(rng.choice("a b c Dé".split()) for _ in range(rng.randint(1, 9)))
        rows.append((i, "x " + f"{block}\t" * rng.randint(2, 9) + "y y y y y y\n y\x0by z", "en", "src", 0, "x"))
    return rows


def test_periodic_runs(spark, tmp_path):
    rows = repeated()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            g, n, given = h // 10, len(words), list(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = given[a + (i - a) % p]
        runs = brute_runs(words, 6, 4)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want.append((
            doc_id, len(runs), s, n, q, n and 1000 * n // q,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
        ))
    assert got == sorted(want, key=str)
    assert sum(r[1] for r in got) > 20


def brute_variants(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    words = {w: n for w, n in counts.items() if n >= 2}

    def near(x, y):
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        x, y = sorted((x, y), key=len)
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    out, forms = {}, {}
    for w, n in words.items():
        close = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        forms[w] = close[0] if close and words[close[0]] >= 10 * n else None
        out[w] = len(close)
    rows = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, words[w], out[w], words[forms[w]] if forms[w] else None))
    return sorted(rows)


def spelled():
    rng = random.Random(8)
    rows = documents(seed=4)
    words = ["stonewall", "lightnings", "windowpane", "bbbbbbbb", "ÀéÿÖßçñ", "aaaaaaa", "Harbours"]
    for i in range(200, 240):
        text = []
        for w in words:
            text += [w] * rng.randint(0, 9)
            for _ in range(3):
                at = rng.randrange(len(w))
                text += [w[:at] + rng.choice(["", "x", "b", w[at] * 2]) + w[at + 1 :]] * rng.randint(0, 2)
        rows.append((i, " ".join(text), "en", "src", 0, "x"))
    return rows + [(300, "chained " * 3000 + "chainedd " * 250 + "chaineddd " * 20 + "chaineddde " * 2, "en", "src", 0, "x")]


@pytest.mark.parametrize("tile", [4096, 3])
def test_spelling_variants(spark, tile, monkeypatch):
    near = spelling_variants.near_words
    monkeypatch.setattr(spelling_variants, "near_words", lambda words: near(words, tile))
    rows = spelled()
    got = spelling_variants.group_variants(frame(spark, rows), damage=queries.drop_sign)
    got = sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert got == brute_variants(rows)
    assert any(form != root and form is not None for _, form, root, *_ in got)


def test_one_edit():
    assert spelling_variants.one_edit("abc", "abcd") and spelling_variants.one_edit("xabc", "abc")
    assert spelling_variants.one_edit("abc", "abd") and not spelling_variants.one_edit("abc", "acb")
    assert not spelling_variants.one_edit("abc", "abc") and not spelling_variants.one_edit("abc", "abcde")


def licensed():
    rng = random.Random(9)
    rows = documents(seed=5)
    notices = [
        "CC BY", "cc-by-sa 4.0", "GNU General Public\nLicense, version 3.", "all  RIGHTS reserved", "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0", "general public", "license", "all rights", "MIT", "ünder cc by é",
    ]
    for i in range(400, 460):
        rows.append((i, " ".join(rng.choice(notices + ["word", "by", "all"]) for _ in range(rng.randint(1, 40))), "en", "src", 0, "x"))
    return rows


def test_license_scan(spark, tmp_path):
    rows = licensed()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
           for r in queries.QUERIES["op12_license_scan"](spark, str(tmp_path)).collect()}
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lowered = [re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or "") for r in rows]
    texts = [split.findall(t) for t in lowered]
    templates = [(t, t.text.split(), [p.split() for p in t.phrases]) for t in license_scan.BASE + license_scan.NOTICES]
    index = license_scan.Index(license_scan.BASE + license_scan.NOTICES)
    held = Counter(w for t in texts for w in set(t))
    idf = {w: np.log((len(rows) + 1) / (held[w] + 1)) + 1 for t in templates for w in t[1]}
    assert len(idf) == len(index.vocabulary)
    want = set()
    for (doc_id, *_), words in zip(rows, texts):
        places, base, labels = [], set(), set()
        for k, (t, tw, phrases) in enumerate(templates):
            need = [next(i for i in range(len(tw)) if tw[i : i + len(p)] == p) for p in phrases]
            for start in range(-len(tw), len(words)):
                on = lambda i: 0 <= start + i < len(words) and words[start + i] == tw[i]
                if not all(on(a + i) for a, p in zip(need, phrases) for i in range(len(p))):
                    continue
                if sum(idf[w] for i, w in enumerate(tw) if on(i)) < 0.5 * sum(idf[w] for w in tw):
                    continue
                labels.add(t.label)
                if k < len(license_scan.BASE):
                    places.append(start)
                    base.add(t.label)
        want.add((doc_id, len(words), len(places), min(places, default=None), max(places, default=None),
                  ",".join(sorted(base)), ",".join(sorted(labels))))
    assert got == want
    assert {"mit", "apache-2.0"} <= {x for r in got for x in r[6].split(",")}


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert periodic_runs.find_runs(none).count() == 0
    assert license_scan.scan(none).count() == 0
    assert spelling_variants.group_variants(none).count() == 0
    clash = frame(spark).withColumnsRenamed({"lang": "runs", "source": "matches", "spans": "n_words"})
    assert periodic_runs.find_runs(clash).drop("runs", "n_words").count() == clash.count()
    assert license_scan.scan(clash).filter("size(matches) > 0").count() == 0
    assert license_scan.scan(clash, []).filter("n_words >= 0").count() == clash.count()
