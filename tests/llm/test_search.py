"""URL filters, nearest neighbours and decontamination."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldtrail.llm import decontaminate, neighbours, url_filters
from fieldtrail.llm.queries import URL_RULES
from tests.llm.fixtures import SCHEMA, documents, edited, frame, sentence

URLS = [
    "http://example.org/es/x", "https://www.EXAMPLE.org/en/13", "http://example.org/en/2", "http://notexample.org/es/", "http://org", "http://org/",
    "http://a.com/fr/1?x=://y", "http://b.com/de/", "http://b.com/de", "ftp://b.com#/de/", "b.com/de/", "://", "", None, "http://casino.net/a",
    "http://net/Adult-x?q", "http://x.net/adults", "http://x.com:80/de/1", "http://é.com/fr/", "http://a.b\n.org/es/", "http://example.org./es/1", "x" * 50_000 + "://q.org/",
]


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for r in URL_RULES:
        if r.listed:
            h, _, p = r.name.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
                best = r
    if best:
        return host, path, best.name, best.verdict
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in (host + path).lower()).split()
    return host, path, None, "block" if set(words) & set(url_filters.DEFAULT_WORDS) else "allow"


@pytest.mark.parametrize("map_rules", [2000, 0])
def test_url_filters(spark, map_rules):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS[:2])]
    got = url_filters.filter_urls(spark.createDataFrame(rows, "page_id int, url string, verdict string"), URL_RULES, map_rules=map_rules)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == {i: judge(u) for i, u, _ in rows}
    empty = spark.createDataFrame([], "page_id int, url string")
    assert url_filters.filter_urls(empty, URL_RULES, map_rules=map_rules).count() == 0


def test_rules_are_filed_by_rarity(spark):
    urls = spark.createDataFrame([("a.com/fr/x",), ("b.com/de/",), ("c.com/de/",)], "place string").select(F.split("place", "/")[0].alias("host"), F.col("place").alias("path"))
    assert set(url_filters._file_rules(urls, [url_filters.place_rule("allow", "com/fr/")])) == {"fr"}


def embedding_rows(n=700, dims=16):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, dims))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=dims)).tolist(), "x") for i in range(n)]
    rows += [(1000 + i, rows[0][1], "x") for i in range(30)]  # ties across the whole block
    rows += [(2000, None, "x"), (2050, [0.0] * dims, "x"), (2100, [None] + [1.0] * (dims - 1), "x"), (2150, [float("nan")] * dims, "x")]
    return rows + [(2200, [1.0], "x"), (None, rows[1][1], "x"), rows[5], (2250, [1e300] * dims, "x"), (2300, [], "x")]


def brute_nearest(rows, k):
    dims = 16
    usable = {r[0]: np.array(r[1]) for r in rows if r[0] is not None and r[1] and len(r[1]) == dims and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])}
    out = {}
    for q in usable:
        if q % 50 == 0:
            scored = [(-float(neighbours.cosines(usable[q][None], v[None])[0]), i) for i, v in usable.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def test_neighbours_exact_when_the_window_covers_all(spark):
    rows = embedding_rows()
    want = brute_nearest(rows, 5)
    got = neighbours.nearest(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4), F.col("id") % 50 == 0, 5,
        settings=neighbours.Settings(block_rows=64, target_recall=1.01),
    ).collect()
    found: dict = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found == want


def test_neighbours_recall_and_empty(spark):
    rows = embedding_rows(3000)
    want = brute_nearest(rows, 5)
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = neighbours.nearest(frame_, F.col("id") % 50 == 0, 5, settings=neighbours.Settings(block_rows=64)).collect()
    hits = sum((r["vec_id"], r["score"]) in want[r["query_id"]] for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert neighbours.nearest(frame_.limit(0), F.col("id") % 50 == 0, 5).count() == 0
    assert neighbours.nearest(frame_.filter("vec_id = 50"), F.col("id") % 50 == 0, 5).count() == 0


def hot_vectors(share, noise, n=20_000, dims=64):
    """Clusters of a few vectors, and a share of near copies of one vector."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n // 50, dims))[rng.integers(0, n // 50, n)] + 0.02 * rng.normal(size=(n, dims))
    hot = rng.random(n) < share
    x[hot] = x[0] + noise * rng.normal(size=(int(hot.sum()), dims))
    return x


def rank_recall(x, index, k=5, queries=400):
    """Share of true neighbours within the window by rank, ties as in the table's order."""
    n, unit = len(x), neighbours.unit_rows(x)
    asked = np.random.default_rng(5).choice(n, queries, replace=False)
    near = unit[asked] @ unit.T
    near[np.arange(queries), asked] = -2
    truth = np.argpartition(-near, k, axis=1)[:, :k]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array([[i] for i in range(n)]), pa.array(np.zeros(n, bool)), pa.array(list(x))], names=["rep", "ids", "asked", "v"]
    )
    found = np.zeros(truth.shape, bool)
    for points in neighbours._points(index)(iter([batch])):
        order = [c for c in ("key", "fine", "tie", "rep") if c in points.schema.names]
        ranks = np.empty(n, np.int64)
        ranks[np.lexsort([points.column(c).to_numpy() for c in reversed(order)])] = np.arange(n)
        found |= np.abs(ranks[truth] - ranks[asked][:, None]) <= index.window * n
    return found.mean()


@pytest.mark.parametrize("share", [0.12, 0.2])
def test_neighbours_recall_among_near_copies(share):
    x = hot_vectors(share, 1e-6)  # closer than a cell of the curves
    sample = x[np.random.default_rng(2).choice(len(x), 4096, replace=False)]
    assert rank_recall(x, neighbours.fit_index(sample, 5, neighbours.Settings())) >= 0.92


def test_hilbert_curve_visits_neighbouring_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def reference_alignment(passage, item):
    best, table = 0, [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, w in enumerate(item, 1):
        for j, x in enumerate(passage, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if w == x else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment():
    rng = random.Random(5)
    for _ in range(50):
        a, b = (np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 25))], np.uint64) for _ in range(2))
        score, equal, first, last = decontaminate.align(a, b)
        assert score == reference_alignment(a.tolist(), b.tolist())
        if score:
            assert reference_alignment(a[first : last + 1].tolist(), b.tolist()) == score and equal <= last - first + 1


@pytest.mark.parametrize("block_bytes", [8 << 20, 2000])
def test_decontamination(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rng = random.Random(9)
    items = [(i, sentence(rng, 40)) for i in range(30)] + [(50, None), (51, ""), (52, "too short"), (None, sentence(rng, 30)), (0, sentence(rng, 35))]
    rows = documents()
    planted = []
    for k, item in enumerate(items[:30]):
        text = item[1] if k % 3 == 0 else edited(rng, item[1], 0.1) if k % 3 == 1 else item[1].upper().replace(" ", " ,\n")
        planted.append((1000 + k, f"{sentence(rng, 50)} {text} {sentence(rng, 50)}", "en", "s", 0, "x"))
    got = decontaminate.find_contamination(
        frame(spark, rows + planted).withColumn("contamination", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert len(got) == len(rows) + len(planted)
    for r in got:
        hits = {h["item_id"] for h in r["contamination"]}
        assert hits == ({r["doc_id"] - 1000} if r["doc_id"] is not None and r["doc_id"] >= 1000 else set())
        for h in r["contamination"]:
            assert 0.5 <= h["score"] <= 1 and 45 <= h["first_word"] <= h["last_word"] <= 95
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(frame(spark), none).filter("size(contamination) > 0").count() == 0
    assert decontaminate.find_contamination(spark.createDataFrame([], SCHEMA), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_decontamination_finds_copies_with_regular_edits(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(48))) for i in range(4)] + [(9, " ".join(f"short{j}" for j in range(8)))]
    rows, want = [], {}
    for item, text in items:
        words = text.split()
        copies = {every: [f"new{j}" if j % every == every - 1 else w for j, w in enumerate(words)] for every in (4, 5, 6)}
        if item == 9:
            copies = {0: [*words[:4], "new", *words[5:]]}
        elif item % 2:
            copies[1] = words  # intact n-grams are not the rarest then
        for copy in copies.values():
            want[len(rows)] = item
            rows.append((len(rows), f"{sentence(rng, 30)} {' '.join(copy)} {sentence(rng, 30)}", "en", "s", 0, "x"))
    got = decontaminate.find_contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: [h["item_id"] for h in r["contamination"]] for r in got} == {d: [item] for d, item in want.items()}
    assert min(h["score"] for r in got for h in r["contamination"]) < 0.65


def test_decontamination_expands_shared_n_grams_in_parts(monkeypatch):
    items = decontaminate.Items([(1, "a a a a b c d e f"), (2, "b c d a a a a e f g")], 3)
    texts = [b"a a a a b c d e f " * 20, b"b c d a a a a e f g", b"a a a a a a a a", b""]
    whole = decontaminate.Matcher(items, decontaminate.Settings())(texts)
    monkeypatch.setattr(decontaminate, "PAIRS", 3)
    parts = decontaminate.Matcher(items, decontaminate.Settings())(texts)
    assert [[(h["item_id"], h["score"]) for h in x] for x in parts] == [[(h["item_id"], h["score"]) for h in x] for x in whole]
    assert (1, 1.0) in [(h["item_id"], h["score"]) for h in whole[0]] and whole[2:] == [[], []]
