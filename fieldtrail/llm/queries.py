"""The operators bound to the test tables, with SQL where it can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.llm import (
    decontaminate, jaccard_join, language_id, license_scan, line_dedup, neighbours, packing, periodic_runs, spelling_variants,
    suffix_dedup, surrogates, toxicity, url_filters,
)
from fieldtrail.llm.common import read_table
from fieldtrail.llm.url_filters import place_rule, word_rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from fieldtrail.session import configure

            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [
    place_rule("allow", "org/"), place_rule("block", "example.org/es/"), place_rule("block", "example.org/en/1"),
    place_rule("allow", "com/fr/"), place_rule("block", "com/de/"),
    *(word_rule("block", word) for word in url_filters.DEFAULT_WORDS),
]

_OP2_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts),
judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM urls)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(lower(host || path), '(^|[^0-9a-z])(adult|casino|gambling|porn|warez|xxx)([^0-9a-z]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM judged
"""


@query("op2_url_filters", _OP2_SQL)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.filter_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT doc_id, i, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x FROM lines
  WHERE trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
windows AS (
  SELECT doc_id, i AS a, lead(i, 2) OVER w AS b, x AS x1, lead(x) OVER w AS x2, lead(x, 2) OVER w AS x3
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT doc_id, a, b, row_number() OVER (PARTITION BY x1, x2, x3 ORDER BY doc_id, a) AS n FROM windows WHERE b IS NOT NULL),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ranked WHERE n > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.i) FILTER (WHERE c.i IS NULL) AS kept_text,
         count(*) AS n_lines, count(c.i) AS n_removed
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept_text, '') END AS kept_text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op6_line_dedup", _OP6_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later copies of three-line windows."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).drop("text")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; every fifth document, by its id's checksum, is held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    train = docs.filter(remainder != 0).select("text", "lang")
    return language_id.identify(
        docs, train, {"doc_id": F.col("doc_id"), "held_out": F.coalesce(remainder == 0, F.lit(False))}
    )


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2,048 ids; ids as their checksum."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's categories, mild to severe: low quality, toxic, both."""
    labels = read_table(spark, sf_dir, "labels")
    low = (1 - F.col("quality")).alias("low_quality")
    return labels.select("doc_id", low, "toxic", ((1 - F.col("quality")) * F.col("toxic")).alias("severe"))


TOXICITY_CATEGORIES = ["low_quality", "toxic", "severe"]


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probabilities along the chain, and whether it is toxic."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, toxicity_labels(spark, sf_dir), TOXICITY_CATEGORIES)
    return toxicity.score(docs, chain, "toxic").drop("text")


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) that align, with their score and the words they span."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("contamination").alias("hit")).select("doc_id", "hit.*")


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("id") % 50 == 0, 5)


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of 90 % of three-word shingles."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.link_documents(docs, n=3, percent=90).drop("text_key", "keeper")


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without the bytes under 200-byte strings that also start elsewhere."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.dedup(docs, length=200, keep="none")
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: The key that binds entities to replacements; whoever runs this on real data brings their own.
SURROGATE_KEY = b"fieldtrail test key"


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with its personal data replaced."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = surrogates.replace_entities(docs, SURROGATE_KEY)
    return found.select("doc_id", "clean_text", F.size("entities").alias("n_entities"), "entities")


def drop_sign(doc_id: int | None, run: str) -> str:
    """Every 31st (document, run), by checksum, loses a code point."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 31 == 0 else run


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least seven code points that occurs twice, its near words, form and root."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = spelling_variants.group_variants(docs, min_length=7, min_count=2, ratio=10, damage=drop_sign)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence phrases and notices."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs).drop("text")
    base = F.filter("matches", lambda m: m["template"] < len(license_scan.BASE))

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    starts = F.transform(base, lambda m: m["word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def repeat_block(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In every tenth document, by checksum, the words from one on repeat a block."""
    h, n = 0 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, the longest of them, and what is left without repeats."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, min_length=6, exponent=4, rewrite=repeat_block)
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"), (-best["l"]).alias("length"),
        best["p"].alias("period"), F.floor(-best["l"] * 1000 / best["p"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
