"""Line dedup by overlapping windows of three lines.

Every run of ``size`` consecutive lines of a text is a window. A window that occurs more than once
among all texts keeps its first occurrence, by (doc_id, text, line); the lines under a later one
are covered, overlapping windows merge, and covered lines go. Windows are judged on the input, not
on what is left. Lines are compared without white space at their ends; blank lines neither count
nor break a window, and those inside a covered window go with it.

Only hashes of windows are shuffled, and texts once, to meet their cuts. First occurrences are a
partial aggregate, so a window held by a third of all rows is one row per map task; they are
written before windows are joined with them, so that Spark can split a hot window in that join.

Cases: NULL or empty text and texts of fewer than ``size`` lines stay as they are; rows alike in id
and text are one document, cut alike and no repeat of each other; NULL ids come first; an empty
table gives no rows; other columns stay, and the result's ``kept_text``, ``n_lines`` and
``n_removed`` replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored
from fieldtrail.llm.spans import merged_spans

_TRIM = r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$"


def _lines(text: Column) -> Column:
    """(place among all lines, line) of the lines that are not blank."""
    lines = F.transform(
        F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), F.regexp_replace(x, _TRIM, "").alias("x"))
    )
    return F.filter(lines, lambda s: s["x"] != "")


def _windows(size: int) -> Column:
    """(first line, last line, two hashes) of each window."""
    lines = F.col("lines")
    starts = F.when(F.size(lines) >= size, F.sequence(F.lit(1), F.size(lines) - (size - 1)))

    def window(at: Column) -> Column:
        part = [F.element_at(lines, at + j) for j in range(size)]
        texts = [p["x"] for p in part]
        return F.struct(
            part[0]["i"].alias("a"), part[-1]["i"].alias("b"),
            F.xxhash64(*texts).alias("h1"), F.hash(*texts, *map(F.length, texts)).alias("h2"),
        )

    return F.transform(starts, window)


def _kept(text: Column, spans: Column) -> Column:
    """``text`` without the lines of ``spans``, sorted and disjoint half-open ranges."""
    lines = F.split(text, "\n", -1)
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["b"]))
    ends = F.concat(F.transform(spans, lambda s: s["a"]), F.array(F.size(lines)))
    pieces = F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(pieces), "\n")


def _key() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", F.length("text")).alias("k2")]


def covered_spans(docs: DataFrame, size: int) -> DataFrame:
    """Per document key the maximal runs of covered lines, sorted."""
    windows = (
        docs.select("doc_id", *_key(), _lines(F.col("text")).alias("lines"))
        .select("doc_id", "k1", "k2", F.explode(_windows(size)).alias("w"))
        .select("doc_id", "k1", "k2", "w.*")
    )
    place = F.struct("doc_id", "k1", "k2", "a", "b")
    repeated = stored(
        windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"),
        "windows",
    )
    covered = windows.join(repeated, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first"))).select("k1", "k2", "a", F.expr("b + 1").alias("b"))
    return merged_spans(covered, ["k1", "k2"])


def dedup_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """``docs`` with kept_text, n_lines (of the input) and n_removed."""
    docs = docs.drop("kept_text", "n_lines", "n_removed")
    spans = covered_spans(docs.select("doc_id", "text"), size).toDF("__s1", "__s2", "__spans")
    keys = [F.col("__k1") == F.col("__s1"), F.col("__k2") == F.col("__s2")]
    k1, k2 = _key()
    joined = docs.withColumns({"__k1": k1, "__k2": k2}).join(spans, keys, "left")
    text, cut = F.col("text"), F.col("__spans")
    return joined.select(
        *docs.columns,
        F.when(cut.isNull(), text).otherwise(_kept(text, cut)).alias("kept_text"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
        F.when(cut.isNull(), 0)
        .otherwise(F.aggregate(cut, F.lit(0), lambda n, s: n + s["b"] - s["a"])).cast("long").alias("n_removed"),
    )
