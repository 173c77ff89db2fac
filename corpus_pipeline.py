"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all that
the stage before kept. All but the last return the columns of documents. ``run`` writes each
stage's rows to the shared folder and reads them for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from fieldtrail.llm.common import read_table, stored
from fieldtrail.llm.queries import TOXICITY_CATEGORIES, tokenizer_path, toxicity_labels
from fieldtrail.session import configure

#: Some stages cannot be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain finds toxic; NULL and empty texts stay."""
    configure(spark)
    chain = toxicity.train(docs, toxicity_labels(spark, sf_dir), TOXICITY_CATEGORIES)
    return toxicity.score(docs, chain, "toxic").filter("NOT is_toxic").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of three-line windows; a document that loses all its lines goes,
    one that was NULL or empty before stays."""
    configure(spark)
    cut = line_dedup.dedup_lines(docs).filter("n_removed < n_lines OR n_lines = 0")
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long")
    return cut.withColumns(changed).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of five-word shingles: the one with the smallest id.

    Rows alike in id and text are one document. Documents without an id come after those with one; where
    ids do not tell the documents of a group apart, the one with the smallest hash of its text stays.
    """
    configure(spark)
    groups = stored(jaccard_join.link_documents(docs, n=5, percent=80), "groups")
    key = ["doc_id", "text_key"]
    if groups.filter("n_shingles > 0").groupBy(*key).count().filter("count > 1").limit(1).count():
        filled = F.col("text").isNotNull() & (F.col("text") != "")
        docs = docs.filter(filled).dropDuplicates(["doc_id", "text"]).union(docs.filter(~F.coalesce(filled, F.lit(False))))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("keeper"))
    gone = groups.filter(~stays).select(*key).distinct()
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    configure(spark)
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("contamination") == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 ids, one row per piece of a document."""
    configure(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
