"""Language identification by compression.

For each language a raw-content dictionary is cut from labelled texts. A text is compressed once
with each; the language whose dictionary makes it smallest wins. Texts are reduced to lower-case
letters and single spaces first, so that marks and digits of any language weigh nothing.

The dictionaries come from a bounded sample: training texts are cut into pieces of up to an eighth of
``dictionary_bytes`` signs, and per language the ``sample_docs`` distinct pieces with the smallest hash
fill it (both are parameters); every other step covers whole texts of all rows. The dictionaries, languages times ``dictionary_bytes``, are all
that reaches the driver and the workers.

The margin is the share of bytes that the winner saves over the second best. ``score`` is
``margin / (margin + scale)``, 0 to 1; below ``min_margin`` the prediction stands as the best
guess but ``rejected`` is true. Equal sizes go to the first language by name, with score 0.

Cases: NULL text or one without a letter is ``und`` with score 0, rejected; without any training
row every text is ``und``; an empty table gives no rows; repeated rows are judged alike; ids may
be NULL or repeat; other columns are never read and do not clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, workers_can_import

UNKNOWN = "und"
_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters_only(text: str) -> str:
    """Letters with their marks and single spaces; nothing if there are marks only."""
    return _LETTERS.sub(" ", text.lower()).strip() if _LETTER.search(text) else ""


def dictionaries(train: DataFrame, sample_docs: int, dictionary_bytes: int) -> dict[str, bytes]:
    """Language -> raw content, from rows with text and lang."""
    size = max(1, dictionary_bytes // 8)
    last = F.floor((F.length("text") - 1) / size).cast("int")
    pieces = (
        train.filter("lang IS NOT NULL AND text != '' AND lang != 'und'")
        .select("lang", "text", F.explode(F.sequence(F.lit(0), last)).alias("i"))
        .select("lang", F.col("text").substr(F.col("i") * size + 1, F.lit(size)).alias("text"))
        .withColumn("h", F.xxhash64("text"))
    )
    # only hashes are ranked; repeated pieces are one before that
    order = Window.partitionBy("lang").orderBy("h")
    ranked = pieces.select("lang", "h").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_docs)
    sample = pieces.join(F.broadcast(ranked), ["lang", "h"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    found: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():  # languages x sample_docs rows of bounded length
        found.setdefault(row["lang"], []).append((row["n"], letters_only(row["text"])))
    out = {}
    for lang, texts in sorted(found.items()):
        content = " ".join(t for _, t in sorted(texts) if t).encode()
        if content:
            out[lang] = content[:dictionary_bytes]
    return out


class Classifier:
    def __init__(self, contents: dict[str, bytes], level: int, min_margin: float, scale: float):
        import zstandard

        self.langs, self.min_margin, self.scale = sorted(contents), min_margin, scale
        params = zstandard.ZstdCompressionParameters.from_level(
            level, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self.compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        data = letters_only(text or "").encode()
        if not data or not self.langs:
            return UNKNOWN, 0.0, True
        sizes = sorted((len(c.compress(data)), lang) for c, lang in zip(self.compressors, self.langs))
        best = sizes[0]
        second = sizes[1][0] if len(sizes) > 1 else len(data)
        margin = max(0.0, (second - best[0]) / max(second, 1))
        return best[1], margin / (margin + self.scale) if margin else 0.0, margin < self.min_margin


def identify(
    docs: DataFrame, train: DataFrame, keep: dict[str, Column], sample_docs: int = 300,
    dictionary_bytes: int = 110_000, level: int = 9, min_margin: float = 0.01, scale: float = 0.05,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred, score and rejected."""
    workers_can_import(docs.sparkSession)
    contents = dictionaries(train, sample_docs, dictionary_bytes)
    kept = docs.select(F.col("text").alias("__text"), *(c.alias(name) for name, c in keep.items()))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(contents, level, min_margin, scale)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            out = [judge(t) for t in texts]
            lang, score, rejected = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in names]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*names, "lang_pred", "score", "rejected"],
            )

    return kept.mapInArrow(run, f"{kinds(kept.drop('__text'))}, lang_pred string, score double, rejected boolean")
