"""Page bodies and comments (O-S4, O-S5, O-A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks concatenated at once; longer bodies are built from such pieces.
PIECE_BLOCKS = 4096

# How each block type is written.
PREFIXES = {"quote": "> ", "callout": "| "}
TITLED = ("child_page", "child_database")
LINKED = ("bookmark", "embed", "link_preview")
BARE_MEDIA = ("video", "audio", "pdf")
SILENT = ("table", "divider", "column_list", "column")
PLAIN = (
    "paragraph", "heading_1", "heading_2", "heading_3", "toggle", "bulleted_list_item", "numbered_list_item",
)


def _block_shape() -> T.StructType:
    text = T.StringType()
    rich = T.ArrayType(T.StructType([T.StructField("plain_text", text)]))

    def of(**members: T.DataType) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in members.items()])

    shapes = {kind: of(rich_text=rich) for kind in (*PLAIN, *PREFIXES)}
    shapes["to_do"] = of(rich_text=rich, checked=T.BooleanType())
    shapes["code"] = of(rich_text=rich, language=text)
    shapes["table_row"] = of(cells=T.ArrayType(rich))
    shapes.update({kind: of(title=text) for kind in TITLED})
    shapes.update({kind: of(url=text) for kind in LINKED})
    shapes["image"] = of(caption=rich)
    shapes["file"] = of(name=text)
    return of(type=text, **shapes)


BLOCK_SHAPE = _block_shape()


def block_text(block: Column) -> Column:
    """One block as plain text, by its type. A block holds the member its type names and
    no other, so the texts of several types can be read at once."""
    kind = block["type"]

    def rich(*types: str) -> Column:
        return F.coalesce(*[F.array_join(block[t]["rich_text"]["plain_text"], "") for t in types], F.lit(""))

    def tagged(body: Column) -> Column:
        return F.concat(F.lit("["), kind, F.lit(": "), F.coalesce(body, F.lit("")), F.lit("]"))

    caption = F.coalesce(F.array_join(block["image"]["caption"]["plain_text"], ""), F.lit(""))
    cells = F.transform(block["table_row"]["cells"], lambda cell: F.array_join(cell["plain_text"], ""))
    done = F.when(block["to_do"]["checked"], F.lit("[x] ")).otherwise(F.lit("[ ] "))
    language = F.coalesce(block["code"]["language"], F.lit(""))
    out = F.when(kind.isin(*PLAIN), rich(*PLAIN))
    for name, prefix in PREFIXES.items():
        out = out.when(kind == name, F.concat(F.lit(prefix), rich(name)))
    return (
        out.when(kind == "to_do", F.concat(done, rich("to_do")))
        .when(kind == "code", F.concat(F.lit("[code:"), language, F.lit("] "), rich("code")))
        .when(kind == "table_row", F.array_join(cells, " | "))
        .when(kind.isin(*TITLED), tagged(F.coalesce(*[block[t]["title"] for t in TITLED])))
        .when(kind.isin(*LINKED), tagged(F.coalesce(*[block[t]["url"] for t in LINKED])))
        .when(kind == "image", F.when(caption == "", F.lit("[image]")).otherwise(tagged(caption)))
        .when(kind.isin(*BARE_MEDIA), F.concat(F.lit("["), kind, F.lit("]")))
        .when(kind == "file", tagged(block["file"]["name"]))
        # Containers are written by their children; a divider has no text.
        .when(kind.isin(*SILENT), F.lit(None))
        .otherwise(F.lit("[unsupported]"))
    )


def content_text(blocks: DataFrame, page: str = "page_id", position: str = "position", raw: str = "raw") -> DataFrame:
    """O-S4: (page_id, content_text), the blocks of each page joined by newlines in order.

    A long body is joined in pieces of neighbouring blocks first, so the blocks of one
    page are spread over tasks and only finished pieces meet in one place.
    """
    rendered = (
        blocks.select(page, position, F.from_json(F.col(raw), BLOCK_SHAPE).alias("_block"))
        .select(page, position, block_text(F.col("_block")).alias("_text"))
        .where(F.col("_text").isNotNull())
    )

    def join_by(df: DataFrame, keys: list, order: str, text: str) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct(order, text)))
        return df.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda e: e[text]), "\n").alias(text))

    pieces = join_by(
        rendered.withColumn("_piece", F.floor(F.col(position) / PIECE_BLOCKS)), [page, "_piece"], position, "_text"
    )
    return join_by(pieces, [page], "_piece", "_text").withColumnRenamed("_text", "content_text")


def comment_rows(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """O-S5: landed ``{page_id, results: [comment]}`` documents to one row per comment."""
    shape = (
        "page_id string, results array<struct<id string,created_time string,last_edited_time string,"
        "rich_text array<struct<plain_text string>>>>"
    )
    return (
        documents.select(F.from_json(F.col(raw), shape).alias("_doc"))
        .select(F.col("_doc.page_id").alias("page_id"), F.explode("_doc.results").alias("_c"))
        .select(
            F.col("_c.id").alias("comment_id"),
            "page_id",
            F.col("_c.created_time").alias("created_time"),
            F.col("_c.last_edited_time").alias("last_edited_time"),
            F.array_join("_c.rich_text.plain_text", "").alias("text"),
        )
    )
