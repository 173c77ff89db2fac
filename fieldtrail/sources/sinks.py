"""File exports and the gated publish (O-K4, O-K5, O-K6, O-K7, O-S9)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions.canon import canonical_text
from fieldtrail.sources.tables import Tables

log = logging.getLogger(__name__)
#: The kind of table that a publish of marts owns.
MART = "mart"


class QualityError(RuntimeError):
    """Raised before anything is published when a check fails."""


def csv_line(df: DataFrame) -> Column:
    """A row as one CSV line: canonical text per value, nothing for NULL, quotes only
    where a value holds a comma, a quote or a line end."""

    def cell(field: T.StructField) -> Column:
        text = F.coalesce(canonical_text(F.col(field.name), field.dataType), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[,"\r\n]'), quoted).otherwise(text)

    return F.concat_ws(",", *[cell(f) for f in df.schema])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> bool:
    """O-K4: UTF-8 with a header per file and CRLF line ends. False, and nothing written,
    for an empty table. Files are written in parallel unless a single one is asked for.

    Lines are built as text: the CSV writer would turn line ends inside values into its
    own line separator.
    """
    if df.isEmpty():
        return False
    out = df.coalesce(1) if single_file else df
    header = ",".join(f'"{c}"' if "," in c or '"' in c else c for c in df.columns)
    first_of_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = csv_line(df)
    lines = out.select(F.when(first_of_file, F.concat(F.lit(header + "\r\n"), line)).otherwise(line).alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\r\n").option("encoding", "UTF-8").text(path)
    return True


def export_csv(store: Tables, table: str, csv_dir: str, single_file: bool = False) -> dict[str, bool]:
    """The pages, changes and comments of one database; missing tables are skipped."""
    known = set(store.tables())
    names = [f"{table}_{suffix}" for suffix in ("pages", "changes", "comments")]
    return {n: write_csv(store.read(n), f"{csv_dir}/{n}.csv", single_file) for n in names if n in known}


def mart_tables(spark: SparkSession, database: str) -> list[str]:
    """O-S9: the tables of a mart schema."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def export_mart_schema(spark: SparkSession, database: str, out_dir: str) -> dict[str, bool]:
    """O-S9, O-K5: every table of a mart schema; a schema without any is an error."""
    names = mart_tables(spark, database)
    if not names:
        raise QualityError(f"no mart in {database!r}")
    return export_parquet({n: spark.table(f"`{database}`.`{n}`") for n in names}, out_dir)


def export_parquet(marts: Mapping[str, DataFrame], out_dir: str) -> dict[str, bool]:
    """O-K5: every mart to ``{out_dir}/{name}.parquet``; one failing table is logged and
    leaves the others running."""
    done = {}
    for name, df in marts.items():
        try:
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}.parquet")
            done[name] = True
        except Exception as e:  # a bad mart must not keep the others back
            log.warning("%s: skipped, %s", name, e)
            done[name] = False
    return done


def publish_marts(
    store: Tables, marts: Mapping[str, DataFrame], checks: Iterable[DataFrame] = ()
) -> int:
    """O-K6, O-K7: run the checks, then replace the whole mart set in one commit. Marts
    that are no longer built vanish with the version that still held them; other tables of
    the store are left alone."""
    failed = [row for check in checks for row in check.where(F.col("failures") > 0).collect()]
    if failed:
        raise QualityError("; ".join(f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failed))
    taken = [name for name in marts if store.exists(name) and name not in store.tables(MART)]
    if taken:
        raise ValueError(f"{taken} are no marts")
    stale = [name for name in store.tables(MART) if name not in marts]
    return store.publish(replace=marts, drop=stale, kind=MART)
