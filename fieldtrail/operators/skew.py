"""Keeping hot keys out of single tasks.

Three tools: ordered neighbours per key that split a hot key into chunks of its own
order, a salted lookup join, and a broadcast that is taken only below a checked size.

A key is hot when it holds more than ``max(HOT_MIN_ROWS, rows / HOT_MAX_KEYS)`` rows,
so there are never more than ``HOT_MAX_KEYS`` of them and never more than
``2 * HOT_MAX_KEYS`` cut points: that bound is what makes broadcasting them safe, no
matter how large the data is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.session import scratch_dir

HOT_MIN_ROWS = 1_000_000
HOT_MAX_KEYS = 20_000
#: Most chunks one key is cut into; a power of two.
HOT_MAX_PARTS = 4096
#: Largest row count that is broadcast, and the bound every size check uses.
BROADCAST_ROWS = 100_000
#: Largest text size of chunk edges that is broadcast.
EDGE_BYTES = 64 << 20
#: Salts for rows whose key is NULL: they join with nothing and may go anywhere.
NULL_SALTS = 4096


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """Keys worth splitting, with the number of parts. One pass over the key columns,
    combined map-side, so a hot key reaches the shuffle as one row per task."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    floor = float(HOT_MIN_ROWS if min_rows is None else min_rows)
    cutoff = counts.agg(F.greatest(F.lit(floor), F.sum("_n") / F.lit(HOT_MAX_KEYS))).scalar()
    return (
        counts.where(F.col("_n") > cutoff)
        .select(*keys, F.least(F.lit(HOT_MAX_PARTS), F.ceil(F.col("_n") / cutoff) + 1).cast("int").alias("_parts"))
    )


def _same_keys_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Joins by keys where NULL equals NULL, as in a group; keeps the left side's keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(F.broadcast(renamed), same, how).drop(*(f"_r_{k}" for k in keys))


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, read as often as
    needed, and still there when an executor is lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys_if_any(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """The hot keys, or None when a count over the key columns finds none."""
    hot = hot_keys(df, keys, min_rows)
    return None if hot.isEmpty() else _written(hot, "hot-keys")


def _cut_points(df: DataFrame, keys: Sequence[str], ordinate: str, hot: DataFrame) -> DataFrame:
    """(keys, _cuts): the ascending cut points of every hot key.

    Quantile sketches depend on the order they are merged in, so the cuts are computed
    once and written; every later use sees the same chunks.
    """
    shares = ",".join(str(i / HOT_MAX_PARTS) for i in range(1, HOT_MAX_PARTS))
    quantiles = (
        df.select(*keys, ordinate)
        .transform(lambda d: _same_keys_join(d, hot, keys, "inner"))
        .groupBy(*keys, "_parts")
        .agg(
            F.percentile_approx(
                ordinate, F.split(F.lit(shares), ",").cast("array<double>"), 10 * HOT_MAX_PARTS
            ).alias("_q")
        )
    )
    # Thin the fixed quantile grid to the parts this key needs.
    every = F.lit(HOT_MAX_PARTS) / F.col("_parts")
    cuts = quantiles.select(
        *keys,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("_parts") - 1),
                lambda i: F.element_at("_q", F.greatest(F.lit(1), (i * every).cast("int"))),
            )
        ).alias("_cuts"),
    )
    return _written(cuts, "cut-points")


def _with_chunk(df: DataFrame, keys: Sequence[str], ordinate: str, cuts: DataFrame) -> DataFrame:
    """Adds ``_chunk``: 0 for ordinary keys, the rank of the order range for hot ones."""
    # Binary search: how many cut points are not above the row's ordinate.
    steps = F.array(*[F.lit(HOT_MAX_PARTS >> s) for s in range(HOT_MAX_PARTS.bit_length())])
    rank = F.aggregate(
        steps,
        F.lit(0),
        lambda pos, step: F.when(
            F.get("_cuts", pos + step - F.lit(1)) <= F.col(ordinate), pos + step
        ).otherwise(pos),
    )
    return (
        _same_keys_join(df, cuts, keys, "left")
        .withColumn("_hot", F.col("_cuts").isNotNull())
        .withColumn("_chunk", F.when(F.col("_hot"), rank).otherwise(F.lit(0)))
        .drop("_cuts")
    )


#: Stands for "count the hot keys first".
COUNT = object()


def ordered_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Sequence[str] = (),
    following: Sequence[str] = (),
    running_sum: dict[str, str] | None = None,
    hot=COUNT,
    carried_forward: Sequence[str] = (),
) -> DataFrame:
    """``lag``, ``lead`` and running sums per key, exact also when one key is huge.

    Each column of ``carried_forward`` becomes its last value that is not NULL, up to the row itself.

    Adds ``_prev`` / ``_next``: structs of the named columns of the neighbouring row
    (NULL when there is none), ``_seq`` (1-based rank within the key) and one column
    per ``running_sum`` entry (name -> summed column). ``order[0]`` must be numeric,
    date or timestamp and the whole order must be unique within a key.

    Whether any key is hot is counted first, over the key columns alone. Without one
    this is a plain window per key. Otherwise hot keys are cut into chunks that follow
    the order: a window over (key, chunk) is then right everywhere but at chunk edges,
    and those come from one summary row per chunk. The input is then written once to the
    scratch folder and read from there. A caller with several passes over
    one table counts once (``hot_keys_if_any``) and hands the outcome on as ``hot``.
    """
    sums = running_sum or {}
    if hot is COUNT:
        hot = hot_keys_if_any(df, keys)
    split = hot is not None
    columns = df.columns
    if split:
        used = [*keys, *order, *previous, *following, *sums.values(), *carried_forward]
        df = _written(df, "ordered")
        chunked = _with_chunk(df, keys, order[0], _cut_points(df, keys, order[0], hot))
        slim = chunked.where("_hot").select(*dict.fromkeys(used), "_chunk")
    else:
        chunked = df
    part = Window.partitionBy(*keys, *(["_chunk"] if split else [])).orderBy(*order)
    upto = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    windowed = {"_seq": F.row_number().over(part).cast("long")}
    if previous:
        windowed["_prev"] = F.lag(F.struct(*previous)).over(part)
    if following:
        windowed["_next"] = F.lead(F.struct(*following)).over(part)
    for name, col in sums.items():
        windowed[name] = F.sum(col).over(upto)
    for name in carried_forward:
        windowed[name] = F.last(name, ignorenulls=True).over(upto)
    within = chunked.withColumns(windowed)
    if not split:
        return within

    # One summary row per chunk of a hot key, then what each chunk takes from the others.
    rank = F.struct(*order)
    summaries = [F.count(F.lit(1)).alias("_rows")]
    if previous:
        summaries.append(F.max_by(F.struct(*previous), rank).alias("_tail"))
    if following:
        summaries.append(F.min_by(F.struct(*following), rank).alias("_head"))
    summaries += [F.sum(col).alias(f"_total_{name}") for name, col in sums.items()]
    summaries += [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(f"_last_{c}") for c in carried_forward]
    edge = Window.partitionBy(*keys).orderBy("_chunk")
    before = edge.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum("_rows").over(before).alias("_rows_before")]
    if previous:
        carried.append(F.lag("_tail").over(edge).alias("_carry_prev"))
    if following:
        carried.append(F.lead("_head").over(edge).alias("_carry_next"))
    carried += [F.sum(f"_total_{name}").over(before).alias(f"_before_{name}") for name in sums]
    carried += [F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_kept_{c}") for c in carried_forward]
    edges = slim.groupBy(*keys, "_chunk").agg(*summaries).select(*keys, "_chunk", *carried)

    whole = {"_seq": F.col("_seq") + F.coalesce("_rows_before", F.lit(0))}
    if previous:
        whole["_prev"] = F.coalesce("_prev", "_carry_prev")
    if following:
        whole["_next"] = F.coalesce("_next", "_carry_next")
    for name in sums:
        # A total of only NULLs before this chunk leaves the running sum as it is.
        whole[name] = F.when(F.col(f"_before_{name}").isNull(), F.col(name)).otherwise(
            F.coalesce(F.col(name), F.lit(0)) + F.col(f"_before_{name}")
        )
    for name in carried_forward:
        whole[name] = F.coalesce(name, f"_kept_{name}")
    return (
        _edges_join(within, edges, keys)
        .withColumns(whole)
        .select(*dict.fromkeys([*columns, *windowed]))
    )


def _edges_join(within: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chunk rows with what their chunk takes over. The edges hold values of the caller, so
    they are broadcast only when counted small in bytes; else both sides are spread by chunk."""
    edges = _written(edges, "edges")
    size = edges.agg(F.sum(F.length(F.to_json(F.struct(*edges.columns)))).alias("n")).first()["n"] or 0
    if size <= EDGE_BYTES:
        return _same_keys_join(within, edges, [*keys, "_chunk"], "left")
    renamed = edges.withColumnsRenamed({k: f"_r_{k}" for k in (*keys, "_chunk")})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in (*keys, "_chunk")]
    return within.join(renamed, same, "left").drop(*(f"_r_{k}" for k in (*keys, "_chunk")))


def salted_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    hot=COUNT,
) -> DataFrame:
    """Equi-join of many rows per key with at most one row per key.

    A hot key's rows are spread over salts by a hash of ``spread_by`` and its single
    partner row is repeated once per salt, so no task holds the whole key. Rows with a NULL
    in their key have no partner and are spread over salts of their own.
    """
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    spread = F.xxhash64(*spread_by)
    if hot is COUNT:
        hot = hot_keys_if_any(many.where(~missing), keys)
    if hot is None:
        salt = F.when(missing, F.pmod(spread, F.lit(NULL_SALTS)).cast("int") + 1).otherwise(0)
        # Always 0, but no literal: one would be folded, and the salt with it.
        left, right = many.withColumn("_salt", salt), one.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"))
        return left.join(right, [*keys, "_salt"], how).drop("_salt")
    hot = F.broadcast(hot)
    salt = F.when(missing, F.pmod(spread, F.lit(NULL_SALTS)).cast("int") + 1).when(F.col("_parts").isNull(), F.lit(0)).otherwise(
        F.pmod(spread, F.col("_parts").cast("long")).cast("int")
    )
    left = many.join(hot, list(keys), "left").withColumn("_salt", salt).drop("_parts")
    right = (
        one.join(hot, list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Counts no further than the bound."""
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Broadcast ``one`` if it is counted small, else join with salts. A caller joining
    the same table twice counts once and hands the outcome on as ``small``."""
    if small is None:
        small = fits_broadcast(one, max_rows)
    if small:
        return many.join(F.broadcast(one), list(keys), how)
    return salted_join(many, one, keys, spread_by, how)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], reads: Sequence[Callable[[Column], Column]] = ()
) -> DataFrame:
    """One row per key, the highest by ``order``, each read by its entry in ``reads`` if given; the
    other columns break ties, so the outcome does not depend on row order. An aggregation, so copies of a hot key are
    reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranks = [read(F.col(c)).alias(f"_rank{i}") for i, (c, read) in enumerate(zip(order, reads))]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*ranks, *[F.col(c) for c in (*order, *rest)])).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
