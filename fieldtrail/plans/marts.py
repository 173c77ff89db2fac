"""Interval tables, facts and dimensions built from pages and their history (O-M1 to O-M9, O-M12).

``hot`` is the outcome of ``skew.hot_keys_if_any`` over ``page_id`` of the base table: a key that is
not hot there is in nothing derived from it, so one count serves all marts of a table.

Histories are staged first: ``valid_from`` and ``detected_at`` are timestamps here, since
text spellings of one moment differ and would sort wrongly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.functions.dates import to_date
from fieldtrail.operators import skew

_STEPS = {"month": "interval 1 month", "year": "interval 1 year", "quarter": "interval 3 month", "week": "interval 7 day"}
CHANGE_ORDER = ("valid_from", "detected_at", "id")


def status_history(
    changes: DataFrame, field: str = "status", order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT
) -> DataFrame:
    """O-M1: one row per page and value, valid in [valid_from, valid_to); the last interval
    of a page is open (NULL)."""
    values = changes.where(F.col("field") == field).select("page_id", F.col("new_value").alias("status"), *order)
    paired = skew.ordered_neighbours(values, ["page_id"], order, following=[order[0]], hot=hot)
    return paired.select(
        "page_id",
        "status",
        F.col(order[0]).alias("valid_from"),
        F.col(f"_next.{order[0]}").alias("valid_to"),
        F.col("_seq").alias("interval_no"),
    )


def advance_history(open_intervals: DataFrame, records: DataFrame, order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT) -> DataFrame:
    """O-M1 for the records of one run: the intervals they close or open, as ``status_history`` has them.

    ``open_intervals`` are the stored ones with valid_to NULL. Closed rows of the result are appended to the
    closed intervals, open ones replace the open interval of their page (``still_open``). Only
    the new records and the open intervals are read, never the closed ones.

    ``records`` (page_id, status, ``order``) must come after the stored ones of their page;
    ``late_pages`` names the others, which need ``status_history`` anew.
    """
    ranks = {c: f"_o{i}" for i, c in enumerate(order)}
    kinds = dict(records.dtypes)
    new = records.select("page_id", "status", F.lit(1).alias("_new"), F.lit(None).cast("long").alias("_base"), *[F.col(c).alias(r) for c, r in ranks.items()])
    touched = open_intervals.join(records.select("page_id").distinct(), "page_id", "left_semi")
    first = F.col("valid_from").cast(kinds[order[0]])
    old = touched.select(
        "page_id", "status", F.lit(0).alias("_new"), F.col("interval_no").alias("_base"),
        *[(first if c == order[0] else F.lit(None).cast(kinds[c])).alias(r) for c, r in ranks.items()],
    )
    at = ranks[order[0]]
    paired = skew.ordered_neighbours(
        old.unionByName(new), ["page_id"], [at, "_new", *list(ranks.values())[1:]], following=[at], hot=hot, carried_forward=["_base"]
    )
    return paired.select(
        "page_id", "status", F.col(at).alias("valid_from"), F.col(f"_next.{at}").alias("valid_to"),
        (F.col("_seq") + F.coalesce(F.col("_base") - 1, F.lit(0))).alias("interval_no"),
    )


def still_open(open_intervals: DataFrame, advanced: DataFrame) -> DataFrame:
    """The open intervals after a run: its own, and those of pages it did not touch."""
    mine = advanced.where("valid_to IS NULL")
    return open_intervals.join(mine.select("page_id"), "page_id", "left_anti").unionByName(mine)


def late_pages(open_intervals: DataFrame, records: DataFrame, order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """Pages with a record from before their open interval."""
    oldest = records.groupBy("page_id").agg(F.min(order[0]).alias("_oldest"))
    return oldest.join(open_intervals, "page_id").where(F.col("_oldest") < F.col("valid_from")).select("page_id")


def advance_open_volume(moves: DataFrame, open_intervals: DataFrame, records: DataFrame, open_statuses: Sequence[str], order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT) -> DataFrame:
    """O-M5 for the records of one run: (day, delta) of stored ``moves`` with theirs added. A page's first
    record moves against the status of its open interval. ``open_volume`` gives the totals."""
    flags = records.select("page_id", *order, F.coalesce(F.col("status").isin(*open_statuses), F.lit(False)).cast("int").alias("is_open"))
    paired = skew.ordered_neighbours(flags, ["page_id"], order, previous=["is_open"], hot=hot)
    inside = paired.select(F.to_date(order[0]).alias("day"), (F.col("is_open") - F.coalesce("_prev.is_open", F.lit(0))).cast("long").alias("delta"))
    # what a page stood at before its first record: one row per touched page
    firsts = records.groupBy("page_id").agg(F.min(order[0]).alias("_first"))
    was_open = open_intervals.where(F.col("status").isin(*open_statuses)).select("page_id")
    before = firsts.join(was_open, "page_id", "left_semi").select(F.to_date("_first").alias("day"), F.lit(-1).cast("long").alias("delta"))
    return moves.unionByName(inside).unionByName(before).groupBy("day").agg(F.sum("delta").alias("delta"))


def open_volume(moves: DataFrame) -> DataFrame:
    """O-M5 from its daily moves."""
    return _running_by_day(moves)


def bucket_of(status: Column, buckets: Mapping[str, str], default: str = "other") -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    return F.coalesce(lookup[status], F.lit(default))


def option_buckets(options: DataFrame) -> DataFrame:
    """(status, bucket) from the option registry, by the group of each option name."""
    return options.groupBy(F.col("option_name").alias("status")).agg(
        F.min_by("option_group", "option_id").alias("bucket")
    )


def active_days(history: DataFrame, bucket: Column, as_of: Column) -> DataFrame:
    """O-M2: calendar days per page and status bucket up to ``as_of``: intervals that end later
    or are open count up to it, those that start later not at all. Day counts are differences
    of dates, so no day is ever a row."""
    days = F.datediff(F.least(F.coalesce("valid_to", as_of), as_of), F.col("valid_from"))
    return history.where(F.col("valid_from") <= as_of).groupBy("page_id", bucket.alias("bucket")).agg(F.sum(days).alias("active_days"))


def active_days_by_period(history: DataFrame, bucket: Column, as_of: Column, period: str = "month") -> DataFrame:
    """O-M2 per calendar period: each interval meets the periods it overlaps and is clipped at their
    ends, so an interval is a row per period at most and no day ever one. Sums over the periods of a page
    and bucket are those of ``active_days``; periods without a whole day are left out."""
    step = F.expr(_STEPS[period])
    spans = history.where(F.col("valid_from") <= as_of).select(
        "page_id", bucket.alias("bucket"), F.to_date("valid_from").alias("_from"),
        F.to_date(F.least(F.coalesce("valid_to", as_of), as_of)).alias("_to"),
    )
    periods = F.sequence(F.trunc("_from", period), F.trunc(F.date_sub("_to", 1), period), step)
    binned = spans.where(F.col("_to") > F.col("_from")).select("page_id", "bucket", "_from", "_to", F.explode(periods).alias("period"))
    days = F.datediff(F.least("_to", (F.col("period") + step).cast("date")), F.greatest("_from", "period"))
    return binned.groupBy("page_id", "bucket", "period").agg(F.sum(days).alias("active_days"))


def active_days_by_group(history: DataFrame, buckets: DataFrame, as_of: Column) -> DataFrame:
    """O-M2 with the buckets of ``option_buckets``."""
    joined = skew.lookup_join(history, buckets, ["status"], ["page_id", "valid_from"])
    return active_days(joined, F.coalesce("bucket", F.lit("other")), as_of)


def recurring_completions(
    tasks: DataFrame, relation: str, completed_on: str, period: str = "month"
) -> DataFrame:
    """O-M3: completions per related definition and period. The relation is id text
    joined by commas; NULL relations and unfinished tasks have no completions."""
    return (
        tasks.where(F.col(completed_on).isNotNull())
        .select(
            F.explode(F.split(F.col(relation), r",\s*")).alias("definition_id"),
            F.trunc(F.col(completed_on).cast("date"), period).alias("period"),
        )
        .groupBy("definition_id", "period")
        .agg(F.count(F.lit(1)).alias("completions"))
    )


def recurring_adherence(
    completions: DataFrame, definitions: DataFrame, expected: str, created: str, as_of: Column, period: str = "month"
) -> DataFrame:
    """O-M3: completed over expected, per definition and every period from its creation (or a completion
    before that) to the one of ``as_of``; a period without completion counts 0, also where
    there never was one. NULL where nothing is expected. Without a known creation the first
    completion opens the axis, and failing that the period of ``as_of``; definitions created later are left out.
    Completions are already counted per definition, so a popular one is a few rows by now."""
    step = F.expr(_STEPS[period])
    first = completions.groupBy("definition_id").agg(F.min("period").alias("_done"))
    last = F.trunc(as_of.cast("date"), period)
    d = definitions.select(
        F.col("page_id").alias("definition_id"), F.col(expected).alias("expected"), F.trunc(F.col(created).cast("date"), period).alias("_made")
    )
    since = d.join(first, "definition_id", "left").withColumn("_from", F.coalesce(F.least("_made", "_done"), last)).where(F.col("_from") <= last)
    axis = since.select("definition_id", "expected", F.explode(F.sequence("_from", last, step)).alias("period"))
    done = F.coalesce("completions", F.lit(0))
    return axis.join(completions, ["definition_id", "period"], "left").select(
        "definition_id", "period", done.alias("completions"), "expected",
        F.try_divide(done, F.col("expected")).alias("adherence"),
    )


def status_at(history: DataFrame, moments: DataFrame, moment: str, hot=skew.COUNT) -> DataFrame:
    """As-of lookup: the status of each page just before ``moment`` (one row per page in
    ``moments``); pages without a status by then are missing."""
    at = F.col(moment)
    inside = (F.col("valid_from") < at) & (F.col("valid_to").isNull() | (F.col("valid_to") >= at))
    # A closed interval is dropped by its start alone only after the join: the moment is
    # per page. Only the three interval columns and the moment travel.
    joined = skew.salted_join(
        history.select("page_id", "status", "valid_from", "valid_to"),
        moments.select("page_id", moment),
        ["page_id"],
        ["valid_from"],
        "inner",
        hot,
    )
    return joined.where(inside).select("page_id", "status")


def tasks_closed(
    tasks: DataFrame, history: DataFrame, dimensions: Sequence[str] = (), hot=skew.COUNT
) -> DataFrame:
    """O-M4: one row per closed task with the status it had at the end of the closing day."""
    closed = tasks.where(F.col("closed_date_start").isNotNull())
    history_kind = dict(history.dtypes)["valid_from"]
    moments = closed.select("page_id", F.date_add("closed_date_start", 1).cast(history_kind).alias("_after"))
    at_close = status_at(history, moments, "_after", hot).withColumnRenamed("status", "status_at_close")
    return closed.join(at_close, "page_id", "left").select(
        "page_id",
        F.col("created_time").alias("created_at"),
        F.col("closed_date_start").alias("closed_at"),
        "status_at_close",
        *dimensions,
    )


def _running_by_day(deltas: DataFrame, last: Column | None = None) -> DataFrame:
    """Daily deltas to a running total on every day from the first to ``last`` (or the last
    with a delta). After the daily sums there is one row per calendar day, so the only
    unpartitioned window is over days; days without a delta repeat the total before them."""
    daily = deltas.groupBy("day").agg(F.sum("delta").alias("delta"))
    days = Window.orderBy("day")
    running = F.sum("delta").over(days.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = daily.select("day", running.alias("open_tasks"), F.date_sub(F.lead("day").over(days), 1).alias("_until"))
    if last is not None:
        totals = totals.where(F.col("day") <= last).withColumn("_until", F.least(F.coalesce("_until", last), last))
    return totals.select(F.explode(F.sequence("day", F.coalesce("_until", "day"))).alias("day"), "open_tasks")


def open_volume_daily(
    changes: DataFrame, open_statuses: Sequence[str], field: str = "status", order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT
) -> DataFrame:
    """O-M5: tasks open at the end of each day. Every record moves the count by the
    difference to the record before; days sum the moves, and a running sum the days."""
    is_open = F.col("new_value").isin(*open_statuses).cast("int")
    flags = changes.where(F.col("field") == field).select(
        "page_id", *order, F.coalesce(is_open, F.lit(0)).alias("is_open")
    )
    paired = skew.ordered_neighbours(flags, ["page_id"], order, previous=["is_open"], hot=hot)
    deltas = paired.select(
        F.to_date(order[0]).alias("day"),
        (F.col("is_open") - F.coalesce("_prev.is_open", F.lit(0))).cast("long").alias("delta"),
    )
    return _running_by_day(deltas)


def open_volume_touched(
    history: DataFrame, open_statuses: Sequence[str], as_of_day: Column, hot=skew.COUNT
) -> DataFrame:
    """O-M5, other reading: tasks open at any time of each day up to ``as_of_day``.

    The open intervals of a page follow each other, so each adds the days from its start,
    or from the day after the previous one's last, to its own last day: two moves per
    interval instead of one row per day.
    """
    microsecond = F.expr("interval 1 microsecond")
    spans = (
        history.where(F.col("status").isin(*open_statuses))
        .where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
        .select(
            "page_id",
            "valid_from",
            "interval_no",
            F.to_date("valid_from").alias("first_day"),
            F.coalesce(F.to_date(F.col("valid_to") - microsecond), as_of_day).alias("last_day"),
        )
    )
    paired = skew.ordered_neighbours(spans, ["page_id"], ["valid_from", "interval_no"], previous=["last_day"], hot=hot)
    start = F.greatest("first_day", F.date_add("_prev.last_day", 1))
    moves = paired.withColumn("start", start).where(F.col("start") <= F.col("last_day")).select(
        F.inline(
            F.array(
                F.struct(F.col("start").alias("day"), F.lit(1).cast("long").alias("delta")),
                F.struct(F.date_add("last_day", 1).alias("day"), F.lit(-1).cast("long").alias("delta")),
            )
        )
    )
    return _running_by_day(moves, as_of_day)


def mttr(closed: DataFrame, dimensions: Sequence[str], resolution_days: Column) -> DataFrame:
    """O-M6: mean days to resolution for every prefix of the dimensions (rollup).
    ``level`` is the number of dimensions summed away."""
    grouped = closed.withColumn("_days", resolution_days).rollup(*dimensions)
    bits = F.grouping_id()
    return grouped.agg(
        F.count("_days").alias("closed_tasks"),
        F.avg("_days").alias("mean_days"),
        F.bit_count(bits).cast("int").alias("level"),
    )


def due_date_drift(
    changes: DataFrame, field: str = "due_date_start", order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT
) -> DataFrame:
    """O-M7: one row per later change of the due date, with its shift in days, its number
    and the total shift of the page so far. First sightings are no change."""
    later = changes.where((F.col("field") == field) & (F.col("valid_from") == F.col("detected_at")))
    old, new = (to_date(F.col(c)) for c in ("old_value", "new_value"))
    moved = later.select(
        "page_id", *order, old.alias("old_due"), new.alias("new_due"), F.datediff(new, old).cast("long").alias("shift_days")
    )
    counted = skew.ordered_neighbours(moved, ["page_id"], order, running_sum={"total_shift_days": "shift_days"}, hot=hot)
    return counted.select(
        "page_id",
        F.col(order[0]).alias("changed_at"),
        "old_due",
        "new_due",
        "shift_days",
        F.col("_seq").alias("change_no"),
        "total_shift_days",
    )


def job_applications(
    applications: DataFrame,
    changes: DataFrame,
    stages: Sequence[str],
    as_of: Column,
    ghosted_after_days: int = 30,
    keep: Sequence[str] = (),
) -> DataFrame:
    """O-M8: days to the first response (the first status change after the initial state),
    ghosted applications (no response and older than the limit) and the furthest of the
    ``stages`` (in funnel order) ever reached. One aggregation of the history per page."""
    stage_no = F.coalesce(
        *[F.when(F.col("new_value") == stage, F.lit(i)) for i, stage in enumerate(stages)]
    )
    later = F.col("valid_from") == F.col("detected_at")
    per_page = (
        changes.where(F.col("field") == "status")
        .groupBy("page_id")
        .agg(F.min(F.when(later, F.col("valid_from"))).alias("first_response_at"), F.max(stage_no).alias("_stage"))
    )
    names = F.array(*[F.lit(s) for s in stages])
    applied = F.col("applied_date_start")
    return applications.join(per_page, "page_id", "left").select(
        "page_id",
        *keep,
        F.datediff(F.col("first_response_at"), applied).alias("days_to_first_response"),
        (F.col("first_response_at").isNull() & (F.datediff(as_of, applied) > ghosted_after_days)).alias("is_ghosted"),
        F.get(names, F.col("_stage")).alias("funnel_stage_reached"),
    )


def dim_scd2(versions: DataFrame, key: str, order: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """O-M9: one row per distinct state of a key's attributes with its validity and
    ``is_current``; versions that change nothing extend the state before them."""
    hot = skew.hot_keys_if_any(versions, [key])
    slim = versions.select(key, *order, *attributes)
    seen = skew.ordered_neighbours(slim, [key], order, previous=attributes, hot=hot)
    changed = F.col("_prev").isNull()
    for a in attributes:
        changed = changed | ~F.col(f"_prev.{a}").eqNullSafe(F.col(a))
    states = seen.where(changed).select(key, *order, *attributes)
    ended = skew.ordered_neighbours(states, [key], order, following=[order[0]], hot=hot)
    return ended.select(
        key,
        *attributes,
        F.col(order[0]).alias("valid_from"),
        F.col(f"_next.{order[0]}").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        F.col("_seq").alias("version_no"),
    )


def as_of_state(
    changes: DataFrame, as_of: Column, fields: Sequence[str], order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """O-M12: the tracked fields of every page as they were at a moment. One aggregation
    with fixed columns; values of a page meet only after a map-side maximum."""
    rank = F.struct(*order)
    latest = [
        F.max(F.when(F.col("field") == f, F.struct(rank.alias("rank"), F.col("new_value").alias("value")))).alias(f)
        for f in fields
    ]
    known = changes.where((F.col(order[0]) <= as_of) & F.col("field").isin(*fields))
    return known.groupBy("page_id").agg(*latest).select("page_id", *[F.col(f"{f}.value").alias(f) for f in fields])


def states_at(
    changes: DataFrame, moments: DataFrame, fields: Sequence[str], order: Sequence[str] = CHANGE_ORDER, hot=skew.COUNT
) -> DataFrame:
    """O-M12 at many moments: the tracked fields of every (page_id, moment) as they were then.

    Records and moments of a page are sorted together, and each field's last value is carried forward, in
    one shuffle; hot pages are split along time. A record of the very moment counts. Repeated pairs give repeated rows;
    fields not known by then, and all those of a NULL moment, are NULL.
    """
    rest = [f"_o{i}" for i in range(1, len(order))]
    kinds = dict(changes.dtypes)
    names = [f"_f{i}" for i in range(len(fields))]
    records = changes.where(F.col("field").isin(*fields) & F.col(order[0]).isNotNull()).select(
        "page_id", F.col(order[0]).alias("_at"), F.lit(0).alias("_asked"),
        *[F.col(c).alias(r) for c, r in zip(order[1:], rest)],
        *[F.when(F.col("field") == f, F.struct(F.col("new_value").alias("value"))).alias(n) for f, n in zip(fields, names)],
    )
    asked = moments.select(
        "page_id", F.col("moment").cast(kinds[order[0]]).alias("_at"), F.lit(1).alias("_asked"),
        *[F.lit(None).cast(kinds[c]).alias(r) for c, r in zip(order[1:], rest)],
        *[F.lit(None).cast(records.schema[n].dataType).alias(n) for n in names],
    )
    known = skew.ordered_neighbours(records.unionByName(asked), ["page_id"], ["_at", "_asked", *rest], hot=hot, carried_forward=names)
    return known.where("_asked = 1").select(
        "page_id", F.col("_at").alias("moment"), *[F.col(f"{n}.value").alias(f) for f, n in zip(fields, names)]
    )
