"""Incremental merge into the stored daily table, upserts and partial updates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countlake.operators.metrics import WEEKDAY_GROUP, rolling_metrics, same_weekday, with_weekday
from countlake.operators.serving import in_date_range
from countlake.schemas import DAILY_KEY, DAILY_METRICS
from countlake.session import write_through
from countlake.sources.daily_table import PARTITION_COLUMNS, commit_daily, is_flat
from countlake.sources.versions import Snapshot

# Rows of a weekday that a row's metrics reach back to.
_REACH = 4
# Days around a run's own in which those rows usually are: ten weeks.
_NEAR_DAYS = 70
_COUNTS = ["date", "agency_name", "counter_id", "unit", "daily_visitor_count"]


def one_row_per_key(daily: DataFrame) -> DataFrame:
    """Keeps the smallest of rows that differ on one daily key, so a rerun picks the same.

    The unit is part of the key: counts of several units stay side by side.
    """
    rest = [c for c in DAILY_METRICS.names if c not in DAILY_KEY]
    kept = daily.groupBy(*DAILY_KEY).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*DAILY_KEY, "kept.*").select(*DAILY_METRICS.names)


def new_days(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose key is not stored yet.

    Only the key columns of the stored table are read and shuffled, and only
    the rows that remain are reduced to one per key.
    """
    dated = incoming.filter("date is not null")
    return one_row_per_key(dated.join(existing.select(*DAILY_KEY), DAILY_KEY, "left_anti"))


def new_undated(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows without a date that are not stored as they are.

    A null date matches no key, so these rows are compared as a whole.
    """
    columns = DAILY_METRICS.names
    no_date = F.col("date").isNull()
    return incoming.filter(no_date).select(*columns).subtract(existing.filter(no_date).select(*columns))


def merge_daily(existing: DataFrame, incoming: DataFrame, undated: bool = False) -> DataFrame:
    """First writer wins: stored rows stay, incoming rows fill missing keys.

    Rows without a date are left out unless ``undated``.
    """
    columns = DAILY_METRICS.names
    merged = existing.select(*columns).unionByName(new_days(existing, incoming).select(*columns))
    return merged.unionByName(new_undated(existing, incoming)) if undated else merged


def _commit(
    spark: SparkSession,
    path: str,
    change: Callable[[DataFrame | None], DataFrame | None],
    replace: bool = False,
) -> Snapshot:
    if is_flat(spark, path):
        raise ValueError(f"{path} is not partitioned by year and month: copy it with write_daily first")
    return commit_daily(spark, path, change, replace)


def _date_span(df: DataFrame) -> tuple[dt.date | None, dt.date | None, int]:
    """First date, last date, number of rows without a date."""
    span = df.agg(
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if(F.col("date").isNull()).alias("undated"),
    ).first()
    return span["first"], span["last"], span["undated"]


def merge_into(spark: SparkSession, path: str, incoming: DataFrame) -> Snapshot:
    """First-writer-wins merge into the table at ``path``; returns the version it made.

    Stored rows never change under this rule, so the table is not rewritten:
    new keys are appended, and only the months the run touches are read to
    find them. A run that is repeated finds its own rows stored and adds
    nothing; one that was cut off has added nothing. Of two writers at a time
    the later works its rows out again on top of the other's.
    """
    incoming = write_through(incoming, "incoming")
    first, last, undated = _date_span(incoming)

    def change(existing: DataFrame | None) -> DataFrame:
        if existing is None:
            return one_row_per_key(incoming)
        new = new_days(in_date_range(existing, first, last), incoming)
        return new.unionByName(new_undated(existing, incoming)) if undated else new

    return _commit(spark, path, change)


def _context(existing: DataFrame, changed: DataFrame, after: bool) -> DataFrame:
    """Stored counts that the metrics of ``changed`` counts are made from.

    Per sensor and weekday: the rows between its first and last changed day,
    the four before, and with ``after`` the four that follow. They are looked
    for in the weeks around the run first; only groups with fewer rows there
    are looked up in the whole table.
    """
    spans = write_through(
        with_weekday(changed)
        .groupBy(*WEEKDAY_GROUP)
        .agg(F.min("date").alias("first"), F.max("date").alias("last")),
        "spans",
    )
    whole = spans.agg(F.min("first").alias("first"), F.max("last").alias("last")).first()
    if whole["first"] is None:
        return existing.select(*_COUNTS).filter(F.lit(False))
    near = dt.timedelta(days=_NEAR_DAYS)
    start, end = whole["first"] - near, whole["last"] + (near if after else dt.timedelta(0))

    def needed(stored: DataFrame, groups: DataFrame) -> DataFrame:
        rows = stored.select(*_COUNTS, "weekday").join(groups, WEEKDAY_GROUP)
        group = Window.partitionBy(*WEEKDAY_GROUP)
        side = {
            "between": F.col("date").between(F.col("first"), F.col("last")),
            "before": F.col("date") < F.col("first"),
            "after": F.col("date") > F.col("last"),
        }
        order = {"before": (F.desc("date"), F.desc("unit")), "after": ("date", "unit")}
        found = rows.filter(side["between"]).withColumn("side", F.lit("between"))
        for name in ("before", "after") if after else ("before",):
            place = F.row_number().over(group.orderBy(*order[name]))
            nearest = rows.filter(side[name]).withColumn("place", place)
            nearest = nearest.filter(F.col("place") <= _REACH).drop("place")
            found = found.unionByName(nearest.withColumn("side", F.lit(name)))
        return found.select(*_COUNTS, "weekday", "side")

    found = write_through(needed(in_date_range(existing, start, end), spans), "near-context")
    sides = ["before", "after"] if after else ["before"]
    held = found.groupBy(*WEEKDAY_GROUP).agg(
        F.least(*[F.count_if(F.col("side") == x) for x in sides], F.lit(_REACH)).alias("held")
        if len(sides) > 1
        else F.count_if(F.col("side") == "before").alias("held")
    )
    short = write_through(
        spans.join(held, WEEKDAY_GROUP, "left")
        .filter(F.coalesce("held", F.lit(0)) < _REACH)
        .select(*spans.columns),
        "short-context",
    )
    if short.isEmpty():
        return found.select(*_COUNTS)
    full = needed(in_date_range(existing, None, None if after else whole["last"]), short)
    rest = found.join(short.select(*WEEKDAY_GROUP), WEEKDAY_GROUP, "left_anti")
    return rest.select(*_COUNTS).unionByName(full.select(*_COUNTS))


def append_counts(spark: SparkSession, path: str, counts: DataFrame) -> Snapshot:
    """First-writer-wins merge of daily counts, with baselines from stored history.

    Counts of stored days are left out. The metrics of the others are made
    from the stored rows that precede them, so that ingesting days in parts
    gives what one run over all of them gives, as long as they come in order.
    ``counts`` has one row per daily key. Returns the version it made.
    """
    counts = write_through(counts.select(*_COUNTS), "counts")
    first, last, undated = _date_span(counts)

    def change(existing: DataFrame | None) -> DataFrame:
        if existing is None:
            return rolling_metrics(counts)
        stored = in_date_range(existing, first, last).select(*DAILY_KEY)
        dated = counts.filter("date is not null")
        new = write_through(dated.join(stored, DAILY_KEY, "left_anti"), "new-counts")
        history = _context(existing, new, after=False).withColumn("is_new", F.lit(False))
        rows = history.unionByName(new.withColumn("is_new", F.lit(True)))
        redone = rolling_metrics(rows, keep=["is_new"]).filter("is_new").drop("is_new")
        if undated:
            loose = rolling_metrics(counts.filter("date is null"))
            redone = redone.unionByName(new_undated(existing, loose))
        return redone

    return _commit(spark, path, change)


def recompute_into(spark: SparkSession, path: str, counts: DataFrame) -> Snapshot:
    """Last-writer-wins merge of daily counts, with metrics redone from history.

    ``counts`` replaces the stored counts of its keys. A count affects its own
    row and at most the four rows after it of its sensor and weekday: only
    those are redone, and only the months they lie in are replaced, all at once,
    by the new version that is returned. Every count needs a date.
    """
    counts = write_through(counts.select(*_COUNTS), "counts")
    first, _, undated = _date_span(counts)
    if undated:
        raise ValueError("recomputing needs a date on every count")

    def change(existing: DataFrame | None) -> DataFrame | None:
        if existing is None:
            return rolling_metrics(counts)
        return _redone(existing, counts) if first else None

    return _commit(spark, path, change, replace=True)


def _redone(existing: DataFrame, counts: DataFrame) -> DataFrame:
    """All rows of the months in which ``counts`` changes something."""
    history = _context(existing, counts, after=True).join(
        counts.select(*DAILY_KEY), DAILY_KEY, "left_anti"
    )
    rows = history.withColumn("changed", F.lit(False)).unionByName(
        counts.withColumn("changed", F.lit(True))
    )
    reached = same_weekday().rowsBetween(-_REACH, Window.currentRow)
    affected = write_through(
        rolling_metrics(rows, keep=["changed"])
        .withColumn("affected", F.max("changed").over(reached))
        .filter("affected")
        .select(*DAILY_METRICS.names),
        "affected",
    )
    first, last, _ = _date_span(affected)
    months = affected.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct()
    ends = first.replace(day=1), (last.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    others = (
        in_date_range(existing, *ends)
        .join(months, PARTITION_COLUMNS, "left_semi")
        .join(affected.select(*DAILY_KEY), DAILY_KEY, "left_anti")
    )
    return affected.unionByName(others.select(*DAILY_METRICS.names))


def _last_rows(updates: DataFrame, key: str, order: str | None) -> DataFrame:
    """One update per key: the last by ``order``; without it the greatest row, so a rerun agrees."""
    rest = F.struct(*[c for c in updates.columns if c != key])
    last = F.max_by(rest, order) if order else F.max(rest)
    return updates.groupBy(key).agg(last.alias("row")).select(key, "row.*")


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of ``updates`` replace those of ``base`` with the same key.

    Of several updates of one key the last by the column ``order`` counts.
    """
    last = write_through(_last_rows(updates, key, order), "updates")
    kept = base.join(last.select(key), key, "left_anti").select(*base.columns)
    return kept.unionByName(last.select(*base.columns))


def partial_update(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    columns: list[str],
    updated_at: Column,
    order: str | None = None,
) -> DataFrame:
    """Sets the given columns where the update is not null; null leaves them.

    ``updated_at`` is set on every row that has an update. Of several updates
    of one key the last value by the column ``order`` that is not null counts,
    column by column; without ``order`` the greatest.
    """

    def last(name: str) -> Column:
        value = F.col(name)
        if order is None:
            return F.max(value)
        return F.max_by(value, F.when(value.isNotNull(), F.col(order)))

    new = updates.groupBy(F.col(key).alias("_key")).agg(
        *[last(c).alias(f"_new_{c}") for c in columns]
    )
    joined = base.join(new, base[key] == new["_key"], "left")
    kept = [
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
        for c in base.columns
        if c != "updated_at"
    ]
    old = F.col("updated_at") if "updated_at" in base.columns else F.lit(None)
    stamp = F.when(F.col("_key").isNotNull(), updated_at).otherwise(old)
    return joined.select(*kept, stamp.alias("updated_at"))
