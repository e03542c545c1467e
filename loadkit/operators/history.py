"""Append-only history: which source rows are new or changed.

``source`` holds rows to load, ``target`` the history so far. Both carry the
key columns and a business date. Every source row is judged against the target
alone, never against another row of the batch: rows that share a key and a date
are each judged by their own values. Null keys and dates equal nothing, so their
rows count as new. Values are compared null-safely.

The source is read more than once: land a batch that is costly to derive, or
not repeatable, before handing it in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, DateType, TimestampNTZType, TimestampType

from loadkit.functions.columns import add_current_timestamp, differs
from loadkit.operators.keyed import join_per_key
from loadkit.operators.shape import first_per_key


def _within_dates_of(source: DataFrame, target: DataFrame, date_col: str) -> DataFrame:
    """Target rows from the span of the source's dates.

    The span reaches the scan while the query runs, so a batch of one day
    reads one day's partitions or row groups of a long history.
    """
    first, last = (source.agg(bound(date_col)).scalar() for bound in (F.min, F.max))
    return target.where((F.col(date_col) >= first) & (F.col(date_col) <= last))


def not_in_target(source: DataFrame, target: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Source rows whose key and date the target does not have."""
    on = [*keys, date_col]
    known = _within_dates_of(source, target, date_col).select(*on).distinct()
    return join_per_key(source, known, on, "left_anti")


def _of_batch(source: DataFrame, target: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Target rows that can matter to a batch: of its keys, and not after its last date.

    The date reaches the scan while the query runs. How the keys do is left to
    Spark: a small batch's are broadcast, and rows of others leave before any
    shuffle.
    """
    last = source.agg(F.max(date_col)).scalar()
    wanted = source.select(*keys).distinct()
    return join_per_key(target.where(F.col(date_col) <= last), wanted, keys, "left_semi")


def last_known(history: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Newest row per key; equal dates fall back to the other plain columns, for a repeatable result."""
    rest = [
        F.col(f.name).desc()
        for f in history.schema
        if f.name not in (*keys, date_col) and isinstance(f.dataType, AtomicType)
    ]
    return first_per_key(history, keys, [F.col(date_col).desc(), *rest])


def first_seen(source: DataFrame, target: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Source rows whose key has no earlier row in the target."""
    begun = _of_batch(source, target, keys, date_col).groupBy(*keys).agg(F.min(date_col).alias("_begun"))
    joined = join_per_key(source, begun, keys, "left")
    earlier = F.coalesce(F.col("_begun") < F.col(date_col), F.lit(False))
    return joined.where(~earlier).select(*source.columns)


def _before(line: list[str], date_col: str) -> WindowSpec:
    """Rows of a line by date, a question before the target row of the same date."""
    return Window.partitionBy(*line).orderBy(F.col(date_col).asc(), F.col("_asked").desc())


def _with_neighbours(points: DataFrame, line: list[str], date_col: str) -> DataFrame:
    """Add ``_prev``, the latest target row on an earlier date, and ``_same``, the target row on the same date."""
    order = _before(line, date_col)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = points.withColumns({"_prev": F.last("_row", ignorenulls=True).over(earlier), "_next": F.lead("_row").over(order)})
    return seen.withColumn("_same", F.when(F.col("_next")[date_col] == F.col(date_col), F.col("_next"))).drop("_next")


def _clock(moment: Column, kind: DataType) -> list[Column]:
    """Day and second of the day of a timestamp, in the order of time.

    A timestamp without time zone is taken apart by its own clock; truncating
    it would go through the session's zone, where clock changes reorder it.
    """
    if isinstance(kind, TimestampType):
        seconds = F.unix_timestamp(moment)
        return [F.floor(seconds / 86400).alias("_day"), F.pmod(seconds, F.lit(86400)).alias("_second")]
    second = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return [F.unix_date(moment.cast("date")).cast("bigint").alias("_day"), second.cast("bigint").alias("_second")]


def _carried(closing: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
    """Add the last target row of the earlier pieces of ``within``."""
    before = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return closing.withColumn(name, F.last("_row", ignorenulls=True).over(before))


def _answered(points: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Neighbours of each question. Questions and target rows are each unique per key and date."""
    kind = points.schema[date_col].dataType
    if isinstance(kind, DateType):
        # Two points a day at most: a key's line is bounded by the calendar.
        return _with_neighbours(points, keys, date_col)
    if not isinstance(kind, (TimestampType, TimestampNTZType)):
        raise ValueError(f"{date_col!r} must be a date or a timestamp, not {kind.simpleString()}")
    # Timestamps put no bound on a key's line. Cut it into seconds, carry the last target row of the earlier ones into
    # each as its opening point, and look back within the second only. The carrying goes by days, and by the seconds
    # of a day, so that each of its lines is bounded by the calendar too.
    pieces = points.select("*", *_clock(F.col(date_col), kind))
    piece = [*keys, "_day", "_second"]
    seconds = pieces.groupBy(*piece).agg(F.max("_row").alias("_row"), F.max("_asked").alias("_any_asked"))
    days = seconds.groupBy(*keys, "_day").agg(F.max("_row").alias("_row"))
    yesterday = _carried(days, keys, "_day", "_before_day").drop("_row")
    opening = join_per_key(_carried(seconds, [*keys, "_day"], "_second", "_in_day"), yesterday, [*keys, "_day"], "left")
    opening = opening.where("_any_asked").select(
        *keys,
        F.lit(None).cast(kind).alias(date_col),
        F.coalesce("_in_day", "_before_day").alias("_row"),
        F.lit(False).alias("_asked"),
        "_day",
        "_second",
    )
    opening = opening.where(F.col("_row").isNotNull())
    return _with_neighbours(pieces.unionByName(opening, allowMissingColumns=True), piece, date_col).drop("_day", "_second")


def _looked_up(
    source: DataFrame, target: DataFrame, keys: list[str], date_col: str, value_cols: list[str]
) -> DataFrame:
    """Source rows with ``_same``, the target row of the same date, and ``_prev``, the latest before it.

    Only distinct keys and dates of the source go through the window, next to
    the target's; the rows themselves meet the answers in one join.
    """
    on = [*keys, date_col]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    near = _of_batch(source, target.where(known), keys, date_col)
    kept = near.groupBy(*on).agg(F.max(F.struct(date_col, *value_cols)).alias("_row"))
    asked = source.where(known).select(*on).distinct()
    points = kept.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumns({"_row": F.lit(None).cast(kept.schema["_row"].dataType), "_asked": F.lit(True)})
    )
    answers = _answered(points, keys, date_col).where("_asked").drop("_asked", "_row")
    return join_per_key(source, answers, on, "left").select(*source.columns, "_same", "_prev")


def asof_previous(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
) -> DataFrame:
    """Add ``prev_*``: date and values of the latest target row of the key strictly before each source row.

    Where ``date_col`` is a timestamp, a key's history is cut into seconds, so
    that no task has to hold a busy key's line.
    """
    joined = _looked_up(source, target, keys, date_col, value_cols)
    return joined.select(
        *source.columns, *[F.col("_prev")[c].alias(f"prev_{c}") for c in (date_col, *value_cols)]
    )


def join_last_known(
    source: DataFrame, target: DataFrame, keys: list[str], date_col: str, value_cols: list[str]
) -> DataFrame:
    """Add ``last_*``: date and values of the key's newest target row, where that is older than the source row."""
    wanted = source.select(*keys).distinct()
    near = join_per_key(target.select(*keys, date_col, *value_cols), wanted, keys, "left_semi")
    return _with_last(source, last_known(near, keys, date_col), keys, date_col, value_cols)


def _with_last(source: DataFrame, newest: DataFrame, keys: list[str], date_col: str, value_cols: list[str]) -> DataFrame:
    """``join_last_known`` out of the newest row per key."""
    packed = newest.select(*keys, F.struct(date_col, *value_cols).alias("_last"))
    joined = join_per_key(source, packed, keys, "left")
    earlier = F.when(F.col("_last")[date_col] < F.col(date_col), F.col("_last"))
    return joined.select(
        *source.columns, *[earlier[c].alias(f"last_{c}") for c in (date_col, *value_cols)]
    )


def expired_keys(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    date_col: str,
    load_date: str,
    valid_till: str = "valid_till",
) -> DataFrame:
    """Closing rows for open target keys that a full load on ``load_date`` no longer has.

    They repeat the key's newest row, dated ``load_date`` and valid till the day
    before. A row opened on that day or later stays open: the load is older
    than it and knows nothing of it.
    """
    return closing_rows(source, last_known(target, keys, date_col), keys, date_col, load_date, valid_till)


def closing_rows(source: DataFrame, newest: DataFrame, keys: list[str], date_col: str, load_date: str, valid_till: str = "valid_till") -> DataFrame:
    """``expired_keys`` out of the newest row per key."""
    day = F.lit(load_date).cast("date")
    still_open = newest.where(F.col(valid_till).isNull() & (F.col(date_col) < day))
    gone = still_open.join(source.select(*keys).distinct(), keys, "left_anti").select(*newest.columns)
    return gone.withColumns({date_col: day.cast(newest.schema[date_col].dataType), valid_till: F.date_sub(day, 1)})


def _stamped(df: DataFrame, inserted_col: str | None) -> DataFrame:
    return add_current_timestamp(df, inserted_col) if inserted_col else df


def _chained(source: DataFrame, target: DataFrame, keys: list[str], date_col: str, value_cols: list[str]) -> DataFrame:
    """Source rows that differ from the point before them on their key's line of target and batch.

    The rows go through two shuffles: by key and date, where one row of each
    is left, and by key. Neither source nor target meets itself in a join.
    """
    on = [*keys, date_col]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    kind = {c: target.schema[c].dataType for c in value_cols}
    line = {c: c if source.schema[c].dataType == kind[c] else f"_line_{c}" for c in value_cols}
    cast = {line[c]: F.col(c).cast(kind[c]) for c in value_cols if line[c] != c}
    near = _of_batch(source, target.where(known), keys, date_col)
    past = near.select(*on, *[F.col(c).alias(line[c]) for c in value_cols], F.lit(True).alias("_old"))
    points = source.where(known).withColumns({**cast, "_old": F.lit(False)}).unionByName(past, allowMissingColumns=True)
    rest = [f.name for f in source.schema if f.name not in (*on, *value_cols) and isinstance(f.dataType, AtomicType)]
    points = first_per_key(points, on, [F.col(c).desc() for c in ("_old", *value_cols, *cast, *rest)])
    if isinstance(points.schema[date_col].dataType, DateType):
        # one point a day: a key's line is bounded by the calendar
        order = Window.partitionBy(*keys).orderBy(date_col)
        seen = points.withColumns({"_place": F.row_number().over(order), **{f"_prev_{c}": F.lag(line[c]).over(order) for c in value_cols}})
        first, before = F.col("_place") == 1, [F.col(f"_prev_{c}") for c in value_cols]
    else:
        row = F.struct(date_col, *[F.col(line[c]).alias(c) for c in value_cols])
        seen = _answered(points.withColumns({"_row": row, "_asked": ~F.col("_old")}), keys, date_col).where("_asked")
        first, before = F.col("_prev").isNull(), [F.col("_prev")[c] for c in value_cols]
    changed = seen.where(~F.col("_old") & (first | differs([F.col(line[c]) for c in value_cols], before)))
    own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in on else F.col(f.name) for f in source.schema]
    return changed.select(*own).unionByName(source.where(~known))


def changed_asof(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
    inserted_col: str | None = "inserted_time",
    chain: bool = False,
) -> DataFrame:
    """Rows to append so that late arrivals still fit.

    A source row is kept if the target has no row of its key and date, and its
    values differ from the latest target row before that date, or there is none.

    With ``chain`` the batch's own rows count as well: target and batch make one
    line per key, and a row is judged by the point before it, of either. A date
    that the target has is the target's. Of several source rows of one key and
    date the greatest by values counts, and the others are not kept. So a value
    that a batch repeats day after day is appended once, and a second load of
    the same batch appends nothing.
    """
    if chain:
        return _stamped(_chained(source, target, keys, date_col, value_cols), inserted_col)
    joined = _looked_up(source, target, keys, date_col, value_cols)
    prev = F.col("_prev")
    changed = prev.isNull() | differs([F.col(c) for c in value_cols], [prev[c] for c in value_cols])
    return _stamped(joined.where(F.col("_same").isNull() & changed).select(*source.columns), inserted_col)


def changed_vs_last_known(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
    inserted_col: str | None = "inserted_time",
    newest: DataFrame | None = None,
) -> DataFrame:
    """Rows to append, judged against the newest target row of each key.

    A row older than its key's newest target row counts as new; use
    ``changed_asof`` where such late rows must be compared as well.

    ``newest`` are the target's newest rows per key, where they are kept
    (``sinks.newest``) or landed; a batch of many keys is then not gone through
    a second time to find the target rows that matter to it.
    """
    fresh = not_in_target(source, target, keys, date_col)
    if newest is None:
        joined = join_last_known(fresh, target, keys, date_col, value_cols)
    else:
        joined = _with_last(fresh, newest, keys, date_col, value_cols)
    changed = F.col(f"last_{date_col}").isNull() | differs(
        [F.col(c) for c in value_cols], [F.col(f"last_{c}") for c in value_cols]
    )
    return _stamped(joined.where(changed).select(*source.columns), inserted_col)


def changed_with_expiry(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
    load_date: str,
    valid_till: str = "valid_till",
    inserted_col: str | None = "inserted_time",
) -> DataFrame:
    """Rows to append for a full load: new and changed rows, and closing rows for keys it lacks.

    A key whose newest row is closed opens again, even with the values it had.
    """
    fresh = not_in_target(source, target, keys, date_col)
    joined = join_last_known(fresh, target, keys, date_col, [*value_cols, valid_till])
    changed = (
        F.col(f"last_{date_col}").isNull()
        | F.col(f"last_{valid_till}").isNotNull()
        | differs([F.col(c) for c in value_cols], [F.col(f"last_{c}") for c in value_cols])
    )
    cols = [*keys, date_col, *value_cols]
    opened = joined.where(changed).select(*cols, F.lit(None).cast(target.schema[valid_till].dataType).alias(valid_till))
    closed = expired_keys(source, target.select(*cols, valid_till), keys, date_col, load_date, valid_till)
    return _stamped(opened.unionByName(closed), inserted_col)


def changed_by_newest(
    source: DataFrame,
    newest: DataFrame,
    history: DataFrame,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
    load_date: str,
    valid_till: str = "valid_till",
    inserted_col: str | None = "inserted_time",
) -> DataFrame:
    """Rows to append for a full load, as ``changed_with_expiry`` gives them, from the newest rows alone.

    A source row as old as its key's newest row is known; a later one is judged
    by it. Only of a row that is older can the history say whether its date is
    there: it is read if the load has such late rows, over the span of their
    dates, and not at all otherwise. Finding out takes one pass over the
    source's keys and dates, so land a source that is costly to derive.
    """
    cols = [*keys, date_col, *value_cols]
    packed = newest.select(*keys, F.struct(date_col, *value_cols, valid_till).alias("_last"))
    joined = join_per_key(source.select(*cols), packed, keys, "left")
    last = F.col("_last")
    changed = (
        last.isNull()
        # a row without a date is no later or earlier than any: it counts as new
        | F.col(date_col).isNull()
        | (
            (last[date_col] < F.col(date_col))
            & (last[valid_till].isNotNull() | differs([F.col(c) for c in value_cols], [last[c] for c in value_cols]))
        )
        | last[date_col].isNull()
    )
    opened = joined.where(changed).select(*cols)
    late = joined.where(last[date_col] > F.col(date_col)).select(*cols)
    if not late.isEmpty():
        opened = opened.unionByName(not_in_target(late, history, keys, date_col))
    opened = opened.withColumn(valid_till, F.lit(None).cast(newest.schema[valid_till].dataType))
    closed = closing_rows(source, newest.select(*cols, valid_till), keys, date_col, load_date, valid_till)
    rows = opened.unionByName(closed)
    return _stamped(rows, inserted_col)
