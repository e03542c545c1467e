"""The newest row of every key, kept beside a history, so that a load need not read the history.

``load_full`` takes a full load into an append-only history whose keys close
when a load lacks them. What it must know of the past is each key's newest row.
These rows are a hashed table of their own, which every load brings up to date
by the rows it has appended: it reads and writes the buckets of their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.operators.history import changed_by_newest, last_known
from loadkit.session import scratch_table
from loadkit.sinks.hashed import BUCKET, create_hashed, hashed_by, hashed_rows, rewrite_hashed
from loadkit.sinks.once import RUN, append_once, committed_rows, run_value
from loadkit.sinks.tables import write_table


def create_newest(history: DataFrame, table: str, keys: list[str], date_col: str, buckets: int = 256) -> int:
    """Make the table of newest rows out of a whole history; the number of keys.

    Give it the columns that loads are judged by: keys, date, values and the
    end of validity, in this order. Of equal dates the greatest row counts.
    """
    return create_hashed(last_known(history, keys, date_col), table, keys, buckets)


def update_newest(appended: DataFrame, table: str, date_col: str) -> int:
    """Bring the table up to date with rows that the history got; the number of rows written.

    Rows that are there already, or older than their key's, change nothing, so
    doing it again does no harm. Null keys are values like others here, as they
    are in ``last_known``.
    """
    settings = hashed_by(appended.sparkSession, table)
    if settings is None:
        raise ValueError(f"{table} is not a hashed table")
    keys = settings[0]

    def newest(near: DataFrame, dealt: DataFrame) -> DataFrame:
        fitted = dealt.select(*[F.col(f.name).cast(f.dataType) for f in near.schema])
        return last_known(near.unionByName(fitted), [*keys, BUCKET], date_col)

    return rewrite_hashed(appended, table, newest)


def load_full(
    source: DataFrame,
    history: str,
    newest: str,
    keys: list[str],
    date_col: str,
    value_cols: list[str],
    load_date: str,
    load_id: str,
    valid_till: str = "valid_till",
    inserted_col: str | None = "inserted_time",
) -> int:
    """Take a full load into a history and its newest rows; the number of rows the load has in the history.

    ``history`` keeps loads apart (``sinks.once``), ``newest`` is made by
    ``create_newest``. A load that was stopped is started again under its
    ``load_id``: before its rows are recorded, the newest rows are as they were,
    and it replaces what it had appended; afterwards only the newest rows are
    brought up to date, from the load's own partition. Loads of one history
    must not overlap.
    """
    spark = source.sparkSession
    own = F.col(RUN) == run_value(load_id)
    if committed_rows(spark, history, load_id) is None:
        # without what a stopped try has left, which this one replaces
        past = spark.table(history).where(~own)
        state = hashed_rows(spark, newest)
        staged = scratch_table(spark, "full_load")
        try:
            # a table cannot be read while one of its partitions is overwritten
            write_table(changed_by_newest(source, state, past, keys, date_col, value_cols, load_date, valid_till, inserted_col), staged)
            append_once(spark.table(staged), history, load_id)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.catalog.refreshTable(history)
    appended = spark.table(history).where(own)
    update_newest(appended.select(*[c for c in spark.table(newest).columns if c != BUCKET]), newest, date_col)
    return committed_rows(spark, history, load_id) or 0
