"""Change capture.

The history (target) is every customer's order status by day, out of all
orders. The batch (source) is every customer's shipment status by day, out of
all order lines; its days fall among those of the history, so most rows are
late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators import history as H
from loadkit.operators.shape import first_per_key
from loadkit.queries.registry import query, table
from loadkit.session import scratch_path, scratch_table
from loadkit.sinks.hashed import hashed_rows
from loadkit.sinks.newest import create_newest, load_full
from loadkit.sinks.once import RUN, append_once
from loadkit.sinks.tables import append_table, write_table

KEYS, DATE = ["id"], "business_date"

TARGET_CTE = """
tgt AS (SELECT id, business_date, value1, value2 FROM (
    SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS business_date, o_orderstatus AS value1,
           CAST(substr(o_orderpriority, 1, 1) AS INT) AS value2,
           ROW_NUMBER() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
    FROM orders) x WHERE rn = 1)"""
SOURCE_CTE = """
src AS (SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS business_date, MAX(l_linestatus) AS value1,
               MAX(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS value2
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, CAST(l_shipdate AS DATE))"""
CANDIDATES_CTE = """
cand AS (SELECT s.* FROM src s WHERE NOT EXISTS
    (SELECT 1 FROM tgt t WHERE t.id = s.id AND t.business_date = s.business_date))"""
LAST_CTE = """
lk AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY business_date DESC) AS r FROM tgt) y
       WHERE r = 1)"""


def target(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderdate").cast("date").alias(DATE),
        F.col("o_orderstatus").alias("value1"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("value2"),
        "o_orderkey",
    )
    return first_per_key(orders, [*KEYS, DATE], [F.col("o_orderkey").desc()]).drop("o_orderkey")


def _landed(df: DataFrame) -> DataFrame:
    """The batch as a load finds it: stored, not derived again for each use."""
    spark = df.sparkSession
    path = scratch_path(spark, "batch")
    df.write.parquet(path)
    return spark.read.parquet(path)


def source(spark: SparkSession, sf: str) -> DataFrame:
    # cut to what is needed before the shuffles of the join
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias(DATE), (F.col("l_linestatus") == "O").alias("open"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("value2")
    )
    days = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("id", DATE)
        .agg(F.max("open").alias("open"), F.max("value2").alias("value2"))
    )
    return _landed(days.select("id", DATE, F.when(F.col("open"), "O").otherwise("F").alias("value1"), "value2"))


def _text_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.typeName() == "date"})


@query(f"WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE} "
       "SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2 FROM cand")
def not_in_target(spark, sf):
    return _text_dates(H.not_in_target(source(spark, sf), target(spark, sf), KEYS, DATE))


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}
SELECT s.id, CAST(s.business_date AS VARCHAR) AS business_date, s.value1, s.value2,
       CAST(t.business_date AS VARCHAR) AS prev_business_date, t.value1 AS prev_value1
FROM src s ASOF LEFT JOIN tgt t ON s.id = t.id AND s.business_date > t.business_date""")
def asof_previous(spark, sf):
    return _text_dates(H.asof_previous(source(spark, sf), target(spark, sf), KEYS, DATE, ["value1"]))


@query("""
SELECT e.event_id, e.event_type, COALESCE(p.event_id, -1) AS prev_event_id, COALESCE(p.event_type, '-') AS prev_event_type
FROM events e ASOF LEFT JOIN (
    SELECT user_id, ts, MAX(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
    FROM events GROUP BY user_id, ts) p
ON e.user_id = p.user_id AND e.ts > p.ts""")
def asof_previous_event(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    df = H.asof_previous(events, events, ["user_id"], "ts", ["event_id", "event_type"])
    return df.select("event_id", "event_type", "prev_event_id", "prev_event_type").fillna(-1, ["prev_event_id"]).fillna(
        "-", ["prev_event_type"]
    )


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}, {LAST_CTE}
SELECT s.id, CAST(s.business_date AS VARCHAR) AS business_date, s.value1, s.value2,
       CAST(l.business_date AS VARCHAR) AS last_business_date, l.value1 AS last_value1,
       COALESCE(l.value2, 0) AS last_value2
FROM src s LEFT JOIN lk l ON l.id = s.id AND l.business_date < s.business_date""")
def last_known_join(spark, sf):
    df = H.join_last_known(source(spark, sf), target(spark, sf), KEYS, DATE, ["value1", "value2"])
    return _text_dates(df).fillna(0, ["last_value2"])


@query(f"WITH {TARGET_CTE}, {LAST_CTE} "
       "SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2 FROM lk")
def last_known(spark, sf):
    return _text_dates(H.last_known(target(spark, sf), KEYS, DATE))


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}
SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2 FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.id = s.id AND t.business_date < s.business_date)""")
def first_seen_keys(spark, sf):
    return _text_dates(H.first_seen(source(spark, sf), target(spark, sf), KEYS, DATE))


ASOF_CTE = """
prev AS (SELECT c.id, c.business_date, c.value1, c.value2, t.id AS found, t.value1 AS prev_value1
         FROM cand c ASOF LEFT JOIN tgt t ON c.id = t.id AND c.business_date > t.business_date),
changed AS (SELECT id, business_date, value1, value2 FROM prev
            WHERE found IS NULL OR value1 IS DISTINCT FROM prev_value1)"""


@query(f"WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE}, {ASOF_CTE} "
       "SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2 FROM changed")
def history_asof(spark, sf):
    df = H.changed_asof(source(spark, sf), target(spark, sf), KEYS, DATE, ["value1"])
    return _text_dates(df.drop("inserted_time"))


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE},
points AS (SELECT id, business_date, value1, value2, FALSE AS fresh FROM tgt
           UNION ALL SELECT id, business_date, value1, value2, TRUE FROM cand),
line AS (SELECT *, LAG(value1) OVER w AS before, ROW_NUMBER() OVER w AS place
         FROM points WINDOW w AS (PARTITION BY id ORDER BY business_date))
SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2
FROM line WHERE fresh AND (place = 1 OR value1 IS DISTINCT FROM before)""")
def history_asof_chain(spark, sf):
    """Late rows and rows of the batch itself: each is judged by what comes before it, of either."""
    df = H.changed_asof(source(spark, sf), target(spark, sf), KEYS, DATE, ["value1"], chain=True)
    return _text_dates(df.drop("inserted_time"))


@query(f"WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE}, {ASOF_CTE} "
       "SELECT COUNT(*) AS stamped, CAST(1 AS BIGINT) AS stamps FROM changed")
def history_inserted_time(spark, sf):
    """Each row to append has the time it is inserted, the same for all."""
    df = H.changed_asof(source(spark, sf), target(spark, sf), KEYS, DATE, ["value1"])
    return df.agg(F.count("inserted_time").alias("stamped"), F.countDistinct("inserted_time").alias("stamps"))


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE}, {LAST_CTE}
SELECT c.id, CAST(c.business_date AS VARCHAR) AS business_date, c.value1, c.value2
FROM cand c LEFT JOIN lk l ON l.id = c.id AND l.business_date < c.business_date
WHERE l.id IS NULL OR c.value1 IS DISTINCT FROM l.value1 OR c.value2 IS DISTINCT FROM l.value2""")
def history_last_known(spark, sf):
    history = _landed(target(spark, sf))
    newest = _landed(H.last_known(history, KEYS, DATE))
    df = H.changed_vs_last_known(source(spark, sf), history, KEYS, DATE, ["value1", "value2"], newest=newest)
    return _text_dates(df.drop("inserted_time"))


@query(f"""WITH {TARGET_CTE}, {SOURCE_CTE}, {CANDIDATES_CTE}, {ASOF_CTE}
SELECT id, CAST(business_date AS VARCHAR) AS business_date, value1, value2 FROM tgt
UNION ALL SELECT id, CAST(business_date AS VARCHAR), value1, value2 FROM changed""")
def insert_only_append(spark, sf):
    name = scratch_table(spark, "history")
    write_table(target(spark, sf), name)
    append_table(H.changed_asof(source(spark, sf), spark.table(name), KEYS, DATE, ["value1"], None), name)
    return _text_dates(spark.table(name))


# Full load: the history has every customer and order status, closed where the order was of low priority; the load
# of one day has every customer and line status with the priority of the newest such order.
PAIR, LOAD_DATE = ["id", "sub_id"], "2010-01-01"

OPEN_CTE = """
tgt AS (SELECT id, sub_id, business_date, value1,
               CASE WHEN value1 = '5-LOW' THEN business_date + 7 END AS valid_till FROM (
    SELECT o_custkey AS id, o_orderstatus AS sub_id, CAST(o_orderdate AS DATE) AS business_date,
           o_orderpriority AS value1,
           ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderstatus, CAST(o_orderdate AS DATE)
                              ORDER BY o_orderkey DESC) AS rn
    FROM orders) x WHERE rn = 1),
lk AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, sub_id ORDER BY business_date DESC) AS r
                      FROM tgt) y WHERE r = 1),
src AS (SELECT o_custkey AS id, l_linestatus AS sub_id, DATE '2010-01-01' AS business_date,
               arg_max(o_orderpriority, o_orderkey) AS value1
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_linestatus),
gone AS (SELECT l.id, l.sub_id, l.value1 FROM lk l WHERE l.valid_till IS NULL AND NOT EXISTS
    (SELECT 1 FROM src s WHERE s.id = l.id AND s.sub_id = l.sub_id))"""


def open_target(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderstatus").alias("sub_id"),
        day.alias(DATE),
        F.col("o_orderpriority").alias("value1"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_add(day, 7)).alias("valid_till"),
        "o_orderkey",
    )
    return first_per_key(orders, [*PAIR, DATE], [F.col("o_orderkey").desc()]).drop("o_orderkey")


def full_load(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return _landed(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("id"), F.col("l_linestatus").alias("sub_id"))
        .agg(F.max_by("o_orderpriority", "o_orderkey").alias("value1"))
        .withColumn(DATE, F.lit(LOAD_DATE).cast("date"))
    )


@query(f"WITH {OPEN_CTE} SELECT id, sub_id, '2010-01-01' AS business_date, value1, '2009-12-31' AS valid_till FROM gone")
def expired_keys(spark, sf):
    return _text_dates(H.expired_keys(full_load(spark, sf), open_target(spark, sf), PAIR, DATE, LOAD_DATE))


EXPIRY_SQL = f"""WITH {OPEN_CTE}
SELECT s.id, s.sub_id, '2010-01-01' AS business_date, s.value1, 'open' AS valid_till
FROM src s LEFT JOIN lk l ON l.id = s.id AND l.sub_id = s.sub_id
WHERE l.id IS NULL OR l.valid_till IS NOT NULL OR s.value1 IS DISTINCT FROM l.value1
UNION ALL SELECT id, sub_id, '2010-01-01', value1, '2009-12-31' FROM gone"""


@query(EXPIRY_SQL)
def history_expiry(spark, sf):
    df = H.changed_with_expiry(
        full_load(spark, sf), open_target(spark, sf), PAIR, DATE, ["value1"], LOAD_DATE
    ).drop("inserted_time")
    return _text_dates(df).withColumn("valid_till", F.coalesce("valid_till", F.lit("open")))


def _taken_in(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A history and its newest rows, as tables, with the full load taken in as load ``second``."""
    history, newest = scratch_table(spark, "history"), scratch_table(spark, "newest")
    past = _landed(open_target(spark, sf).select(*PAIR, DATE, "value1", "valid_till"))
    append_once(past, history, "first", [RUN])
    create_newest(past, newest, PAIR, DATE, buckets=16)
    load_full(full_load(spark, sf), history, newest, PAIR, DATE, ["value1"], LOAD_DATE, "second", inserted_col=None)
    return history, newest


@query(EXPIRY_SQL)
def history_expiry_incremental(spark, sf):
    """The same rows, from the newest row per key that is kept beside the history."""
    history, _ = _taken_in(spark, sf)
    df = _text_dates(spark.table(history).where(F.col(RUN) == "second").drop(RUN))
    return df.withColumn("valid_till", F.coalesce("valid_till", F.lit("open")))


@query(f"""WITH {OPEN_CTE},
points AS (SELECT id, sub_id, business_date, value1, valid_till FROM tgt
  UNION ALL SELECT s.id, s.sub_id, s.business_date, s.value1, NULL FROM src s LEFT JOIN lk l ON l.id = s.id AND l.sub_id = s.sub_id
  WHERE l.id IS NULL OR l.valid_till IS NOT NULL OR s.value1 IS DISTINCT FROM l.value1
  UNION ALL SELECT id, sub_id, DATE '2010-01-01', value1, DATE '2009-12-31' FROM gone)
SELECT id, sub_id, CAST(business_date AS VARCHAR) AS business_date, value1, COALESCE(CAST(CAST(valid_till AS DATE) AS VARCHAR), 'open') AS valid_till
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, sub_id ORDER BY business_date DESC) AS r FROM points) x WHERE r = 1""")
def history_newest_rows(spark, sf):
    """The newest row per key after that load."""
    _, newest = _taken_in(spark, sf)
    df = _text_dates(hashed_rows(spark, newest))
    return df.withColumn("valid_till", F.coalesce("valid_till", F.lit("open")))
