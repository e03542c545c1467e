"""Change capture against worked examples, known counts and brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadkit.operators import history as H
from loadkit.operators.shape import dedup_latest
from tests.conftest import DATA, plan, rows

KEYS = ["id"]


def day(n):
    return date(2025, 1, 1) + timedelta(n - 1)


def test_late_rows_are_judged_by_the_row_before_them(spark):
    schema = "tank string, business_date date, level int"
    target = spark.createDataFrame([("north", day(3), 40), ("north", day(8), 55), ("south", day(5), 40)], schema)
    batch = spark.createDataFrame(
        [
            ("north", day(1), 40),  # before all: new
            ("north", day(5), 40),  # as on the third: no change
            ("north", day(6), 55),  # a change, though the eighth says the same
            ("north", day(8), 99),  # a day the history has
            ("south", day(4), 40),
            ("east", day(4), 40),
        ],
        schema,
    )
    new = H.changed_asof(batch, target, ["tank"], "business_date", ["level"])
    assert new.columns == ["tank", "business_date", "level", "inserted_time"]
    assert rows(new.select("tank", "business_date")) == [
        ("east", day(4)), ("north", day(1)), ("north", day(6)), ("south", day(4)),
    ]


def test_change_in_one_of_several_values(spark):
    schema = "site int, meter int, business_date date, unit string, reading double"
    target = spark.createDataFrame([(1, 1, day(9), "kWh", 2.5), (1, 2, day(9), None, 2.5)], schema)
    batch = spark.createDataFrame(
        [(1, 1, day(12), "kWh", 2.5), (1, 2, day(12), None, 2.5), (2, 1, day(12), "kWh", 2.5), (1, 1, day(13), "MWh", 2.5), (1, 2, day(13), None, None)],
        schema,
    )
    new = H.changed_vs_last_known(batch, target, ["site", "meter"], "business_date", ["unit", "reading"], None)
    assert rows(new) == [(1, 1, day(13), "MWh", 2.5), (1, 2, day(13), None, None), (2, 1, day(12), "kWh", 2.5)]


@pytest.fixture(scope="module")
def frames(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        F.col("o_orderstatus").alias("value1"),
        F.col("o_orderpriority").alias("value2"),
        "o_orderkey",
    )
    hist = dedup_latest(orders, ["id", "business_date"], [{"column": "o_orderkey", "direction": "desc"}])
    return hist.where("o_orderkey % 4 IN (0, 1)"), hist.where("o_orderkey % 4 <> 0")


def test_known_counts(frames):
    source, target = frames
    fresh = H.not_in_target(source, target, KEYS, "business_date")
    assert fresh.count() == 3739
    assert H.first_seen(fresh, target, KEYS, "business_date").count() == 465
    assert H.changed_asof(source, target, KEYS, "business_date", ["value1"]).count() == 2646
    assert H.changed_vs_last_known(source, target, KEYS, "business_date", ["value1", "value2"]).count() == 3709


def test_expiry_counts(spark):
    customers = spark.read.parquet(f"{DATA}/customer.parquet")
    target = customers.where("c_custkey % 5 <> 4").selectExpr(
        "c_custkey AS id", "c_nationkey AS sub_id", "DATE '1996-01-01' AS business_date", "c_mktsegment AS value1",
        "CAST(NULL AS date) AS valid_till",
    )
    source = customers.where("c_custkey % 10 <> 0").selectExpr(
        "c_custkey AS id", "c_nationkey AS sub_id", "DATE '1996-07-01' AS business_date",
        "CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS value1",
    )
    args = (["id", "sub_id"], "business_date", ["value1"])
    new = H.changed_with_expiry(source, target, *args, load_date="1996-07-01")
    counted = {r["valid_till"]: r["count"] for r in new.groupBy("valid_till").count().collect()}
    assert counted == {None: 450, date(1996, 6, 30): 150}
    appended = target.unionByName(new.drop("inserted_time"))
    assert H.changed_with_expiry(source, appended, *args, load_date="1996-07-01").isEmpty()


def test_closed_key_opens_again(spark):
    schema = "id int, business_date date, v string, valid_till date"
    target = spark.createDataFrame([(1, day(1), "a", None), (1, day(5), "a", day(4))], schema)
    source = spark.createDataFrame([(1, day(9), "a")], "id int, business_date date, v string")
    new = H.changed_with_expiry(source, target, KEYS, "business_date", ["v"], "2025-01-09", inserted_col=None)
    assert rows(new) == [(1, day(9), "a", None)]
    none_left = source.limit(0)
    assert rows(H.expired_keys(none_left, target, KEYS, "business_date", "2025-01-09")) == []


@pytest.mark.parametrize("changed", [H.changed_asof, H.changed_vs_last_known])
def test_second_run_adds_nothing(frames, changed):
    source, target = frames
    values = ["value1", "value2"]
    cols = ["id", "business_date", *values]
    source, target = source.select(cols), target.select(cols)
    new = changed(source, target, KEYS, "business_date", values, None)
    # Only rows that were in the first result can be asked again: the others differ from their neighbours now.
    assert changed(new, target.unionByName(new), KEYS, "business_date", values).isEmpty()


def _brute_asof(source, target):
    """For each source row: the target row of its key and date, and the latest before it."""
    out = []
    for key, when, value in source:
        same = [t for t in target if key is not None and t[0] == key and t[1] == when]
        before = [t for t in target if key is not None and t[0] == key and t[1] < when]
        out.append((key, when, value, bool(same), max(before, key=lambda t: t[1]) if before else None))
    return out


@pytest.mark.parametrize(
    "kind, seed", [("date", 1), *[(k, s) for k in ("timestamp", "timestamp_ntz") for s in (1, 2, 3)]]
)
def test_brute_force(spark, conf, kind, seed):
    if kind == "timestamp_ntz":
        # Clocks go forward on 9 March: two to three o'clock is missing there, but not from the data.
        conf(spark__sql__session__timeZone="America/New_York")
    rng = random.Random(seed)
    start = datetime(2025, 3, 8)

    def moment():
        when = start + timedelta(minutes=rng.randrange(0, 6000, 7))
        return when.date() if kind == "date" else when

    # One key holds most rows, some keys and values are null, and source rows repeat.
    def key():
        return rng.choice([7, 7, 7, 1, 2, None])

    target = list({(k, w): (k, w, rng.choice(["a", "b", None])) for k, w in ((key(), moment()) for _ in range(120))}.values())
    source = [(key(), moment(), rng.choice(["a", "b", None])) for _ in range(150)]
    schema = f"id int, at {kind}, v string"
    s, t = spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)
    expected = _brute_asof(source, target)

    def listed(values):
        return sorted(values, key=str)

    prev = H.asof_previous(s, t, KEYS, "at", ["v"])
    assert listed(tuple(r) for r in prev.collect()) == listed(
        (k, w, v, p and p[1], p and p[2]) for k, w, v, _, p in expected
    )
    fresh = H.not_in_target(s, t, KEYS, "at")
    assert listed(tuple(r) for r in fresh.collect()) == listed((k, w, v) for k, w, v, same, _ in expected if not same)
    seen = H.first_seen(s, t, KEYS, "at")
    assert listed(tuple(r) for r in seen.collect()) == listed((k, w, v) for k, w, v, _, p in expected if p is None)
    new = H.changed_asof(s, t, KEYS, "at", ["v"], None)
    assert listed(tuple(r) for r in new.collect()) == listed(
        (k, w, v) for k, w, v, same, p in expected if not same and (p is None or p[2] != v)
    )
    newest = {k: max((x for x in target if x[0] == k), key=lambda x: x[1]) for k in {x[0] for x in target}}
    last = {(k, w, v): newest.get(k) if k is not None and newest.get(k) and newest[k][1] < w else None for k, w, v in source}
    known = H.join_last_known(s, t, KEYS, "at", ["v"])
    assert listed(tuple(r) for r in known.collect()) == listed(
        (*row, last[row] and last[row][1], last[row] and last[row][2]) for row in source
    )
    changed = H.changed_vs_last_known(s, t, KEYS, "at", ["v"], None)
    assert listed(tuple(r) for r in changed.collect()) == listed(
        (k, w, v)
        for k, w, v, same, _ in expected
        if not same and (last[k, w, v] is None or last[k, w, v][2] != v)
    )


def test_rows_without_a_date_are_new(spark):
    target = spark.createDataFrame([(1, day(1), "a"), (1, None, "z")], "id int, at date, v string")
    source = spark.createDataFrame([(1, None, "a"), (1, day(2), "a")], target.schema)
    undated = [(1, None, "a")]
    assert rows(H.first_seen(source, target, KEYS, "at")) == undated
    assert rows(H.changed_asof(source, target, KEYS, "at", ["v"], None)) == undated
    assert rows(H.changed_vs_last_known(source, target, KEYS, "at", ["v"], None)) == undated


def test_load_older_than_an_open_row_closes_nothing(spark):
    schema = "id int, business_date date, v string, valid_till date"
    target = spark.createDataFrame([(1, day(10), "a", None), (2, day(3), "b", None)], schema)
    source = spark.createDataFrame([(3, day(5), "c")], "id int, business_date date, v string")
    args = (KEYS, "business_date", ["v"], "2025-01-05", "valid_till", None)
    new = H.changed_with_expiry(source, target, *args)
    assert rows(new) == [(2, day(5), "b", day(4)), (3, day(5), "c", None)]
    assert H.changed_with_expiry(source, target.unionByName(new), *args).isEmpty()


@pytest.mark.parametrize("operator", [H.changed_asof, H.asof_previous, H.changed_vs_last_known, H.join_last_known])
def test_small_batch_reads_its_own_keys_and_dates(spark, tmp_path, frames, operator):
    """Other keys leave the history at its scan, before any shuffle; so do dates after the batch where they don't matter."""
    source, target = frames
    path = str(tmp_path / "history")
    target.write.parquet(path)
    history = spark.read.parquet(path)
    batch = source.where("id < 20 and business_date < '1995-01-01'").select("id", "business_date", "value1")
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    found = operator(batch, history, KEYS, "business_date", ["value1"])
    expected = operator(batch, target, KEYS, "business_date", ["value1"])
    assert rows(found.drop("inserted_time")) == rows(expected.drop("inserted_time"))
    text = plan(found)
    scan = text.index("value1")
    assert "LeftSemi" in text and text.index("LeftSemi") < len(text) and scan >= 0
    if operator in (H.changed_asof, H.asof_previous):
        assert "LessThanOrEqual(business_date" in text or "business_date#" in text and "<= Subquery" in text.replace("scalar-subquery", "Subquery").replace("ReusedSubquery ", "")


def test_anti_join_reads_the_span_of_the_batch(spark, tmp_path, frames):
    source, target = frames
    path = str(tmp_path / "history")
    target.selectExpr("id", "trunc(business_date, 'year') AS business_date").distinct().write.partitionBy(
        "business_date"
    ).parquet(path)
    history = spark.read.parquet(path)
    batch = source.selectExpr("id", "DATE '1997-01-01' AS business_date").distinct()
    fresh = H.not_in_target(batch, history, KEYS, "business_date")
    known = {r.id for r in history.where("business_date = '1997-01-01'").collect()}
    assert {r.id for r in fresh.collect()} == {r.id for r in batch.collect()} - known
    assert "PartitionFilters: [isnotnull(business_date" in plan(fresh) and "Subquery" in plan(fresh)
    assert H.not_in_target(batch.limit(0), history, KEYS, "business_date").isEmpty()


def test_busy_hour_of_a_hot_key_is_spread(spark, conf):
    """Sixty thousand events of one key within an hour: no task has more than a small part of them."""
    conf(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    n = 60_000
    events = spark.range(0, n, 1, 8).selectExpr("1 AS id", "timestamp_millis(1700000000000 + id * 60) AS at", "CAST(id AS string) AS v")
    found = H.asof_previous(events, events, KEYS, "at", ["v"])
    windows = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sum(r["count"] for r in windows) == n and max(r["count"] for r in windows) < n / 4
    assert found.where("int(v) != int(prev_v) + 1").count() == 0 and found.where("prev_v is null").count() == 1


def test_dates_only(spark):
    df = spark.createDataFrame([(1, 20250101, "a")], "id int, at int, v string")
    with pytest.raises(ValueError, match="date or a timestamp"):
        H.asof_previous(df, df, KEYS, "at", ["v"])


def test_hot_key_is_split(spark, conf):
    """A key with a third of the rows is read by more than one join task, and the result stays whole."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    n = 60_000
    base = spark.range(0, n, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id",
        "DATE '2025-01-01' + CAST(id % 300 AS int) AS at",
        "sha(CAST(id AS string)) AS v",
    )
    target = base.groupBy("id", "at").agg(F.max("v").alias("v"))
    joined = H.join_last_known(base, target, KEYS, "at", ["v"])
    assert len(joined.collect()) == n
    assert "SortMergeJoin(skew=true)" in plan(joined)
    found = H.asof_previous(base, target, KEYS, "at", ["v"])
    assert len(found.collect()) == n
    assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)


def chained_by_hand(source, target):
    """Rows to append, walking each key's line of dates."""
    out = [r for r in source if r[0] is None or r[1] is None]
    for key in {r[0] for r in source if r[0] is not None}:
        own, have = {}, {}
        for k, d, v in source:
            if k == key and d is not None:
                own[d] = max(own.get(d, v), v, key=lambda x: (x is not None, x or ""))
        for k, d, v in target:
            if k == key and d is not None:
                have[d] = max(have.get(d, v), v, key=lambda x: (x is not None, x or ""))
        line, before = sorted({*own, *have}), None
        for d in line:
            if d in have:
                before = (have[d],)
            elif before != (own[d],):
                out.append((key, d, own[d]))
                before = (own[d],)
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_chain_against_brute_force(spark, kind):
    """Late rows, equal rows, several rows of a date, nulls; a second load adds nothing."""
    rng = random.Random(kind)

    def some(n):
        return [(rng.choice([1, 2, 3, None]), rng.choice([*(f"2024-01-{d:02d}" for d in range(1, 20)), None]), rng.choice(["a", "b", None])) for _ in range(n)]

    def frame(data):
        return spark.createDataFrame(data, "id int, day string, value string").withColumn("day", F.col("day").cast(kind))

    shown = lambda df: sorted(((r.id, r.day and str(r.day)[:10], r.value) for r in df.collect()), key=repr)
    for n in (0, 3, 40):
        source, target = some(60), some(n)
        got = shown(H.changed_asof(frame(source), frame(target), ["id"], "day", ["value"], chain=True))
        assert got == chained_by_hand(source, target)
        again = shown(H.changed_asof(frame(source), frame(target + got), ["id"], "day", ["value"], chain=True))
        assert [r for r in again if r[0] is not None and r[1] is not None] == []


def test_kept_newest_rows_give_the_same(frames):
    source, target = frames[:2]
    values = [c for c in ("value1", "value2") if c in source.columns]
    want = H.changed_vs_last_known(source, target, KEYS, "business_date", values, None)
    newest = H.last_known(target, KEYS, "business_date")
    got = H.changed_vs_last_known(source, target, KEYS, "business_date", values, None, newest=newest)
    assert rows(got) == rows(want) and got.count() > 0


def test_chain_keeps_the_batch_as_it_is(spark):
    """Other columns and the batch's own types, where the history's are wider."""
    source = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-02', '7', map('a', 1)), (1, DATE'2024-01-03', '7', map('b', 2)), (null, null, '9', null) AS t(id, day, value, extra)")
    target = spark.sql("SELECT * FROM VALUES (1L, DATE'2024-01-01', 7), (1L, DATE'2024-01-04', 9) AS t(id, day, value)")
    new = H.changed_asof(source, target.where("value = 9"), ["id"], "day", ["value"], None, chain=True)
    assert new.schema.simpleString() == source.schema.simpleString()
    assert sorted(((r.id, r.day and r.day.day, r.value, r.extra) for r in new.collect()), key=repr) == [(1, 2, "7", {"a": 1}), (None, None, "9", None)]
    assert [r.value for r in H.changed_asof(source, target, ["id"], "day", ["value"], None, chain=True).collect()] == ["9"]
