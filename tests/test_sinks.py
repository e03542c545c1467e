import time

import pytest

from loadkit import session
from loadkit.session import scratch_table
from loadkit.sinks import tables as sinks
from tests.conftest import rows


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")


@pytest.fixture
def table(spark, df):
    name = scratch_table(spark, "t")
    df.write.saveAsTable(name)
    return name


def test_counted(df):
    seen, observation = sinks.counted(df)
    seen.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 2}


def test_append(spark, df, table):
    assert sinks.append_table(df.select("v", "id"), table) == 2
    assert rows(spark.table(table)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert sinks.append_table(df, table, dry_run=True) == 2
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError, match="not found"):
        sinks.append_table(df, "spark_catalog.default.nowhere")


def test_write_creates_appends_overwrites(spark, df):
    name = scratch_table(spark, "w")
    assert sinks.write_table(df, name, dry_run=True) == 2
    assert not spark.catalog.tableExists(name)
    assert sinks.write_table(df, name) == 2
    assert sinks.write_table(df, name) == 2
    assert spark.table(name).count() == 4
    assert sinks.write_table(spark.table(name).where("id = 1"), name, "overwrite") == 2
    assert rows(spark.table(name)) == [(1, "a"), (1, "a")]
    leftovers = [t.name for t in spark.catalog.listTables(name.split(".")[1]) if t.name.startswith(name.split(".")[2] + "__")]
    assert leftovers == []


def test_overwrite_that_fails_keeps_the_table(spark, df, table):
    broken = spark.table(table).selectExpr("id", "raise_error('broken') AS v")
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken.selectExpr("id", "CAST(v AS string) AS v"), table)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]


def test_partitioned(spark, df):
    name = scratch_table(spark, "p")
    sinks.write_table(df, name, partition_by=["v"])
    assert sinks.partition_columns(spark, name) == ["v"]
    sinks.write_table(df, name, partition_by=["v"])
    assert spark.table(name).count() == 4
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.write_table(df, name, partition_by=["id"])
    assert sinks.append_table(df, name) == 2
    sinks.write_table(spark.table(name).where("id = 2"), name, "overwrite")
    assert rows(spark.table(name)) == [(2, "b")] * 3
    plain = scratch_table(spark, "p")
    sinks.write_table(df, plain, partition_by="v")
    assert sinks.partition_columns(spark, plain) == []


def test_evolving(spark, df):
    name = scratch_table(spark, "e")
    sinks.append_evolving(df, name)
    sinks.append_evolving(spark.createDataFrame([("z", 1.5)], "v string, extra double"), name)
    assert sinks.append_evolving(df, name, dry_run=True) == 2
    assert rows(spark.table(name).select("id", "v", "extra")) == [(None, "z", 1.5), (1, "a", None), (2, "b", None)]


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Plain:
        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(name, default)

    assert session.shared_dir(Plain) == "hdfs://store/warehouse"


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_table_keeps_what_it_is(spark, df, partitioned):
    """Format, comments and properties outlive appends, replacements and merges."""
    name = scratch_table(spark, "orc")
    parts = "PARTITIONED BY (v)" if partitioned else ""
    spark.sql(f"CREATE TABLE {name} (id INT COMMENT 'the key', v STRING) USING orc {parts} COMMENT 'it''s kept' TBLPROPERTIES ('team' = 'ops')")
    sinks.append_table(df, name)
    sinks.append_evolving(df.select("v", "id"), name)
    sinks.write_table(spark.table(name).where("id = 2"), name, "overwrite")
    new = spark.createDataFrame([(2, "z"), (3, "b")], df.schema)
    sinks.merge_into(new, name, ["id"], ["v"])
    assert rows(spark.table(name)) == [(2, "z"), (2, "z"), (3, "b")]
    details = sinks._details(spark, name)
    assert (details["Provider"].lower(), details["Comment"]) == ("orc", "it's kept")
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["team"] == "ops"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["id"] == "the key"
    assert sinks.partition_columns(spark, name) == (["v"] if partitioned else [])


def test_overwrite_with_other_columns_keeps_the_format(spark, df):
    name = scratch_table(spark, "orc")
    spark.sql(f"CREATE TABLE {name} (id INT) USING orc COMMENT 'kept'")
    assert sinks.write_table(df, name, "overwrite") == 2
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert sinks._details(spark, name)["Provider"].lower() == "orc" and sinks._details(spark, name)["Comment"] == "kept"


def test_modes(spark, df, table):
    assert sinks.write_table(df, table, "ignore") == 0
    assert sinks.write_table(df, scratch_table(spark, "new"), "ignore") == 2
    with pytest.raises(ValueError, match="exists"):
        sinks.write_table(df, table, "errorifexists")
    with pytest.raises(ValueError, match="mode must be"):
        sinks.write_table(df, table, "upsert")
    with pytest.raises(ValueError, match="has columns"):
        sinks.append_table(df.withColumnRenamed("v", "w"), table)
    assert spark.table(table).count() == 2


def test_two_replacements_at_once(spark, df, table, monkeypatch):
    """The second to end finds that the table it read is gone, and leaves the first one's rows."""
    inner = sinks._describe_alike

    def meanwhile(session, staged, like):
        monkeypatch.setattr(sinks, "_describe_alike", inner)
        sinks.replace_table(df.where("id = 1"), table)
        inner(session, staged, like)

    monkeypatch.setattr(sinks, "_describe_alike", meanwhile)
    before = sinks._identity(spark, table)
    time.sleep(1.1)  # the catalog counts in seconds
    with pytest.raises(RuntimeError, match="another run"):
        sinks.replace_table(df.where("id = 2"), table)
    assert sinks._identity(spark, table) != before
    assert rows(spark.table(table)) == [(1, "a")]


def test_partitioned_overwrite_from_itself(spark):
    """New, kept and vanished partition values all come out right, twice in a row."""
    name = scratch_table(spark, "p")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c d/e")], "id int, v string")
    sinks.write_table(first, name, partition_by=["v"])
    for n in (1, 2):
        again = spark.table(name).where("id <> 2").selectExpr("id + 10 AS id", f"CASE WHEN v = 'a' THEN 'a{n}' ELSE v END AS v")
        sinks.write_table(again, name, "overwrite")
    assert rows(spark.table(name)) == [(21, "a1"), (23, "c d/e")]
    assert sinks.append_table(spark.createDataFrame([(9, "a1"), (8, "z")], first.schema), name) == 2
    assert rows(spark.table(name).where("v IN ('a1', 'z')")) == [(21, "a1"), (8, "z"), (9, "a1")]
    assert sinks.partition_columns(spark, name) == ["v"]
