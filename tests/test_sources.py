import pytest

from loadkit.config import LoadConfig
from loadkit.functions.types import schema_from_config
from loadkit.sources import files, sql
from loadkit.sources.dated import DatedLayout, read_dated
from loadkit.sources.registry import read_source
from tests.conftest import rows


@pytest.mark.parametrize("path", ["a.csv", "a.CSV", "/x/y.csv", "b.txt", "b.tsv", "dir.csv/"])
def test_extension(path):
    files.check_extension(path, files.DELIMITED_EXTENSIONS)


@pytest.mark.parametrize("path", ["a.parquet", "csv", "a.csv.gz", "a"])
def test_extension_rejects(path):
    with pytest.raises(ValueError, match="invalid file extension"):
        files.check_extension(path, "csv")


@pytest.mark.parametrize("name, delimiter", [("a.csv", ","), ("a.txt", "|"), ("a.tsv", "\t")])
def test_delimited(spark, tmp_path, name, delimiter):
    path = tmp_path / name
    path.write_text(f"id{delimiter}name\n1{delimiter}Ann\n2{delimiter}Bob\n")
    schema = schema_from_config({"id": {"data_type": "int"}, "name": {}})
    assert rows(files.read_delimited(spark, str(path), schema, delimiter)) == [(1, "Ann"), (2, "Bob")]
    assert files.read_delimited(spark, str(path), delimiter=delimiter).dtypes == [("id", "int"), ("name", "string")]


def test_delimited_header_must_match(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("b,a\n1,2\n")
    schema = schema_from_config({"a": {"data_type": "int"}, "b": {"data_type": "int"}})
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, str(path), schema).collect()
    with pytest.raises(ValueError, match="header"):
        files.read_delimited(spark, str(path), schema, corrupt_column="_bad")


def test_delimited_corrupt_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,x\nno,y\n")
    schema = schema_from_config({"a": {"data_type": "int"}, "b": {}})
    assert rows(files.read_delimited(spark, str(path), schema, corrupt_column="_bad")) == [
        (None, "y", "no,y"),
        (1, "x", None),
    ]


def test_delimited_multi_line_and_quote(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,'two\nlines, one value'\n")
    df = files.read_delimited(spark, str(path), quote="'", multi_line=True)
    assert rows(df) == [(1, "two\nlines, one value")]


def test_dated(spark, tmp_path):
    layout = DatedLayout(f"{tmp_path}/", "ref/", "{year}/{month}/{day}/", "prefix_", "{year}{month}{day}", ".csv")
    assert layout.location("2024-01-02") == f"{tmp_path}/ref/2024/01/02/prefix_20240102.csv"
    for day in ("01", "02", "03"):
        folder = tmp_path / "ref/2024/01" / day
        folder.mkdir(parents=True)
        (folder / f"prefix_202401{day}.csv").write_text(f"d\n{int(day)}\n")
    reader = lambda paths: files.read_delimited(spark, paths)
    assert rows(read_dated(reader, layout, "2024-01-02")) == [(2,)]
    both = read_dated(reader, layout, ["2024-01-01", "2024-01-03"], "path")
    assert sorted((r.d, r.path[-12:]) for r in both.collect()) == [(1, "20240101.csv"), (3, "20240103.csv")]
    cfg = LoadConfig(
        run_date="2024-01-03",
        source_base_location=f"{tmp_path}/",
        source_reference_location="ref/",
        source_folder_date_pattern="{year}/{month}/{day}/",
        source_file_name_prefix="prefix_",
        source_file_name_date_pattern="{year}{month}{day}",
        source_file_extension=".csv",
        schema={"d": {"data_type": "int"}},
    )
    assert rows(read_source(spark, cfg)) == [(3,)]


def test_registry(spark):
    with pytest.raises(ValueError, match="unknown ingest type"):
        read_source(spark, LoadConfig(ingest_type="xml"))
    with pytest.raises(ValueError, match="source_table"):
        read_source(spark, LoadConfig(ingest_type="delta"))
    cfg = LoadConfig.from_layers({"ingest_type": "table", "sql_query": "SELECT {n} AS n", "n": 5})
    assert rows(read_source(spark, cfg)) == [(5,)]


def test_read_sql(spark):
    assert rows(sql.read_sql(spark, "SELECT {a} + :b AS s", {"a": 1}, {"b": 2})) == [(3,)]
    for text in ("SELECT {missing}", "SELECT * FROM no_such_table", "SELEC 1"):
        with pytest.raises(ValueError, match="source query"):
            sql.read_sql(spark, text, {})


@pytest.fixture
def guarded(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS guarded (a INT) USING parquet")
    yield
    spark.sql("DROP TABLE guarded")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("SELECT * FROM guarded", "SELECT"),
        ("-- note\nSELECT 'drop table', 1 AS deleted_at;", "SELECT"),
        ("WITH x AS (SELECT 1 a) SELECT * FROM x", "SELECT"),
        ("SELECT 1 UNION ALL SELECT 2", "SELECT"),
        ("INSERT INTO guarded VALUES (1)", "INSERT"),
        ("WITH x AS (SELECT 1 a) INSERT INTO guarded SELECT * FROM x", "INSERT"),
        ("CREATE TABLE other AS SELECT 1 a", "CREATE"),
        ("CREATE OR REPLACE TEMP VIEW v AS SELECT 1 a", "CREATE"),
        ("MERGE INTO elsewhere t USING guarded s ON t.a = s.a WHEN MATCHED THEN DELETE", "MERGE"),
        ("UPDATE elsewhere SET a = 1", "UPDATE"),
    ],
)
def test_statement_class(spark, guarded, text, expected):
    assert sql.statement_class(spark, text) == expected


@pytest.mark.parametrize(
    "text, message",
    [
        ("DELETE FROM guarded", "Disallowed"),
        ("DROP TABLE guarded", "Disallowed"),
        ("TRUNCATE TABLE guarded", "Disallowed"),
        ("ALTER TABLE guarded ADD COLUMNS (b INT)", "Disallowed"),
        ("SET a = b", "Disallowed"),
        ("SHOW TABLES", "Disallowed"),
        ("ALTER TABLE guarded", "Failed to parse SQL"),
        ("", "Failed to parse SQL"),
        ("SELEC 1", "Failed to parse SQL"),
        ("SELECT 1; DROP TABLE guarded", "Failed to parse SQL"),
        ("UPDATE guarded SET a = 1", "not supported"),
    ],
)
def test_statement_class_rejects(spark, guarded, text, message):
    with pytest.raises(ValueError, match=message):
        sql.statement_class(spark, text)
    assert spark.catalog.tableExists("guarded")


def test_sql_file(spark, tmp_path, guarded):
    path = tmp_path / "q.sql"
    path.write_text("-- two lines\nSELECT {n} AS n;\n")
    assert rows(sql.read_sql_file(spark, str(path), {"n": 3})) == [(3,)]
    path.write_text("INSERT INTO guarded VALUES (9)")
    assert sql.read_sql_file(spark, str(path)) is None
    assert rows(spark.table("guarded")) == [(9,)]
    with pytest.raises(ValueError, match="extension"):
        sql.read_sql_file(spark, str(tmp_path / "q.txt"))


def test_sql_on_frame(spark):
    df = spark.range(4)
    assert rows(sql.sql_on(df, "SELECT SUM(id) FROM {source_data}")) == [(6,)]
    assert not spark.catalog.listTables() or all("source_data" not in t.name for t in spark.catalog.listTables())


def test_headers_of_every_file_are_checked(spark, tmp_path):
    folder = tmp_path / "mixed.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,10\n")
    schema = schema_from_config({"id": {"data_type": "int"}, "v": {"data_type": "int"}})
    assert files.read_delimited(spark, str(folder), schema, corrupt_column="raw").count() == 1
    for header in ("v,id", "id", "id,v,w", '"v",id'):
        (folder / "b.csv").write_text(f"{header}\n2,20\n")
        for corrupt in (None, "raw"):
            with pytest.raises(Exception, match="(?i)header|number of columns"):
                files.read_delimited(spark, str(folder), schema, corrupt_column=corrupt).collect()
    (folder / "b.csv").write_text('"id",v\n2,x\n3,30\n4\n5,50,500\n')
    got = files.read_delimited(spark, str(folder), schema, corrupt_column="raw").cache()
    assert {r.raw for r in got.collect()} == {None, "2,x", "4", "5,50,500"}
    assert {(r.id, r.v) for r in got.where("raw is null").collect()} == {(1, 10), (3, 30)}


def test_values_that_do_not_parse(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id\noops\n")
    schema = schema_from_config({"id": {"data_type": "int"}})
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_delimited(spark, str(path), schema).collect()
    assert [tuple(r) for r in files.read_delimited(spark, str(path), schema, unparsed="null").collect()] == [(None,)]
    with pytest.raises(ValueError, match="unparsed"):
        files.read_delimited(spark, str(path), schema, unparsed="skip")


@pytest.mark.parametrize(
    "text",
    [
        "SELECT 1 AS a; -- done",
        "-- first\nSELECT 1 AS a /* ; */ ;",
        "VALUES (1), (2)",
        "WITH x AS (SELECT 1 AS a) SELECT a FROM x ORDER BY a LIMIT 1;",
        "(SELECT 1) UNION (SELECT 2)",
        "SELECT a, count(*) FROM VALUES (1) t(a) GROUP BY a HAVING count(*) > 0",
        "FROM VALUES (1) t(a) SELECT a",
    ],
)
def test_guard_takes_queries(spark, text):
    assert sql.statement_class(spark, text) == "SELECT"


@pytest.mark.parametrize(
    "text", ["INSERT OVERWRITE DIRECTORY '/tmp/nowhere' USING csv SELECT 1", "SET a = 1", "DROP TABLE x", "SHOW TABLES", "SELECT 1; SELECT 2"]
)
def test_guard_refuses(spark, text):
    with pytest.raises(ValueError, match="Disallowed|parse|supported"):
        sql.statement_class(spark, text)


def test_a_folder_of_sql_files_is_not_one_statement(spark, tmp_path):
    folder = tmp_path / "many.sql"
    folder.mkdir()
    for name in "ab":
        (folder / f"{name}.sql").write_text("SELECT 1")
    with pytest.raises(ValueError, match="one SQL file"):
        sql.read_sql_file(spark, str(folder))
