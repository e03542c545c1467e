import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("loadkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_conf(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in saved.items():
        spark.conf.set(key, value)


def rows(df):
    """Rows as tuples, sorted, null first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
