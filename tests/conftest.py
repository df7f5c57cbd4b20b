import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("docferry-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={tmp_path_factory.mktemp('derby')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark, tmp_path):
    """Documents from a list of JSON lines, as one VARIANT column read from files."""
    from docferry.sources import read_json_documents

    def make(lines):
        path = tmp_path / f"docs{len(list(tmp_path.iterdir()))}"
        path.mkdir()
        for i, line in enumerate(lines):
            (path / f"part-{i:05d}.json").write_text(line + "\n")
        return read_json_documents(spark, str(path))

    return make
