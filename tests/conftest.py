import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fieldtrail-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from fieldtrail.session import configure

    yield configure(session)
    session.stop()


def rows(df, *order):
    """Rows as plain tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))
