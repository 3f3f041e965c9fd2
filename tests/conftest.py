import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfmatch.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to literal rows and return its values."""
    def apply(function, *rows, types="string"):
        width = len(rows[0])
        names = [f"c{i}" for i in range(width)]
        schema = ", ".join(f"{n} {types}" for n in names)
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
        out = df.select("i", function(*[df[n] for n in names]).alias("v")).collect()
        return [r["v"] for r in sorted(out, key=lambda r: r["i"])]

    return apply
