import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gristmill.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("local[4]", 4)
    yield session
    session.stop()


@pytest.fixture(params=["adaptive", "plain"])
def plans(request, spark):
    """Runs the test twice: adaptive execution merges small partitions into one, without it seven stay apart."""
    names = {"spark.sql.adaptive.enabled": "true" if request.param == "adaptive" else "false", "spark.sql.shuffle.partitions": "4" if request.param == "adaptive" else "7"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def one(spark):
    """Value of a Column function over one text."""
    from pyspark.sql import functions as F

    def run(function, *texts):
        df = spark.createDataFrame([tuple(texts)], ", ".join(f"c{i} string" for i in range(len(texts))))
        return df.select(function(*[F.col(f"c{i}") for i in range(len(texts))]).alias("v")).collect()[0]["v"]

    return run


@pytest.fixture
def column(spark):
    """Values of a Column function over many texts, one job."""
    from pyspark.sql import functions as F

    def run(function, rows):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        width = len(rows[0])
        df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + ", ".join(f"c{i} string" for i in range(width)))
        got = df.select("k", function(*[F.col(f"c{i}") for i in range(width)]).alias("v")).collect()
        return [r["v"] for r in sorted(got, key=lambda r: r["k"])]

    return run
