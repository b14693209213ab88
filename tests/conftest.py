import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import session

    work = tempfile.mkdtemp(prefix="millrace-tests-")
    s = session(
        "tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.path.join(work, "shared"),
            "spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
