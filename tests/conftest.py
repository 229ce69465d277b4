import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from doseledger.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "doseledger-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.streaming.metricsEnabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="doseledger-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Six records of two medicines: one without cost, one with neither cost nor items."""
    rows = [
        ("2024-01-01", 150.0, 10, 300.0, "A01", "4", "03V", "metformin"),
        ("2024-01-01", 90.0, 6, 180.0, "A02", "4", "03V", "metformin"),
        ("2024-02-01", None, 5, 150.0, "A01", "4", "03V", "metformin"),
        ("2024-02-01", None, None, 60.0, "A03", "4", "15N", "metformin"),
        ("202403", 40.5, 3, 84.0, "A02", "4", "15N", "atorvastatin"),
        ("2024-03-01", 80.0, 0, 56.0, "A03", "4", "15N", "atorvastatin"),
    ]
    return spark.createDataFrame(
        rows,
        "date string, actual_cost double, items bigint, quantity double, row_id string, "
        "setting string, ccg string, drug string",
    )


def values(df, *columns):
    """Rows of chosen columns as a sorted list, NULL last."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
