import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from contractflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(folder / "checkpoints"), "spark.sql.warehouse.dir": str(folder / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tables(spark, tmp_path):
    from contractflow.sinks.tables import Tables

    return Tables(spark, str(tmp_path / "lake"))
