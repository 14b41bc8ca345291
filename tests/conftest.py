import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablewright.session import local_session

    folder = tmp_path_factory.mktemp("shared")
    session = local_session("tests", cores="8", **{
        "spark.checkpoint.dir": str(folder / "checkpoints"),
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def layers(spark, sf_dir):
    from tablewright.plans.layers import Layers

    return Layers(spark, sf_dir)
