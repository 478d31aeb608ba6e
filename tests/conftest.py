import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from postgauge.session import local_session

    # Workers must not find the package by standing in its folder.
    os.chdir(tmp_path_factory.mktemp("elsewhere"))
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def lexicon(spark):
    rows = [("hello", 2), ("don't", 1), ("sort", 1), ("integers", 3), ("java", 2)]
    return spark.createDataFrame(rows, "word string, syl int")
