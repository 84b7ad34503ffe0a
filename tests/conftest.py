import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from versus.session import get_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "versus-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not here")
    return DATA


@pytest.fixture
def triples(spark):
    def make(rows):
        data = [(i, *[s.split() for s in row]) for i, row in enumerate(rows)]
        return spark.createDataFrame(
            data, "id bigint, h1 array<string>, h2 array<string>, ref array<string>"
        )

    return make
