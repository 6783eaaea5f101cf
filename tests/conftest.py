from __future__ import annotations

import pytest

from parley.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "8", **{"spark.checkpoint.dir": f"file://{shared}"})
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """``frame(rows, schema)``, spread over several partitions."""
    def build(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return build
