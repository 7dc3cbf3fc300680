import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import test_session as make_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return make_session("8")


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def model(spark):
    from checks.fixtures import Model

    return Model(spark, SF)
