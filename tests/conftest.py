import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnpanel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session(
        "local[*]", "churnpanel-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def inputs(spark, sf_dir):
    from churnpanel.sources.adapters import Inputs

    return Inputs(spark, sf_dir)
