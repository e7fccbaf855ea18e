import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattlane.session import build_session  # noqa: E402

# The tables of the tests are tiny: compiling each query costs more than interpreting it.
QUICK = {
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    "spark.driver.memory": "6g",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, **QUICK)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
