import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs, every plan run once: compiling stages costs more than it saves.
    session = local_session(
        "tests",
        cores="8",
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.codegen.wholeStage": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
