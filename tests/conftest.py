import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dosewright.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
