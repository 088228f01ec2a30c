import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
