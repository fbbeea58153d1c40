import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from revscope.session import session

    warehouse = tmp_path_factory.mktemp("warehouse")
    spark = session(
        "revscope-tests",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.memory": "4g",
        },
        master="local[4]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
