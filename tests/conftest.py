import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("minelake-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    from minelake.session import get_session

    s = get_session()
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
