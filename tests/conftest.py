import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from socigrain.session import build_session

    # the static settings first: the shared folder that steps are stored in
    SparkSession.builder.master("local[8]").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-")).config("spark.ui.enabled", "false").getOrCreate()
    s = build_session("tests", "local[8]", 4)
    s.sparkContext.setLogLevel("ERROR")
    return s
