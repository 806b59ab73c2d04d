import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from churnkit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                      spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
                      spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
                      spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def shuffle_parts(spark):
    """Run a function under several shuffle partition counts and return the results."""
    def run(fn, counts=(1, 4, 16)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            out = []
            for n in counts:
                spark.conf.set("spark.sql.shuffle.partitions", str(n))
                out.append(sorted(map(str, fn().collect())))
            return out
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    return run
