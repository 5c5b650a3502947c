import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(ROOT, "tests", "data")


@pytest.fixture(scope="session")
def spark():
    from logweave.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lines_of(spark):
    """Build a lines(file, line_num, line) DataFrame from {file: text}."""
    def make(files: dict[str, str]):
        rows = []
        for f, text in files.items():
            for i, line in enumerate(text.split("\n"), start=1):
                rows.append((f, i, line))
        return spark.createDataFrame(rows, "file string, line_num bigint, line string")
    return make
