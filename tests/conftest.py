import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from martforge.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8, app_name="martforge-tests")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield spark


@pytest.fixture
def rows_of():
    def _rows(df, *cols):
        cols = cols or df.columns
        return sorted(tuple(r[c] for c in cols) for r in df.collect())

    return _rows
