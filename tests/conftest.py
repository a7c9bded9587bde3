import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from jobsight.session import build_session

    session = build_session("local[4]", 8, app_name="jobsight-tests")
    session.sparkContext.setLogLevel("ERROR")
    # Tests leave spark.checkpoint.dir as the session has it; when unset,
    # storage_root() creates a private folder.
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="jobsight-test-")


def rows(df, order=None):
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
