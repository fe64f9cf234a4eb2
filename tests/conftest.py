import os
import shutil
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from lakeward.session import build_session
    s = build_session(app="lakeward-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def copy_raw(run: str, dest_root: str) -> None:
    """Drop a fixture run's raw files into ``dest_root/raw`` (new files for a stream)."""
    src = os.path.join(FIXTURES, run, "raw")
    for folder in os.listdir(src):
        os.makedirs(os.path.join(dest_root, "raw", folder), exist_ok=True)
        for f in os.listdir(os.path.join(src, folder)):
            shutil.copy(os.path.join(src, folder, f), os.path.join(dest_root, "raw", folder, f))


def rows(df, *cols, order=None):
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
