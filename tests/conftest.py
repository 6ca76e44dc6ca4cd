import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickerlens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tickerlens-test-ckpt-")
    s = build_session("local[4]", extra={"spark.checkpoint.dir": ckpt, "spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
