import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tickloom-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns ordered by the first ones, as tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.orderBy(*(cols or sel.columns)).collect()]
