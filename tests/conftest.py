import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tidewater-tests")
    checkpoint_dir(s)  # tests have no cluster-provided folder: a scratch one is registered
    yield s


def rows(df, order=None):
    """Collected rows as plain tuples (sorted for order-free comparison)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if order is None else out
