import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

os.environ.setdefault("PII_SALT", "salt-of-the-tests")


@pytest.fixture(scope="session")
def spark():
    from lakehold import session
    s = session.build(master="local[*]", shuffle_partitions=8, app="lakehold-tests")
    yield s


@pytest.fixture()
def lake_root(tmp_path):
    return str(tmp_path / "lake")
