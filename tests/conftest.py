import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (REPO, os.path.join(REPO, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

@pytest.fixture(scope="session")
def spark():
    from campanula.session import get_session

    s = get_session("local[*]", shuffle_partitions=8)
    yield s
