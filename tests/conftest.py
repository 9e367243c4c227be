import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from support import SMALL  # noqa: E402

from noteloom.plans.fixture_views import Fixture  # noqa: E402
from noteloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def small(spark):
    return Fixture(spark, SMALL)
