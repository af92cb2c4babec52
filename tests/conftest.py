import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lumentab.operators import distance, order  # noqa: E402
from lumentab.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "lumentab-tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(params=["whole", "cut"])
def path(request, monkeypatch):
    """Run a test on the small-table path and on the cut path that large tables take."""
    if request.param == "cut":
        monkeypatch.setattr(order, "SMALL_ROWS", 0)
        monkeypatch.setattr(order, "SAMPLE_STEP", 1)
        monkeypatch.setattr(order, "MIN_CUTS", 8)
    return request.param


@pytest.fixture
def salted(monkeypatch):
    """Treat nearly every grid cell as hot."""
    monkeypatch.setattr(distance, "HOT_CELL", 3)
