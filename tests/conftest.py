import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowatlas.operators import skew  # noqa: E402
from flowatlas.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "flowatlas-tests", "local[4]", 2,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["broadcast", "shuffled"])
def layout(request, monkeypatch):
    """Run a test with the small-data joins and with everything shuffled and hot keys split."""
    if request.param == "shuffled":
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(skew, "ROWS_PER_PART", 3)
    return request.param
