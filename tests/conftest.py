import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from paylake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        "paylake-tests",
        **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"},
    )
    yield session
    session.stop()
