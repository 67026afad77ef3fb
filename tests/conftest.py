import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from panelwright.session import local_session, remove_run  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ["PYTHONPATH"] = str(Path(__file__).resolve().parent.parent)
    session = local_session("tests", "4", "6g")
    yield session
    remove_run(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
