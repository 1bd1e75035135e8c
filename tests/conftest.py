import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
# Python workers import the library too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tickloom.session import local_session

    session = local_session("4", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
