from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pacewise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "8",
        "pacewise-tests",
        spark__sql__warehouse__dir=str(warehouse),
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()
