from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallylake.session import local_session

    session = local_session(8, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path) -> str:
    return str(tmp_path / "lake")
