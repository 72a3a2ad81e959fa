from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from talkatlas.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "talkatlas-tests", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TALKATLAS_SF_DIR", "/root/testdata/sf0.001")
