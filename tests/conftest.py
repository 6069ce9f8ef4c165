import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests/llm")]
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from astroloom.session import build_session

    session = build_session("tests", cores=8, partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
