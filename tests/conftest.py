from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shelfguard.session import build_session

    ckpt = tempfile.mkdtemp(prefix="shelfguard-test-ckpt-")
    session = build_session(
        app="shelfguard-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()
