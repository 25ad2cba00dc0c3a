"""One local session for all tests, with a checkpoint folder of its own."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, app="tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return str(DATA / "sf0.001")
