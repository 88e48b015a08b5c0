from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quartermet.session import local_session

    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = local_session(8, 8, **{"spark.checkpoint.dir": str(checkpoints)})
    yield session
    session.stop()
