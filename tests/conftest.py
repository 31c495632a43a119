import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from telemill.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
