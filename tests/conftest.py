import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from faultline.session import session  # noqa: E402

TESTDATA = Path(os.environ.get("FAULTLINE_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return str(TESTDATA)


def run(start):
    """Let a stream read all there is."""
    start({"availableNow": True}).awaitTermination()
