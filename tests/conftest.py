import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

from tidewell.session import build, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = configure(build("tests", cores="4", shuffle_partitions=4))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
