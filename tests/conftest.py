import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from citeweave.session import local_session

    s = local_session(4, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
