import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyport import session

    shared = tmp_path_factory.mktemp("shared")
    built = session.build(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=shared.as_uri(), spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
