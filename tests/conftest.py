import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))
os.environ.setdefault("PYTHONPATH", "")
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ['PYTHONPATH']}"

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from perigee.session import get_session

    session = get_session(
        "perigee-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
