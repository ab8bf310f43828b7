import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join(
    p for p in (ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH")) if p)

from foldmill.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (builder("foldmill-tests").master("local[8]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
