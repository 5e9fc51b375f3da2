import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__extraJavaOptions=f"-Dderby.system.home={tmp_path_factory.mktemp('derby')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def products(spark):
    rows = [("Apple", "fruit", 1.5, 100), ("Banana", "fruit", 0.5, 200), ("Carrot", "veg", 0.8, 150),
            ("Steak", "meat", 15.0, 20), ("Milk", "dairy", 3.0, 80)]
    return spark.createDataFrame(rows, "name string, category string, price double, qty bigint")
