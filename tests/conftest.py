import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parent.parent, Path(__file__).resolve().parent):
    sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark():
    from kerbside.session import build_session

    session = build_session(
        "kerbside-tests",
        "local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
