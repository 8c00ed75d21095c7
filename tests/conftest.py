import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def use(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield use
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
