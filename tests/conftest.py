import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def _named_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
