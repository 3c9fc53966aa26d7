import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlens.session import get_session  # noqa: E402

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "postlens-tests",
        master="local[8]",
        ui_enabled="false",
        ui_showConsoleProgress="false",
        sql_shuffle_partitions="8",
        sql_session_timeZone="UTC",
        driver_memory="8g",
        checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_posts(spark):
    """Posts from tuples (id, title, date, text, label as text)."""
    from postlens.operators import clean_posts
    from postlens.schema import RAW_POSTS

    def make(*rows):
        raw = spark.createDataFrame([(i, t, d, x, "", l) for i, t, d, x, l in rows], RAW_POSTS)
        return clean_posts(raw)

    return make


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
