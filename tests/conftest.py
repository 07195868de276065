import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglathe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(
        8,
        **{"spark.checkpoint.dir": f"{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse"},
    )
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def parse_all(spark):
    """Parse a few lines and return ``[(status, fields as dict)]`` in order."""
    from loglathe.operators.parse import grok, parse_lines
    from loglathe.plans.formats import FORMATS, LogFormat

    def run(lines, fmt):
        df = spark.createDataFrame(list(enumerate(lines)), "n int, value string").coalesce(1)
        known = isinstance(fmt, LogFormat) or fmt in FORMATS
        parsed = parse_lines(df, fmt) if known else grok(df, fmt)
        return [(r["status"], r["fields"].asDict()) for r in parsed.orderBy("n").collect()]

    return run
