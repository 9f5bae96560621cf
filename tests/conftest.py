import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from curbcount import schemas  # noqa: E402
from curbcount.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make(spark):
    """Small tables: ``make(rows, ddl)``."""

    def build(rows, ddl=schemas.CAPTURE):
        return spark.createDataFrame(rows, schemas.resolve(ddl))

    return build


@pytest.fixture(scope="session")
def segments(make):
    return make(
        [
            (1, "Bronx", "A", "B", "C", 40.8, -73.9),
            (2, "Bronx", "D", "E", "F", 40.8, -73.9),
            (3, "Staten Island", "G", "H", "I", 40.6, -74.1),
        ],
        schemas.SEGMENT,
    )


def rows(df, *order):
    """Collected rows as plain tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
