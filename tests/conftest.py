import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gridmart.session import build_session  # noqa: E402
from gridmart.sources.bronze import BRONZE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "gridmart-tests",
        "local[8]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def load_time(hour: int, minute: int = 0) -> datetime:
    return datetime(2026, 10, 5, hour, minute, tzinfo=timezone.utc)


@pytest.fixture
def log(spark):
    """Bronze DataFrame from ``(dataset, record, load time)`` rows."""

    def build(*rows):
        values = [
            (dataset, "full", record if isinstance(record, str) else json.dumps(record, ensure_ascii=False), loaded)
            for dataset, record, loaded in rows
        ]
        return spark.createDataFrame(values, BRONZE_SCHEMA)

    return build


@pytest.fixture
def plan(spark):
    """Text of the physical plan."""

    def text(df):
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
