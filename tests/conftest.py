from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from costlens.session import build_session

    session = build_session(
        "costlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def pairs_of(spark):
    """A forecast-actual frame from two lists, one day per entry."""

    def build(actual, predicted, segment="s", model="m"):
        import datetime as dt

        rows = [
            (segment, model, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(a), float(p))
            for i, (a, p) in enumerate(zip(actual, predicted))
        ]
        return spark.createDataFrame(rows, "segment string, model string, ds date, y double, yhat double")

    return build


@pytest.fixture(scope="session")
def series_of(spark):
    """A daily series from {segment: [values]}; None leaves the value null."""

    def build(values, start="2024-01-01"):
        import datetime as dt

        first = dt.date.fromisoformat(start)
        rows = [
            (segment, first + dt.timedelta(days=i), None if v is None else float(v))
            for segment, items in values.items()
            for i, v in enumerate(items)
        ]
        return spark.createDataFrame(rows, "segment string, ds date, y double")

    return build
