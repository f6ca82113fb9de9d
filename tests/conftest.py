from __future__ import annotations

import pytest

from tripmill.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame; nulls first."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()),
                      key=lambda t: [(v is not None, str(type(v)), v) if not isinstance(v, dict)
                                     else (True, "", "") for v in t])
    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df) -> list[str]:
    """Filter lines of every scan of the plan, in full."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [line for line in text.splitlines()
            if line.startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))]
