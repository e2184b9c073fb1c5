import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def hourly(spark, values, site="a", start="2024-01-01 00:00:00", step=1):
    """Series of one site, one row every ``step`` hours."""
    import pandas as pd
    times = pd.date_range(start, periods=len(values), freq=f"{step}h")
    rows = [(site, t.to_pydatetime(), None if v is None else float(v)) for t, v in zip(times, values)]
    return spark.createDataFrame(rows, "site STRING, ts TIMESTAMP_NTZ, value DOUBLE")


def column(df, name="value", order="ts"):
    return [r[name] for r in df.orderBy(order).collect()]
