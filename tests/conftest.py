import os
import sys
from datetime import date, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from market_engine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from closes; open, high and low follow the close unless given."""

    def build(closes, ticker="T", start=date(2020, 1, 1), **other):
        rows = []
        for i, close in enumerate(closes):
            base = close if close is not None else 1.0
            row = {"open": base, "high": base, "low": base, "volume": 1.0}
            row.update({name: values[i] for name, values in other.items()})
            day = start + timedelta(days=i)
            rows.append((ticker, day, row["open"], row["high"], row["low"], close, row["volume"]))
        return spark.createDataFrame(
            rows, "ticker string, date date, open double, high double, low double, close double, volume double"
        )

    return build
