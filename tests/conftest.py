import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def prices(spark):
    """Named series of closes, as bars of consecutive days."""
    from datetime import date, timedelta
    from decimal import Decimal

    def make(series: dict[str, list[float]]):
        rows = [
            (ticker, date(2020, 1, 1) + timedelta(days=i), Decimal(str(round(x, 4))), 100)
            for ticker, values in series.items()
            for i, x in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, "ticker string, trade_date date, close_price decimal(19,4), volume bigint"
        )

    return make
