from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.schema import RAW_SCHEMA  # noqa: E402
from pricelake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="pricelake-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="pricelake-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricelake-test-")


def raw_frame(spark, rows):
    """Raw records from tuples in RAW_SCHEMA order."""
    return spark.createDataFrame(rows, RAW_SCHEMA)


def row(state="Punjab", district="d", market="m", commodity="Rice", variety="v", grade="FAQ",
        arrival_date="01/02/2020", min_price=10.0, max_price=20.0, modal_price=15.0):
    return (state, district, market, commodity, variety, grade, arrival_date, min_price, max_price, modal_price)
