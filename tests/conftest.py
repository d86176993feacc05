import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stallwise import schema  # noqa: E402
from stallwise.fixed_values import RAW_NAMES  # noqa: E402
from stallwise.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions=4,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


USUAL = {
    "restaurant_name": "Cafe",
    "cuisine": "Thai",
    "rating_raw": "4.2",
    "rating_count_raw": "100+ ratings",
    "cost_for_two_raw": "₹250 for two",
    "offer_count": 1.0,
    "offer_name_raw": "10% off",
    "area": "Centre",
    "pure_veg_raw": "No",
    "location": "Pune",
}


@pytest.fixture
def raw(spark):
    """Raw rows: usual values, changed by the given ones (working names)."""

    def build(*changes):
        back = {new: old for old, new in RAW_NAMES.items()}
        rows = [{back[k]: v for k, v in (USUAL | change).items()} for change in changes]
        return spark.createDataFrame([tuple(r[n] for n in schema.RAW.names) for r in rows], schema.RAW)

    return build


CLEAN_USUAL = {
    "restaurant_name": "Cafe",
    "location": "Pune",
    "area": "Centre",
    "cuisine": "Thai",
    "primary_cuisine": "Thai",
    "cuisine_count": 1,
    "rating": 4.2,
    "rating_status": "Rated",
    "rating_count": 100.0,
    "cost_for_two": 250,
    "is_pure_veg": False,
    "offer_count": 1,
    "offer_name": "10% off",
}


@pytest.fixture
def clean(spark):
    """Clean rows: usual values, changed by the given ones."""

    def build(*changes):
        rows = [CLEAN_USUAL | change for change in changes]
        return spark.createDataFrame([tuple(r[n] for n in schema.CLEAN.names) for r in rows], schema.CLEAN)

    return build
