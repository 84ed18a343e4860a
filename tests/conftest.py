import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roomtide import schema  # noqa: E402
from roomtide.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


BASE = {
    "hotel": "City Hotel", "is_canceled": 0, "lead_time": 10, "arrival_date_year": 2016, "arrival_date_month": "July",
    "arrival_date_week_number": 28, "arrival_date_day_of_month": 4, "stays_in_weekend_nights": 1, "stays_in_week_nights": 2,
    "adults": 2, "children": 0, "babies": 0, "meal": "BB", "country": "PRT", "market_segment": "Online TA",
    "distribution_channel": "TA/TO", "is_repeated_guest": 0, "previous_cancellations": 0,
    "previous_bookings_not_canceled": 0, "reserved_room_type": "A", "assigned_room_type": "A", "booking_changes": 0,
    "deposit_type": "No Deposit", "agent": 9, "company": None, "days_in_waiting_list": 0, "customer_type": "Transient",
    "adr": 100.0, "required_car_parking_spaces": 0, "total_of_special_requests": 1, "reservation_status": "Check-Out",
    "reservation_status_date": date(2016, 7, 7),
}


def booking(**changes):
    return {**BASE, **changes}


def three_bookings():
    return [
        booking(),
        booking(lead_time=20, arrival_date_month="August", arrival_date_day_of_month=15, adr=150.0),
        booking(lead_time=30, arrival_date_year=2017, arrival_date_month="January", arrival_date_day_of_month=10, adr=200.0),
    ]


@pytest.fixture(scope="session")
def make_raw(spark):
    """Raw bookings with ``seq``, the order of the list."""

    def build(rows):
        from pyspark.sql import types as T

        declared = T.StructType([T.StructField("seq", T.LongType()), *schema.RAW_SCHEMA.fields])
        return spark.createDataFrame([(i, *[r[c] for c in schema.RAW_COLUMNS]) for i, r in enumerate(rows)], declared)

    return build
