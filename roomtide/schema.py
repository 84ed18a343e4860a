"""Booking table: columns, types, roles and value domains (the one source of truth)."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, order and domains of the booking table ------------

RAW_COLUMNS = [
    "hotel",
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_month",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "meal",
    "country",
    "market_segment",
    "distribution_channel",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "reserved_room_type",
    "assigned_room_type",
    "booking_changes",
    "deposit_type",
    "agent",
    "company",
    "days_in_waiting_list",
    "customer_type",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
    "reservation_status",
    "reservation_status_date",
]

STRING_COLUMNS = [
    "hotel",
    "arrival_date_month",
    "meal",
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "assigned_room_type",
    "deposit_type",
    "customer_type",
    "reservation_status",
]

NUMERIC_CHECKED_COLUMNS = [
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
]

BINARY_COLUMNS = ["is_canceled", "is_repeated_guest"]

NON_NEGATIVE_COLUMNS = [
    "lead_time",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
]

OPTIONAL_MISSING_COLUMNS = ["children", "country", "agent", "company"]

GUEST_COLUMNS = ["adults", "children", "babies"]

MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]

YEARS = [2015, 2016, 2017]

DOMAINS = {
    "hotel": ["Resort Hotel", "City Hotel"],
    "meal": ["BB", "FB", "HB", "SC", "Undefined"],
    "market_segment": [
        "Direct",
        "Corporate",
        "Online TA",
        "Offline TA/TO",
        "Complementary",
        "Groups",
        "Undefined",
        "Aviation",
    ],
    "distribution_channel": ["Direct", "Corporate", "TA/TO", "Undefined", "GDS"],
    "deposit_type": ["No Deposit", "Refundable", "Non Refund"],
    "customer_type": ["Transient", "Contract", "Transient-Party", "Group"],
    "reservation_status": ["Check-Out", "Canceled", "No-Show"],
}

UPPER_BOUNDS = {
    "arrival_date_week_number": 53,
    "arrival_date_day_of_month": 31,
    "adr": 6000,
}
LOWER_BOUNDS = {"arrival_date_week_number": 1, "arrival_date_day_of_month": 1}

DERIVED_COLUMNS = ["row_id", "is_duplicate", "arrival_date", "booking_date"]

TARGET = "is_canceled"
LEAKAGE_COLUMNS = [
    "reservation_status",
    "reservation_status_date",
    "assigned_room_type",
    "booking_changes",
    "required_car_parking_spaces",
    "total_of_special_requests",
]
EXCLUDED_FEATURES = ["arrival_date_year"]
TEAM_DECISION_COLUMNS = ["days_in_waiting_list", "adr"]

NUMERIC_FEATURES = [
    "lead_time",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "days_in_waiting_list",
    "adr",
]
CATEGORICAL_FEATURES = [
    "hotel",
    "arrival_date_month",
    "meal",
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "deposit_type",
    "agent",
    "company",
    "customer_type",
    "country_missing",
    "agent_missing",
    "company_missing",
    "children_missing",
]

DRIFT_FEATURES = [
    "lead_time",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "booking_changes",
    "days_in_waiting_list",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
]

# Texts a delimited file may use for "no value" (the usual dataframe-reader set).
# The column that keeps unreadable records of a text file; never part of the data.
CORRUPT = "_corrupt_record"

NA_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

SPLITS = ["train", "validation", "test", "production"]

# --- Types ------------------------------------------------------------------


def column_type(name: str) -> T.DataType:
    """Spark type of one raw booking column."""
    if name in STRING_COLUMNS:
        return T.StringType()
    if name == "adr":
        return T.DoubleType()
    if name == "reservation_status_date":
        return T.DateType()
    return T.IntegerType()


RAW_SCHEMA = T.StructType([T.StructField(c, column_type(c)) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType())]
    + list(RAW_SCHEMA.fields)
    + [
        T.StructField("is_duplicate", T.BooleanType()),
        T.StructField("arrival_date", T.DateType()),
        T.StructField("booking_date", T.DateType()),
    ]
)
