"""Record-level checks of scoring requests: problems per record, valid and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide import schema
from roomtide.config import CostConfig
from roomtide.functions.columns import to_integer, truthy
from roomtide.operators.overbooking import with_capacity

PROBLEMS = "problems"
MAX_BATCH = 1000


@dataclass(frozen=True)
class Field:
    """One field of a request record."""

    kind: T.DataType
    required: bool = True
    default: object = None
    at_least: float | None = None
    at_most: float | None = None
    allowed: tuple | None = None


_INT, _TEXT, _REAL = T.IntegerType(), T.StringType(), T.DoubleType()

# The fields of a booking request, their limits and defaults.
BOOKING_FIELDS: dict[str, Field] = {
    "hotel": Field(_TEXT, allowed=tuple(schema.DOMAINS["hotel"])),
    "lead_time": Field(_INT, at_least=0),
    "arrival_date_year": Field(_INT, at_least=2000, at_most=2100),
    "arrival_date_month": Field(_TEXT, allowed=tuple(schema.MONTHS)),
    "arrival_date_week_number": Field(_INT, at_least=1, at_most=53),
    "arrival_date_day_of_month": Field(_INT, at_least=1, at_most=31),
    "stays_in_weekend_nights": Field(_INT, at_least=0),
    "stays_in_week_nights": Field(_INT, at_least=0),
    "adults": Field(_INT, at_least=0),
    "children": Field(_INT, required=False, default=0, at_least=0),
    "babies": Field(_INT, required=False, default=0, at_least=0),
    "meal": Field(_TEXT),
    "country": Field(_TEXT, required=False),
    "market_segment": Field(_TEXT),
    "distribution_channel": Field(_TEXT),
    "is_repeated_guest": Field(_INT, at_least=0, at_most=1),
    "previous_cancellations": Field(_INT, required=False, default=0, at_least=0),
    "previous_bookings_not_canceled": Field(_INT, required=False, default=0, at_least=0),
    "reserved_room_type": Field(_TEXT),
    "booking_changes": Field(_INT, required=False, default=0, at_least=0),
    "deposit_type": Field(_TEXT, allowed=tuple(schema.DOMAINS["deposit_type"])),
    "agent": Field(_INT, required=False),
    "company": Field(_INT, required=False),
    "days_in_waiting_list": Field(_INT, required=False, default=0, at_least=0),
    "customer_type": Field(_TEXT),
    "adr": Field(_REAL, at_least=0),
    "required_car_parking_spaces": Field(_INT, required=False, default=0, at_least=0),
    "total_of_special_requests": Field(_INT, required=False, default=0, at_least=0),
}

REQUEST_SCHEMA = T.StructType([T.StructField(name, f.kind) for name, f in BOOKING_FIELDS.items()])


def apply_defaults(df: DataFrame, fields: Mapping[str, Field] = BOOKING_FIELDS) -> DataFrame:
    """Every field of the record, with the default where an optional one is absent."""
    out = []
    for name, field in fields.items():
        value = F.col(name) if name in df.columns else F.lit(None)
        value = to_integer(value) if isinstance(field.kind, T.IntegerType) else value.try_cast(field.kind)
        if not field.required and field.default is not None:
            value = F.coalesce(value, F.lit(field.default))
        out.append(value.alias(name))
    others = [F.col(c) for c in df.columns if c not in fields]
    return df.select(*others, *out)


def _number(value: float) -> str:
    return f"{value:g}"


def find_problems(df: DataFrame, fields: Mapping[str, Field] = BOOKING_FIELDS, check_guests: bool = True) -> DataFrame:
    """Add ``problems``, an array of (field, message); it is empty for a valid record."""
    found: list[Column] = []

    def problem(name: str, bad: Column, message: str) -> None:
        entry = F.struct(F.lit(name).alias("field"), F.lit(message).alias("message"))
        found.append(F.when(truthy(bad), entry))

    for name, field in fields.items():
        if name not in df.columns:
            if field.required:
                problem(name, F.lit(True), "field required")
            continue
        value = F.col(name)
        if field.required:
            problem(name, value.isNull(), "field required")
        if isinstance(df.schema[name].dataType, T.StringType) and isinstance(field.kind, T.NumericType):
            whole = isinstance(field.kind, T.IntegralType)
            typed = to_integer(value) if whole else value.try_cast(field.kind)
            problem(name, value.isNotNull() & typed.isNull(), "must be a whole number" if whole else "must be a number")
            value = typed
        if field.at_least is not None:
            problem(name, value < field.at_least, f"must be at least {_number(field.at_least)}")
        if field.at_most is not None:
            problem(name, value > field.at_most, f"must be at most {_number(field.at_most)}")
        if field.allowed is not None:
            problem(name, value.isNotNull() & ~value.isin(list(field.allowed)), "not an allowed value")
    if check_guests and all(c in df.columns for c in schema.GUEST_COLUMNS):
        total = sum((F.coalesce(F.col(c), F.lit(0)) for c in schema.GUEST_COLUMNS), F.lit(0))
        problem("guests", total == 0, "no guests: adults, children and babies are all 0")
    return df.withColumn(PROBLEMS, F.array_compact(F.array(*found)))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(PROBLEMS) == 0).drop(PROBLEMS)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(PROBLEMS) > 0)


def problem_rows(checked: DataFrame, *keys: str) -> DataFrame:
    """One row per problem, for a quarantine table."""
    return checked.select(*keys, F.inline(PROBLEMS))


def check_requests(
    df: DataFrame,
    config: CostConfig,
    request: str = "request_id",
    capacities: DataFrame | None = None,
    max_batch: int = MAX_BATCH,
    hotels: Sequence[str] = BOOKING_FIELDS["hotel"].allowed,
) -> DataFrame:
    """Night requests as groups of booking rows: size, one known hotel, rooms taken, price and factor.

    ``request_hotel``, ``already_occupied`` and, where given, ``adr_ref`` and ``k`` repeat on
    every row of a request; without the last two the night's own values apply. A request
    without bookings has one row whose ``hotel`` is null. Counting combines map-side, so
    an oversized request is rejected without being gathered.
    """
    given = [name for name in ("adr_ref", "k") if name in df.columns]
    groups = df.groupBy(F.col(request).alias("request_id")).agg(
        F.count("hotel").alias("n_bookings"),
        F.count_if(truthy(F.col("hotel") != F.col("request_hotel"))).alias("n_other_hotel"),
        F.max("request_hotel").alias("hotel"),
        F.max("already_occupied").alias("already_occupied"),
        *[F.min(name).alias(name) for name in given],
    )
    rooms = with_capacity(groups, config, capacities)
    tests = [
        ("bookings", F.col("n_bookings") < 1, "at least one booking is required"),
        ("bookings", F.col("n_bookings") > max_batch, f"at most {max_batch} bookings are allowed"),
        ("hotel", F.col("n_other_hotel") > 0, "all bookings must be for the requested hotel"),
        ("hotel", ~F.col("hotel").isin(list(hotels)), "not an allowed value"),
        ("already_occupied", F.col("already_occupied").isNull(), "field required"),
        ("already_occupied", F.col("already_occupied") < 0, "must be at least 0"),
        ("already_occupied", F.col("already_occupied") > F.col("capacity"), "more than the rooms of the hotel"),
        *[(name, F.col(name) <= 0, "must be greater than 0") for name in given],
    ]
    entries = [
        F.when(truthy(bad), F.struct(F.lit(name).alias("field"), F.lit(text).alias("message"))) for name, bad, text in tests
    ]
    return rooms.withColumn(PROBLEMS, F.array_compact(F.array(*entries)))
