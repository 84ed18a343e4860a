"""Booking-shaped views over the star schema, so every operator can run on it.

``bookings`` is the narrow decision table, ``raw_bookings`` the full raw table.
Both are plain joins over whole tables and grow with them.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Properties for the decision by night: their number grows with the table, their size does not.
CUSTOMERS_OF_A_PROPERTY = 150
# Schemas by session and path: a session reads each footer once, another one anew.
_SCHEMAS: weakref.WeakKeyDictionary[SparkSession, dict[str, StructType]] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema. Its schema is read from the footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    known = _SCHEMAS.setdefault(spark, {})
    if path not in known:
        known[path] = spark.read.parquet(path).schema
    return spark.read.schema(known[path]).parquet(path)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation and region hold 25 and 5 rows at every scale, so broadcasting them is safe
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name"
    )


def _orders_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    places = F.broadcast(_places(spark, sf_dir))
    customer = customer.join(places, customer.c_nationkey == places.n_nationkey)
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    returned = F.count_if(F.col("l_returnflag") == "R").cast("int")
    return lines.agg(F.count("*").cast("int").alias("n_lines"), returned.alias("n_returned"))


def bookings(spark: SparkSession, sf_dir: str, stays: bool = True) -> DataFrame:
    """One booking per order. ``stays=False`` leaves out the join that gives the length of stay."""
    placed = _orders_with_place(spark, sf_dir)
    columns = [
        F.col("o_orderkey").alias("row_id"),
        F.col("r_name").alias("hotel"),
        F.concat(F.lit("P"), F.floor(F.col("o_custkey") / CUSTOMERS_OF_A_PROPERTY).cast("string")).alias("property"),
        F.col("o_orderdate").cast("date").alias("stay_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_canceled"),
        F.col("o_totalprice").alias("adr"),
        (F.col("o_orderkey") % 300).cast("int").alias("lead_time"),
        F.col("o_orderpriority").alias("deposit_type"),
        F.col("c_mktsegment").alias("segment"),
    ]
    if not stays:
        return placed.select(*columns)
    lines = _line_counts(spark, sf_dir)
    nights = F.greatest(F.lit(1), F.coalesce(F.col("n_lines"), F.lit(0))).alias("length_of_stay")
    return placed.join(lines, placed.o_orderkey == lines.l_orderkey, "left").select(*columns, nights)


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 32 raw booking columns and ``row_key``, derived from orders, customers and lines.

    Customers with a very low balance play the part of the records cleaning removes.
    """
    placed = _orders_with_place(spark, sf_dir)
    lines = _line_counts(spark, sf_dir)
    joined = placed.join(lines, placed.o_orderkey == lines.l_orderkey, "left")

    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    balance = F.col("c_acctbal")
    canceled = F.col("o_orderstatus") == "F"
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0))
    n_returned = F.coalesce(F.col("n_returned"), F.lit(0))
    no_guest = balance < -970

    def pick(number, names):
        chosen = F.lit(names[-1])
        for index, name in reversed(list(enumerate(names[:-1]))):
            chosen = F.when(number == index, name).otherwise(chosen)
        return chosen

    columns = {
        "hotel": F.when(F.col("n_regionkey") % 2 == 0, "City Hotel").otherwise("Resort Hotel"),
        "is_canceled": canceled.cast("int"),
        "lead_time": (key % 300).cast("int"),
        "arrival_date_year": F.year(day),
        "arrival_date_month": F.date_format(day, "MMMM"),
        "arrival_date_week_number": F.weekofyear(day),
        "arrival_date_day_of_month": F.dayofmonth(day),
        "stays_in_weekend_nights": n_returned,
        "stays_in_week_nights": n_lines - n_returned,
        "adults": F.when(no_guest, 0).otherwise((1 + key % 2).cast("int")),
        "children": F.when(key % 97 == 0, None).when(no_guest, 0).otherwise((key % 3).cast("int")),
        "babies": F.when(no_guest, 0).otherwise((key % 11 == 0).cast("int")),
        "meal": pick(key % 5, ["BB", "FB", "HB", "SC", "Undefined"]),
        "country": F.when(key % 89 != 0, F.substring("n_name", 1, 3)),
        "market_segment": F.col("c_mktsegment"),
        "distribution_channel": pick(key % 4, ["Direct", "Corporate", "TA/TO", "GDS"]),
        "is_repeated_guest": (key % 7 == 0).cast("int"),
        "previous_cancellations": (F.col("o_custkey") % 3).cast("int"),
        "previous_bookings_not_canceled": (F.col("o_custkey") % 5).cast("int"),
        "reserved_room_type": pick(F.col("o_custkey") % 3, ["A", "D", "E"]),
        "assigned_room_type": pick(key % 3, ["A", "D", "E"]),
        "booking_changes": (key % 2).cast("int"),
        "deposit_type": F.when(F.col("o_orderpriority") == "1-URGENT", "Non Refund")
        .when(F.col("o_orderpriority") == "5-LOW", "Refundable")
        .otherwise("No Deposit"),
        "agent": F.when(key % 13 != 0, (F.col("o_custkey") % 40).cast("int")),
        "company": F.when(key % 17 == 0, (F.col("o_custkey") % 25).cast("int")),
        "days_in_waiting_list": F.when(key % 29 == 0, (key % 60).cast("int")).otherwise(0),
        "customer_type": pick(F.col("o_custkey") % 4, ["Transient", "Contract", "Transient-Party", "Group"]),
        "adr": F.when((balance >= -970) & (balance < -960), -1.0).otherwise(F.lit(1.0)) * F.col("o_totalprice") / 100,
        "required_car_parking_spaces": (key % 19 == 0).cast("int"),
        "total_of_special_requests": (key % 6).cast("int"),
        "reservation_status": F.when(~canceled, "Check-Out").when(key % 10 == 0, "No-Show").otherwise("Canceled"),
        "reservation_status_date": day,
    }
    return joined.select(key.alias("row_key"), *[column.alias(name) for name, column in columns.items()])


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table with very many distinct scores: one row per order line."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_linestatus").alias("alias"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_extendedprice") / F.lit(105000.0)).alias("p"),
    )
