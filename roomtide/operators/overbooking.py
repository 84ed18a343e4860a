"""How many bookings to accept beyond capacity: policies, expected cost and the best level.

A night's decision only ever looks at the first ``capacity + o`` bookings, and ``o`` is at
most a share of the capacity. So a night is reduced to its *book*: an array of the first
bookings in acceptance order, no longer than the rooms of the hotel allow, however many
bookings the night has. Counts and averages still cover all bookings of the night.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.config import CostConfig
from roomtide.functions.columns import clipped, half_even, month_key
from roomtide.operators.ranking import top_rows

POLICIES = ["no_overbook", "fixed", "avg_rate", "model"]


def check_policies(names: Sequence[str]) -> list[str]:
    unknown = [name for name in names if name not in POLICIES]
    if unknown:
        raise ValueError(f"unknown policy: {', '.join(unknown)}")
    return list(names)


# --- Capacity, rates and the simple policies --------------------------------


def with_capacity(
    df: DataFrame, config: CostConfig, capacities: DataFrame | None = None, hotel: str = "hotel"
) -> DataFrame:
    """Add the hotel's room count: from a ``(hotel, capacity)`` table, else from the settings."""
    if capacities is None:
        if not config.capacity:
            return df.withColumn("capacity", F.lit(config.default_capacity))
        settings = [(name, int(count)) for name, count in config.capacity.items()]
        # the settings of the caller, a table of fixed size
        capacities = F.broadcast(df.sparkSession.createDataFrame(settings, "hotel string, capacity int"))
    known = capacities.select(F.col("hotel").alias(hotel), F.col("capacity").cast("int").alias("_capacity"))
    joined = df.join(known, hotel, "left")
    return joined.withColumn("capacity", F.coalesce("_capacity", F.lit(config.default_capacity))).drop("_capacity")


def monthly_rates(df: DataFrame, hotel: str = "hotel", day: str = "stay_date", label: str = "is_canceled") -> DataFrame:
    """Cancellation rate per hotel and month."""
    return df.groupBy(F.col(hotel).alias("hotel"), month_key(day).alias("month")).agg(F.avg(label).alias("rate"))


def with_rate(df: DataFrame, rates: DataFrame | None, config: CostConfig, day: str = "stay_date") -> DataFrame:
    """Add the month's rate, or the default rate where the lookup has none."""
    if rates is None:
        return df.withColumn("rate", F.lit(config.default_rate))
    months = rates.select("hotel", "month", F.col("rate").alias("_rate"))
    joined = df.withColumn("month", month_key(day)).join(months, ["hotel", "month"], "left")
    return joined.withColumn("rate", F.coalesce("_rate", F.lit(config.default_rate))).drop("_rate", "month")


def cost_empty(price_ref: Column) -> Column:
    return price_ref


def cost_overbook(price_ref: Column, k: Column) -> Column:
    return k * price_ref


def policy_level(
    policy: str, capacity: Column, rate: Column, config: CostConfig, model_level: Column | None = None
) -> Column:
    """Rooms to overbook under one policy; ties round to the even number."""
    check_policies([policy])
    if policy == "no_overbook":
        return F.lit(0)
    if policy == "fixed":
        return half_even(capacity * F.lit(config.fixed_overbook_pct))
    if policy == "avg_rate":
        return half_even(capacity * clipped(rate, 0.0, 1.0))
    if model_level is None:
        raise ValueError("the model policy needs the best level per night")
    return model_level


# --- The book of a night ----------------------------------------------------


def book_length(config: CostConfig, capacities: DataFrame | None = None) -> int:
    """The most bookings any policy can accept on one night at the largest hotel."""
    if capacities is None:
        rooms = max([config.default_capacity, *config.capacity.values()])
    else:
        largest = capacities.agg(F.max("capacity")).first()[0] or 0
        rooms = max(int(largest), config.default_capacity)
    # an average rate is at most 1, so that policy at most doubles the rooms
    return rooms + max(1, math.ceil(rooms * max(1.0, config.fixed_overbook_pct, config.o_max_pct)))


def night_books(
    df: DataFrame,
    length: int,
    hotel: str = "hotel",
    night: str = "stay_date",
    price: str = "adr",
    label: str | None = "is_canceled",
    lead: str = "lead_time",
    unique: str = "row_id",
    p_cancel: str | None = "p_cancel",
    nights: str | None = "length_of_stay",
    salts: int | None = None,
) -> DataFrame:
    """One row per hotel and night: bookings, mean price and the book.

    Earlier bookings (longer lead time) come first, ties by ``unique``. A book entry has
    the booking and the shows and revenue up to and including it.
    """
    def optional(name: str | None, default: Column) -> Column:
        return F.col(name) if name and name in df.columns else default

    slim = df.select(
        F.col(hotel).alias("hotel"),
        F.col(night).cast("date").alias("stay_date"),
        F.col(price).cast("double").alias("adr"),
        F.col(lead).alias("lead_time"),
        F.col(unique).alias("row_id"),
        F.when(optional(label, F.lit(0)) == 0, 1).otherwise(0).alias("show"),
        optional(p_cancel, F.lit(None)).cast("double").alias("p"),
        optional(nights, F.lit(1)).cast("int").alias("los"),
    )
    keys = ["hotel", "stay_date"]
    totals = slim.groupBy(*keys).agg(
        F.count("*").alias("n_bookings"),
        F.avg("adr").alias("adr_ref"),
        F.avg("p").alias("mean_p"),
        F.sum(1 - F.col("p")).alias("expected_shows"),
        F.sum("adr").alias("adr_sum"),
        F.max("los").alias("max_los"),
    )
    order = [F.col("lead_time").desc(), F.col("row_id").asc()]
    first = top_rows(slim, keys, order, length, "row_id", salts=salts)
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = first.withColumns(
        {
            "shows": F.sum("show").over(so_far),
            "revenue": F.sum(F.when(F.col("show") == 1, F.col("adr")).otherwise(0.0)).over(so_far),
        }
    )
    entry = F.struct("position", "show", "adr", "p", "los", "shows", "revenue")
    books = running.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("book"))
    return totals.join(books, keys)


# --- Expected cost, exactly -------------------------------------------------


def expected_gaps(p_cancel: np.ndarray, rooms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected empty rooms and displaced guests when the first ``m`` bookings are accepted.

    Row ``m``, one column per capacity in ``rooms``. One more booking leaves ``c`` rooms as they
    are with its cancellation probability and takes one otherwise, so the expected number of
    empty rooms follows from the row before for all capacities at once; the state is one array.
    """
    rooms = np.asarray(rooms, dtype=np.int64)
    state = np.arange(rooms.max(initial=0) + 1.0)
    empty = np.empty((len(p_cancel) + 1, len(rooms)))
    empty[0] = rooms
    for m, p in enumerate(p_cancel, start=1):
        state[1:] = p * state[1:] + (1.0 - p) * state[:-1]
        empty[m] = state[rooms]
    guests = np.concatenate(([0.0], np.cumsum(1.0 - np.asarray(p_cancel, dtype=float))))
    return empty, np.maximum(guests[:, None] - rooms + empty, 0.0)


def expected_gaps_of_nights(p_cancel: np.ndarray, rooms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`expected_gaps` of many nights with equally many bookings, a row of ``p_cancel`` each."""
    nights, bookings = p_cancel.shape
    state = np.tile(np.arange(rooms.max(initial=0) + 1.0), (nights, 1))
    empty = np.empty((nights, bookings + 1, len(rooms)))
    empty[:, 0] = rooms
    for m in range(bookings):
        p = p_cancel[:, m, None]
        state[:, 1:] = p * state[:, 1:] + (1.0 - p) * state[:, :-1]
        empty[:, m + 1] = state[:, rooms]
    guests = np.pad(np.cumsum(1.0 - p_cancel, axis=1), ((0, 0), (1, 0)))
    return empty, np.maximum(guests[:, :, None] - rooms + empty, 0.0)


def highest_level(capacity: int, o_max_pct: float) -> int:
    return max(1, int(o_max_pct * capacity))


def level_costs(empty: np.ndarray, over: np.ndarray, capacity: int, price: float, k: float, o_max: int) -> np.ndarray:
    """Expected cost of o = 0..o_max, from the two gaps by number of accepted bookings."""
    accepted = np.minimum(len(empty) - 1, capacity + np.arange(o_max + 1))
    return price * empty[accepted] + k * price * over[accepted]


def first_lowest(costs: np.ndarray) -> np.ndarray:
    """Place of the lowest cost along the last axis; costs equal but for rounding are equal."""
    lowest = costs.min(axis=-1, keepdims=True)
    return np.argmax(costs <= lowest + 1e-9 * np.maximum(1.0, np.abs(lowest)), axis=-1)


CELLS_AT_ONCE = 1 << 19  # numbers in one array of gaps or costs
LEVEL_SCHEMA = "o_star int, expected_cost double, cost_curve array<double>"


def best_level(
    p_cancel: Column,
    capacity: Column,
    price: Column,
    k: Column,
    config: CostConfig,
    o_max: int | None = None,
) -> Column:
    """Struct ``(o_star, expected_cost, cost_curve)`` for an array of cancellation probabilities.

    The smallest of equally good levels wins; no bookings give level 0 at cost 0. A batch
    holds many nights.
    """
    share = config.o_max_pct

    def solve(p, rooms, unit, factor):
        p = np.asarray(p if p is not None else [], dtype=float)
        if len(p) == 0:
            return 0, 0.0, [0.0]
        top = highest_level(rooms, share) if o_max is None else o_max
        p = p[: rooms + top]
        empty, over = (gap[:, 0] for gap in expected_gaps(p, np.array([rooms])))
        costs = level_costs(empty, over, rooms, unit, factor, top)
        best = int(first_lowest(costs))
        return best, float(costs[best]), costs.tolist()

    @F.pandas_udf(LEVEL_SCHEMA)
    def run(p: pd.Series, rooms: pd.Series, unit: pd.Series, factor: pd.Series) -> pd.DataFrame:
        rows = [solve(a, int(b), float(c), float(d)) for a, b, c, d in zip(p, rooms, unit, factor)]
        return pd.DataFrame(rows, columns=["o_star", "expected_cost", "cost_curve"])

    return run(p_cancel, capacity, price, k)


def best_levels_by_room(p_cancel: Column, capacity: Column, ks: Sequence[float], config: CostConfig) -> Column:
    """Best level for every number of free rooms 0..capacity: one array per ``k``.

    The price does not matter for the choice, because both costs are in proportion to it.
    """
    share, factors = config.o_max_pct, [float(k) for k in ks]

    def solve(p: np.ndarray, rooms: int) -> np.ndarray:
        """Nights with as many rooms and bookings as one another: level by night, factor and free rooms."""
        free, top = np.arange(1, rooms + 1), highest_level(rooms, share)
        empty, over = expected_gaps_of_nights(p[:, : rooms + top], free)
        level = np.arange(top + 1)
        accepted = np.minimum(empty.shape[1] - 1, free[:, None] + level)
        allowed = level <= np.array([highest_level(int(c), share) for c in free], np.int64)[:, None]
        idle, excess = empty[:, accepted, free[:, None] - 1], over[:, accepted, free[:, None] - 1]
        best = [first_lowest(np.where(allowed, idle + k * excess, np.inf)) for k in factors]
        return np.stack([np.pad(levels, ((0, 0), (1, 0))) for levels in best], axis=1)

    @F.arrow_udf("array<array<int>>")
    def run(p: pa.Array, rooms: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(p), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, flat = np.cumsum(lengths) - lengths, p.flatten().to_numpy(zero_copy_only=False).astype(float)
        capacity = rooms.to_numpy().astype(np.int64)
        width = np.repeat(capacity + 1, len(factors))
        ends = np.concatenate(([0], np.cumsum(width)))
        found, first = np.zeros(ends[-1], np.int32), ends[:-1].reshape(-1, len(factors))[:, 0] if len(factors) else ends[:-1]
        kinds, kind = np.unique(np.stack([capacity, lengths]), axis=1, return_inverse=True)
        by_kind = np.argsort(kind.ravel(), kind="stable")
        for (room, length), nights in zip(kinds.T.tolist(), np.split(by_kind, np.cumsum(np.bincount(kind.ravel()))[:-1])):
            if not length or not room:  # no booking or no room: level 0
                continue
            step = max(1, CELLS_AT_ONCE // (room * (length + highest_level(room, share) + 2)))
            for k in range(0, len(nights), step):
                some = nights[k : k + step]
                levels = solve(flat[starts[some][:, None] + np.arange(length)], room)
                found[first[some][:, None] + np.arange(len(factors) * (room + 1))] = levels.reshape(len(some), -1)
        inner = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(factors), pa.int32()), inner)

    return run(p_cancel, capacity)


def cost_curve_map(curve: Column) -> Column:
    """The cost curve as a map from level to expected cost."""
    return F.map_from_arrays(F.sequence(F.lit(0), F.size(curve) - 1), curve)


def exact_guest_law(p_cancel: Column) -> Column:
    """Distribution of the number of guests as an array, as a native fold (no Python)."""
    start = F.array(F.lit(1.0))

    def add(law, p):
        stays = F.concat(F.transform(law, lambda x: x * p), F.array(F.lit(0.0)))
        comes = F.concat(F.array(F.lit(0.0)), F.transform(law, lambda x: x * (F.lit(1.0) - p)))
        return F.zip_with(stays, comes, lambda a, b: a + b)

    return F.aggregate(p_cancel, start, add)


# --- Recommendations --------------------------------------------------------


def night_summary(df: DataFrame, hotel: str = "hotel", night: str = "stay_date") -> DataFrame:
    """Per hotel and night: new bookings, mean probability, expected guests and reference price."""
    return df.groupBy(hotel, night).agg(
        F.count("*").alias("n_new_bookings"),
        F.avg("p_cancel").alias("mean_p_cancel"),
        F.sum(1 - F.col("p_cancel")).alias("expected_show_ups"),
        F.avg("adr").alias("adr_ref"),
    )


def recommend(
    df: DataFrame,
    config: CostConfig,
    occupied: DataFrame | None = None,
    capacities: DataFrame | None = None,
    with_curve: bool = False,
    decimals: bool = True,
    **columns,
) -> DataFrame:
    """Level to overbook for every hotel and night at once, given the rooms already taken.

    Amounts are rounded for display unless ``decimals`` is false.

    ``occupied`` has ``(hotel, stay_date, already_occupied)`` and optionally ``adr_ref``
    and ``k`` that replace the night's mean price and the default factor.
    """
    books = night_books(df, book_length(config, capacities), **columns)
    nights = with_capacity(books, config, capacities)
    if occupied is not None:
        given = {"adr_ref": "_price", "k": "_k"}
        known = [F.col(c).alias(given.get(c, c)) for c in occupied.columns]
        nights = nights.join(occupied.select(*known), ["hotel", "stay_date"], "left")
    has = set(nights.columns)
    taken = F.coalesce(F.col("already_occupied"), F.lit(0)) if "already_occupied" in has else F.lit(0)
    price = F.coalesce(F.col("_price"), F.col("adr_ref")) if "_price" in has else F.col("adr_ref")
    k = F.coalesce(F.col("_k"), F.lit(config.default_k)) if "_k" in has else F.lit(config.default_k)
    nights = nights.withColumns({"already_occupied": taken, "adr_ref": price, "k": k.cast("double")})
    nights = nights.withColumn("effective_capacity", F.greatest(F.lit(0), F.col("capacity") - F.col("already_occupied")))
    level = best_level(F.col("book.p"), F.col("effective_capacity"), F.col("adr_ref"), F.col("k"), config)
    solved = nights.withColumn("level", level)

    def shown(name: str, digits: int) -> Column:
        return F.round(name, digits) if decimals else F.col(name)

    out = [
        "hotel",
        "stay_date",
        F.col("level.o_star").alias("o_star"),
        "capacity",
        "already_occupied",
        "effective_capacity",
        shown("level.expected_cost", 2).alias("expected_cost"),
        shown("adr_ref", 2).alias("adr_ref"),
        F.col("n_bookings").alias("n_new_bookings"),
        shown("mean_p", 4).alias("mean_p_cancel"),
        shown("expected_shows", 1).alias("expected_show_ups"),
    ]
    if with_curve:
        out.append(cost_curve_map(F.col("level.cost_curve")).alias("cost_curve"))
    return solved.select(*out)


def policy_rows(policies: Sequence[str], ks: Sequence[float], levels: dict[str, list[Column]]) -> Column:
    """Array of ``(policy, k, o)`` for one night: policies and factors become rows, not loops."""
    entries = [
        F.struct(F.lit(policy).alias("policy"), F.lit(float(k)).alias("k"), levels[policy][i].cast("int").alias("o"))
        for policy in policies
        for i, k in enumerate(ks)
    ]
    return F.array(*entries)

