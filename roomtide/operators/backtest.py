"""Backtests of the overbooking policies, night by night and with stays carried over."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.config import CostConfig
from roomtide.operators.overbooking import (
    POLICIES,
    best_level,
    best_levels_by_room,
    book_length,
    check_policies,
    cost_empty,
    cost_overbook,
    night_books,
    policy_level,
    policy_rows,
    with_capacity,
    with_rate,
)


def night_result(n_bookings: Column, capacity: Column, o: Column, book: Column, price: Column, k: Column) -> dict[str, Column]:
    """Outcome of one night with true labels when the first ``capacity + o`` bookings are accepted."""
    accepted = F.least(n_bookings, capacity + o).cast("int")
    last = F.when(accepted > 0, F.element_at(book, F.greatest(accepted, F.lit(1))))
    arrivals = F.coalesce(last["shows"], F.lit(0)).cast("int")
    revenue = F.coalesce(last["revenue"], F.lit(0.0))
    empty = F.greatest(F.lit(0), capacity - arrivals)
    moved = F.greatest(F.lit(0), arrivals - capacity)
    cost = empty * cost_empty(price) + moved * cost_overbook(price, k)
    return {
        "accepted_n": accepted,
        "arrivals_actual": arrivals,
        "empty_rooms": empty,
        "moved_customers": moved,
        "revenue": revenue,
        "cost": cost,
        "profit": revenue - cost,
    }


def backtest_policies(
    df: DataFrame,
    config: CostConfig,
    ks: Sequence[float] | None = None,
    policies: Sequence[str] = tuple(POLICIES),
    rates: DataFrame | None = None,
    capacities: DataFrame | None = None,
    **columns,
) -> DataFrame:
    """Every night on its own: one row per hotel, night, policy and ``k``.

    Bookings are shuffled once into books; policies and factors are rows made from the book.
    """
    policies = check_policies(policies)
    ks = [config.default_k] if ks is None else [float(k) for k in ks]
    nights = night_books(df, book_length(config, capacities), **columns)
    nights = with_rate(with_capacity(nights, config, capacities), rates, config)
    if "model" in policies:
        p, price = F.col("book.p"), F.col("adr_ref")
        solved = {f"_o{i}": best_level(p, F.col("capacity"), price, F.lit(k), config) for i, k in enumerate(ks)}
        nights = nights.withColumns(solved)
    levels = {
        policy: [
            policy_level(policy, F.col("capacity"), F.col("rate"), config, F.col(f"_o{i}.o_star") if policy == "model" else None)
            for i in range(len(ks))
        ]
        for policy in policies
    }
    each = nights.withColumn("choice", F.explode(policy_rows(policies, ks, levels)))
    result = night_result(
        F.col("n_bookings"), F.col("capacity"), F.col("choice.o"), F.col("book"), F.col("adr_ref"), F.col("choice.k")
    )
    return each.select(
        "hotel",
        "stay_date",
        "choice.policy",
        "choice.k",
        "choice.o",
        *[column.alias(name) for name, column in result.items()],
    )


def summarize(results: DataFrame, by: Sequence[str] = ("policy",), ordered: bool = True) -> DataFrame:
    """Total profit, displaced guests and nights per policy, best profit first."""
    totals = results.groupBy(*by).agg(
        F.sum("profit").alias("total_profit"),
        F.sum("moved_customers").cast("bigint").alias("total_moved"),
        F.count("*").alias("n_nights"),
    )
    per_1000 = F.col("total_moved") / F.col("n_nights") * 1000
    summary = totals.withColumn("moved_per_1000_nights", per_1000)
    return summary.orderBy(F.col("total_profit").desc()) if ordered else summary


def sensitivity(
    df: DataFrame,
    config: CostConfig,
    backtest: Callable[..., DataFrame] = backtest_policies,
    ordered: bool = True,
    **options,
) -> DataFrame:
    """Policy summary for every configured ``k``, in one job."""
    results = backtest(df, config, ks=config.k_values, **options)
    return summarize(results, by=("policy", "k"), ordered=ordered)


# --- Stays carried over from night to night ---------------------------------

SEQUENTIAL_SCHEMA = (
    "hotel string, stay_date date, policy string, k double, o int, effective_capacity int, "
    "carryover_occupancy int, accepted_n int, arrivals_actual int, empty_rooms int, moved_customers int, "
    "revenue double, cost double, profit double"
)


ROWS_AT_ONCE = 100_000  # nights of whole hotels that are walked side by side
CARRIED_COLUMNS = [column.split() for column in SEQUENTIAL_SCHEMA.split(", ")]


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the list of every row starts among all values, and the values; no list is an empty one."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))), column.flatten()


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _walk_nights(nights: pa.RecordBatch, choices: list[tuple[str, float]], ks: list[float], fixed_pct: float) -> pa.RecordBatch:
    """Walk the calendars of several hotels at once, night by night, all (policy, k) side by side.

    Rows are in order of hotel and night, and each hotel has all its nights. ``rooms[r]`` and ``money[r]``
    hold the guests with ``r`` nights to go and what they pay per night, so the state is bounded by the
    longest stay.
    """
    column = {name: nights.column(name) for name in nights.schema.names}
    number = {name: column[name].to_numpy(zero_copy_only=False) for name in ("capacity", "n_bookings", "adr_ref", "adr_sum", "max_los", "rate_level")}
    ends = pc.run_end_encode(column["hotel"]).run_ends.to_numpy()
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    usual = np.array([np.nansum(number["adr_sum"][a:b]) / number["n_bookings"][a:b].sum() for a, b in zip(starts, ends)])
    order = np.argsort(starts - ends, kind="stable")  # long calendars first: those that still run are the first ones
    starts, days, usual = starts[order], (ends - starts)[order], usual[order]
    capacity = number["capacity"][starts].astype(np.int64)
    fixed = np.rint(capacity * fixed_pct).astype(np.int64)
    wide, longest = len(choices), int(np.nanmax(number["max_los"]))
    factor = np.array([k for _, k in choices])

    begins, shows = _lists(column["shows"])
    prices, stays = _lists(column["prices"])[1].to_numpy(zero_copy_only=False), _lists(column["stays"])[1].to_numpy()
    place = np.arange(len(shows)) - np.repeat(begins[:-1], np.diff(begins))
    came = np.flatnonzero(shows.to_numpy())  # only guests who show take a room
    begins = np.searchsorted(came, begins)
    prices, stays, place = prices[came], stays[came].astype(np.int64), place[came]
    table_of, tables = _lists(column["levels"])
    level_of, levels = _lists(tables) if any(policy == "model" for policy, _ in choices) else (None, None)
    levels = None if levels is None else levels.to_numpy()

    rooms, money = np.zeros((longest + 1, len(starts), wide), np.int64), np.zeros((longest + 1, len(starts), wide))
    whole = ("o", "effective_capacity", "carryover_occupancy", "accepted_n", "arrivals_actual", "empty_rooms", "moved_customers")
    made = {name: np.zeros((nights.num_rows, wide), np.int32) for name in whole}
    made |= {name: np.zeros((nights.num_rows, wide)) for name in ("revenue", "cost")}
    for t in range(int(days[0])):
        live = int(np.searchsorted(-days, -t))  # hotels whose calendar has a night t
        at = starts[:live] + t
        rooms, money = rooms[:, :live], money[:, :live]
        for state in (rooms, money):
            state[:-1] = state[1:].copy()
            state[[0, -1]] = 0
        carried, carried_money = rooms.sum(axis=0), money.sum(axis=0)
        free = np.maximum(0, capacity[:live, None] - carried)
        n = number["n_bookings"][at]
        booked = np.flatnonzero(n > 0)
        o = np.zeros((live, wide), np.int64)
        for i, (policy, k) in enumerate(choices):
            if policy == "fixed":
                o[:, i] = fixed[:live]
            elif policy == "avg_rate":
                o[:, i] = number["rate_level"][at]
            elif policy == "model" and len(booked):
                o[booked, i] = levels[level_of[table_of[at[booked]] + ks.index(k)] + free[booked, i]]
        accepted = np.minimum(n[:, None], np.maximum(0, free + o))
        arrived, revenue = carried.copy(), carried_money.copy()
        sizes = begins[at + 1] - begins[at]
        if sizes.any():
            guest, hotel = _ranges(begins[at], sizes), np.repeat(np.arange(live), sizes)
            which, choice = np.nonzero(place[guest][:, None] < accepted[hotel])
            guest, hotel = guest[which], hotel[which]
            np.add.at(rooms, (stays[guest], hotel, choice), 1)
            np.add.at(money, (stays[guest], hotel, choice), prices[guest])
            cell = hotel * wide + choice
            arrived += np.bincount(cell, minlength=live * wide).reshape(live, wide)
            revenue += np.bincount(cell, prices[guest], minlength=live * wide).reshape(live, wide)
        price = np.where(n > 0, number["adr_ref"][at], usual[:live])[:, None]
        empty, moved = np.maximum(0, capacity[:live, None] - arrived), np.maximum(0, arrived - capacity[:live, None])
        cost = price * (empty + factor * moved)
        for name, value in zip(made, (o, free, carried, accepted, arrived, empty, moved, revenue, cost)):
            made[name][at] = value

    rows = pa.array(np.repeat(np.arange(nights.num_rows), wide))
    made["profit"] = made["revenue"] - made["cost"]
    out = {name: pa.array(value.ravel(), from_pandas=True) for name, value in made.items()}  # an amount without a price is null
    out |= {name: column[name].take(rows) for name in ("hotel", "stay_date")}
    out["policy"] = pa.array([policy for policy, _ in choices]).take(pa.array(np.tile(np.arange(wide), nights.num_rows)))
    out["k"] = pa.array(np.tile(factor, nights.num_rows))
    return pa.RecordBatch.from_pydict({name: out[name] for name, _ in CARRIED_COLUMNS})


def _whole_hotels(batches: Iterator[pa.RecordBatch], rows_at_once: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of hotel as batches that never cut a hotel, of about ``rows_at_once`` rows or one hotel."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = batch if held is None else pa.concat_batches([held, batch])
        if held.num_rows >= rows_at_once:
            ends = pc.run_end_encode(held.column("hotel")).run_ends.to_numpy()
            if len(ends) > 1:
                yield held.slice(0, int(ends[-2]))
                held = held.slice(int(ends[-2]))
    if held is not None:
        yield held


def _whole_calendar(nights: DataFrame) -> DataFrame:
    """Add the nights without new bookings, up to the hotel's last checkout.

    A booked night covers the days before the next one, so no calendar join is needed.
    Canceled bookings count for the length of the calendar.
    """
    hotel = Window.partitionBy("hotel")
    end = F.max(F.date_add("stay_date", F.col("max_los"))).over(hotel)
    following = F.coalesce(F.lead("stay_date").over(hotel.orderBy("stay_date")), F.col("_end"))
    spans = nights.withColumn("_end", end).withColumn("_next", following)
    days = spans.withColumn("_day", F.explode(F.sequence("stay_date", F.date_sub("_next", 1))))
    first = F.col("_day") == F.col("stay_date")
    kept = [F.when(first, F.col(c)).alias(c) for c in ("levels", "shows", "prices", "stays", "adr_ref")]
    zeroed = [F.when(first, F.col(c)).otherwise(0).alias(c) for c in ("n_bookings", "adr_sum", "max_los")]
    return days.select("hotel", F.col("_day").alias("stay_date"), "capacity", *zeroed, *kept)


def backtest_sequential(
    df: DataFrame,
    config: CostConfig,
    ks: Sequence[float] | None = None,
    policies: Sequence[str] = tuple(POLICIES),
    rates: DataFrame | None = None,
    capacities: DataFrame | None = None,
    **columns,
) -> DataFrame:
    """Nights in order, with accepted guests keeping their rooms until checkout.

    The heavy parts run per night, spread over the cluster: the books and, for the model
    policy, the best level for every number of free rooms. What is walked in order per
    hotel is bounded by nights times rooms, not by the number of bookings. A task walks many
    hotels side by side, a night of all of them in one step.
    """
    policies = check_policies(policies)
    ks = [config.default_k] if ks is None else [float(k) for k in ks]
    choices = [(policy, k) for policy in policies for k in ks]
    nights = night_books(df, book_length(config, capacities), **columns)
    nights = with_capacity(nights, config, capacities)
    if "model" in policies:
        nights = nights.withColumn("levels", best_levels_by_room(F.col("book.p"), F.col("capacity"), ks, config))
    else:
        nights = nights.withColumn("levels", F.lit(None).cast("array<array<int>>"))
    nights = nights.select(
        "hotel",
        "stay_date",
        "capacity",
        "n_bookings",
        "adr_ref",
        "adr_sum",
        "max_los",
        "levels",
        F.col("book.show").alias("shows"),
        F.col("book.adr").alias("prices"),
        F.col("book.los").alias("stays"),
    )
    nights = _whole_calendar(nights)
    nights = with_rate(nights, rates, config)
    nights = nights.withColumn("rate_level", policy_level("avg_rate", F.col("capacity"), F.col("rate"), config)).drop("rate")
    fixed_pct = config.fixed_overbook_pct

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_hotels(batches, ROWS_AT_ONCE):
            walked = _walk_nights(pa.concat_batches([part]), choices, ks, fixed_pct)
            for k in range(0, walked.num_rows, 20_000):
                yield walked.slice(k, 20_000)

    return nights.repartition("hotel").sortWithinPartitions("hotel", "stay_date").mapInArrow(walk, SEQUENTIAL_SCHEMA)
