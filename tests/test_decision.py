from datetime import date, timedelta

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import booking
from roomtide.config import CostConfig
from roomtide.operators import backtest, occupancy, overbooking

FIELDS = (
    "row_id long, hotel string, stay_date date, adr double, is_canceled int, p_cancel double, lead_time int, length_of_stay int"
)
D0 = date(2023, 6, 1)


def stays(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], FIELDS)


def five(canceled=0):
    return [("City Hotel", D0, 100.0, int(i < canceled), 0.1, 30 - i, 3) for i in range(5)]


def best(spark, p, capacity, price=100.0, k=2.5, config=CostConfig(), **options):
    row = spark.createDataFrame([([float(x) for x in p],)], "p array<double>")
    level = overbooking.best_level(F.col("p"), F.lit(capacity), F.lit(price), F.lit(k), config, **options)
    return row.select(level.alias("r")).first().r


def test_length_of_stay_and_occupancy(make_raw):
    raw = make_raw([
        booking(stays_in_weekend_nights=1, stays_in_week_nights=2),
        booking(is_canceled=1, arrival_date_day_of_month=20),
        booking(arrival_date_day_of_month=9, stays_in_weekend_nights=0, stays_in_week_nights=0),
    ])
    rows = occupancy.with_stay(raw)
    for form in (occupancy.nightly_occupancy, occupancy.nightly_occupancy_by_night):
        found = {r.date.day: r.occupancy for r in form(rows).collect()}
        assert found == {4: 1, 5: 1, 6: 1, 7: 0, 8: 0, 9: 1}
    capacity = occupancy.estimate_capacity(occupancy.nightly_occupancy(rows), 0.5).first().capacity
    assert capacity == 1
    assert occupancy.with_stay(make_raw([booking(arrival_date_month="Juli")])).first().stay_date is None


def test_policies(spark):
    def level(policy, capacity, rate=0.0, config=CostConfig()):
        value = overbooking.policy_level(policy, F.lit(capacity), F.lit(rate), config)
        return spark.range(1).select(value.alias("v")).first().v

    assert level("fixed", 300) == 15
    assert level("fixed", 190) == round(190 * 0.05) == 10
    assert level("avg_rate", 300, 1.5) == 300
    assert level("avg_rate", 300, -0.2) == 0
    assert level("no_overbook", 300) == 0
    with pytest.raises(ValueError, match="unknown policy"):
        overbooking.check_policies(["fixed", "best"])


def test_best_level_properties(spark):
    found = best(spark, [0.15] * 200, 180, o_max=50)
    assert 0 <= found.o_star <= 50 and found.expected_cost >= 0 and len(found.cost_curve) == 51
    assert best(spark, [0.30] * 300, 180).o_star >= best(spark, [0.02] * 300, 180).o_star
    assert tuple(best(spark, [], 10))[:2] == (0, 0.0)
    # all are accepted from o = 1 on: the smallest of equal levels wins
    assert best(spark, [0.9] * 5, 4).o_star == 1
    assert best(spark, [0.5] * 3, 0, k=0.1).o_star == 0


def test_law_against_enumeration(spark):
    p = [0.1, 0.2, 0.3]
    row = spark.createDataFrame([(p,)], "p array<double>")
    native = row.select(overbooking.exact_guest_law(F.col("p")).alias("law")).first().law
    assert native == pytest.approx([0.006, 0.092, 0.398, 0.504])
    empty, over = overbooking.expected_gaps(np.array(p), np.array([0, 1, 2, 3]))
    guests = np.arange(4)
    for c in range(4):
        assert empty[3, c] == pytest.approx(np.dot(native, np.maximum(0, c - guests)))
        assert over[3, c] == pytest.approx(np.dot(native, np.maximum(0, guests - c)))


def test_gaps_equal_the_full_law():
    rng = np.random.default_rng(1)
    p, rooms = rng.random(60) * 0.6, np.array([0, 1, 17, 40, 75])
    empty, over = overbooking.expected_gaps(p, rooms)
    law = np.array([1.0])
    for m in range(len(p) + 1):
        if m:
            law = np.convolve(law, [p[m - 1], 1 - p[m - 1]])
        gap = rooms[None, :] - np.arange(m + 1)[:, None]
        assert np.allclose(empty[m], law @ np.maximum(gap, 0), atol=1e-10)
        assert np.allclose(over[m], law @ np.maximum(-gap, 0), atol=1e-10)


def test_large_hotels_are_quick():
    p = np.random.default_rng(1).random(2600) * 0.5
    start = time.perf_counter()
    overbooking.expected_gaps(p, np.array([2000]))
    assert time.perf_counter() - start < 0.5  # 0.02 s on an idle core


def test_levels_by_room_match_single_levels(spark):
    p = (np.random.default_rng(2).random(30) * 0.5).tolist()
    row = spark.createDataFrame([(p,)], "p array<double>")
    config = CostConfig()
    table = row.select(overbooking.best_levels_by_room(F.col("p"), F.lit(20), [1.5, 3.0], config).alias("t")).first().t
    for i, k in enumerate([1.5, 3.0]):
        for rooms in (1, 7, 20):
            assert table[i][rooms] == best(spark, p, rooms, k=k).o_star


def test_no_moves_without_overbooking(spark):
    rows = stays(spark, [("X", D0, 80.0, int(i % 5 == 0), 0.2, 300 - i, 1) for i in range(250)])
    config = CostConfig(capacity={"X": 200})
    found = {r.policy: r for r in backtest.backtest_policies(rows, config, policies=["no_overbook", "fixed"]).collect()}
    assert found["no_overbook"].moved_customers == 0 and found["no_overbook"].accepted_n == 200
    assert found["fixed"].accepted_n == 210 and found["fixed"].arrivals_actual == 168


def test_carryover(spark):
    rows = stays(spark, five() + [("City Hotel", D0 + timedelta(3), 100.0, 0, 0.1, 1, 1)])
    found = backtest.backtest_sequential(rows, CostConfig(), policies=["no_overbook"]).orderBy("stay_date").collect()
    assert [r.carryover_occupancy for r in found] == [0, 5, 5, 0]
    assert [r.effective_capacity for r in found] == [190, 185, 185, 190]
    assert [r.arrivals_actual for r in found] == [5, 5, 5, 1]
    assert found[1].revenue == 500.0 and found[1].cost == pytest.approx(185 * 100.0)
    one_less = backtest.backtest_sequential(stays(spark, five(canceled=1)), CostConfig(), policies=["fixed"])
    assert [r.carryover_occupancy for r in one_less.orderBy("stay_date").collect()] == [0, 4, 4]


def walk_one(bookings, capacity, level_of):
    """Night by night with an explicit list of guests in the house."""
    first = min(b[0] for b in bookings)
    last = max(b[0] + timedelta(b[4]) for b in bookings)
    staying, out, day = [], [], first
    while day < last:
        staying = [(until, adr) for until, adr in staying if until > day]
        new = sorted((b for b in bookings if b[0] == day), key=lambda b: (-b[3], b[5]))
        free = max(0, capacity - len(staying))
        taken = new[: min(len(new), max(0, free + level_of(day, free, new)))]
        came = [b for b in taken if b[2] == 0]
        out.append((day, len(staying), len(taken), len(staying) + len(came), sum(a for _, a in staying) + sum(b[1] for b in came)))
        staying += [(day + timedelta(b[4]), b[1]) for b in came]
        day += timedelta(1)
    return out


def test_sequential_against_a_plain_walk(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        day = D0 + timedelta(int(rng.integers(0, 40)) // (1 + i % 2 * 3))
        rows.append(("H", day, float(rng.integers(50, 200)), int(rng.random() < 0.3), float(rng.random() * 0.6), int(rng.integers(0, 9)), int(rng.integers(1, 6))))
    config = CostConfig(capacity={"H": 11}, fixed_overbook_pct=0.25)
    frame = stays(spark, rows).repartition(5)
    found = backtest.backtest_sequential(frame, config, policies=["fixed", "model"])
    levels = {"fixed": lambda day, free, new: round(11 * 0.25)}
    plain = [(r[1], r[2], r[3], r[5], r[6], i) for i, r in enumerate(rows)]

    def model_level(day, free, new):
        if not new or free <= 0:
            return 0
        p = np.array([rows[b[5]][4] for b in new])
        empty, over = (g[:, 0] for g in overbooking.expected_gaps(p, np.array([free])))
        top = max(1, int(0.3 * free))
        return int(np.argmin(overbooking.level_costs(empty, over, free, 1.0, 2.0, top)))

    levels["model"] = model_level
    for policy, level in levels.items():
        got = [
            (r.stay_date, r.carryover_occupancy, r.accepted_n, r.arrivals_actual, r.revenue)
            for r in found.filter(F.col("policy") == policy).orderBy("stay_date").collect()
        ]
        expected = walk_one(plain, 11, level)
        assert [g[:4] for g in got] == [e[:4] for e in expected]
        assert [g[4] for g in got] == pytest.approx([e[4] for e in expected])


def many_hotels(n, nights=60):
    rng = np.random.default_rng(4)
    return [
        (f"H{h:03}", D0 + timedelta(int(rng.integers(0, nights + h % 9))), float(rng.integers(50, 200)), int(rng.random() < 0.3), float(rng.random() * 0.6), int(rng.integers(0, 99)), int(rng.integers(1, 6)))
        for h in range(n)
        for _ in range(40 + h % 7)
    ]


def test_hotels_walked_together_equal_hotels_walked_alone(spark, monkeypatch):
    rows = many_hotels(12)
    capacities = spark.createDataFrame([(f"H{h:03}", h % 5) for h in range(11)], "hotel string, capacity int")
    config = CostConfig(capacity={}, default_capacity=4, fixed_overbook_pct=0.4)
    run = lambda frame: sorted(map(tuple, backtest.backtest_sequential(frame, config, [1.5, 3.0], capacities=capacities).collect()))
    frame = stays(spark, rows).cache()
    together = run(frame)
    alone = sorted(row for h in range(12) for row in run(frame.where(F.col("hotel") == f"H{h:03}")))
    assert together == alone and len({row[0] for row in together}) == 12
    monkeypatch.setattr(backtest, "ROWS_AT_ONCE", 1)  # a hotel at a time, cut from the same stream of rows
    assert run(frame) == together


def test_walk_takes_a_step_for_a_night_and_not_for_a_night_of_a_hotel(spark, monkeypatch):
    """The steps of the walk are as many as the nights of the longest calendar, whatever the number of hotels."""
    steps = []
    monkeypatch.setattr(backtest, "_ranges", lambda *given, plain=backtest._ranges: steps.append(1) or plain(*given))
    day, n, hotels = 18_000, 30, 50
    rows = pa.RecordBatch.from_pydict(
        {
            "hotel": [f"H{h}" for h in range(hotels) for _ in range(n)],
            "stay_date": pa.array([day + d for _ in range(hotels) for d in range(n)], pa.date32()),
            **{name: pa.array([value] * (hotels * n)) for name, value in [("capacity", 2), ("n_bookings", 1), ("adr_ref", 9.0), ("adr_sum", 9.0), ("max_los", 2), ("rate_level", 0)]},
            "levels": pa.array([None] * (hotels * n), pa.list_(pa.list_(pa.int32()))),
            "shows": [[1]] * (hotels * n), "prices": [[9.0]] * (hotels * n), "stays": [[2]] * (hotels * n),
        }
    )
    out = backtest._walk_nights(rows, [("fixed", 2.0), ("no_overbook", 2.0)], [2.0], 0.5).to_pandas()
    assert len(out) == 2 * hotels * n and len(steps) == n
    assert out[out.policy == "fixed"].arrivals_actual.tolist() == ([1] + [2] * (n - 1)) * hotels


def test_amounts_of_guests_without_a_price_are_null():
    nights = {
        "hotel": ["A"] * 3, "stay_date": pa.array([18_000, 18_001, 18_002], pa.date32()), "capacity": [2] * 3, "n_bookings": [1, 1, 1],
        "adr_ref": pa.array([None, 9.0, 9.0]), "adr_sum": pa.array([None, 9.0, 9.0]), "max_los": [2, 1, 1], "rate_level": [0] * 3,
        "levels": pa.array([None] * 3, pa.list_(pa.list_(pa.int32()))), "shows": [[1], [1], [1]], "prices": [[None], [9.0], [9.0]], "stays": [[2], [1], [1]],
    }
    out = backtest._walk_nights(pa.RecordBatch.from_pydict(nights), [("no_overbook", 2.0)], [2.0], 0.5).to_pydict()
    assert out["revenue"] == [None, None, 9.0] and out["cost"] == [None, 0.0, 9.0] and out["profit"] == [None, None, 0.0]


def test_levels_of_many_nights_equal_levels_of_one(spark):
    rng = np.random.default_rng(3)
    rows = [(rng.random(int(rng.integers(0, 9))).tolist() if i % 9 else None, i % 6) for i in range(200)]
    frame = spark.createDataFrame(rows, "p array<double>, rooms int").coalesce(1)
    made = overbooking.best_levels_by_room(F.col("p"), F.col("rooms"), [1.5, 3.0], CostConfig())
    for r in frame.select("p", "rooms", made.alias("t")).collect():
        p = np.array(r.p or [])
        for row, k in zip(r.t, [1.5, 3.0]):
            want = [0]
            for free in range(1, r.rooms + 1):
                empty, over = (g[:, 0] for g in overbooking.expected_gaps(p, np.array([free])))
                costs = overbooking.level_costs(empty, over, free, 1.0, k, overbooking.highest_level(free, 0.3))
                want.append(int(overbooking.first_lowest(costs)) if len(p) else 0)
            assert row == want


def test_hot_night_is_cut_the_same_way(spark):
    rows = stays(spark, [("X", D0, float(i % 90), int(i % 4 == 0), 0.25, i % 7, 1) for i in range(3000)])
    config = CostConfig(capacity={"X": 20}, default_capacity=20)
    results = [
        backtest.backtest_policies(rows, config, ks=[1.5, 2.0], salts=salts).orderBy("policy", "k").collect()
        for salts in (1, 16)
    ]
    assert results[0] == results[1]


def test_sensitivity_and_summary(spark):
    rows = stays(spark, five() + [("Other", D0, 50.0, 1, 0.9, 3, 1)])
    summary = backtest.sensitivity(rows, CostConfig(), policies=["no_overbook", "avg_rate"]).collect()
    assert {(r.policy, r.k) for r in summary} == {(p, k) for p in ("no_overbook", "avg_rate") for k in (1.5, 2.0, 3.0)}
    assert all(r.n_nights == 2 for r in summary)


def test_recommendation(spark):
    rows = stays(spark, five())
    config = CostConfig()
    held = spark.createDataFrame([("City Hotel", D0, 187, 90.0)], "hotel string, stay_date date, already_occupied int, adr_ref double")
    found = overbooking.recommend(rows, config, held, with_curve=True).first()
    assert (found.capacity, found.already_occupied, found.effective_capacity) == (190, 187, 3)
    assert (found.adr_ref, found.n_new_bookings, found.mean_p_cancel, found.expected_show_ups) == (90.0, 5, 0.1, 4.5)
    assert found.expected_cost == pytest.approx(min(found.cost_curve.values()), abs=0.01) and found.o_star in found.cost_curve
    assert overbooking.recommend(rows, config).first().effective_capacity == 190
