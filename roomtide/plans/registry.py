"""Registered queries: every operator on whole tables of the star schema.

Each entry takes ``(spark, sf_dir)``. Doubles are rounded in the last step only, as in
the matching SQL text of :mod:`roomtide.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.config import CostConfig
from roomtide.functions.columns import half_even
from roomtide.operators import (
    backtest,
    cleaning,
    drift,
    features,
    forests,
    levels,
    metrics,
    models,
    monitoring,
    occupancy,
    overbooking,
    profiling,
    quantiles,
    ranking,
    records,
    service_levels,
    splitting,
    validation,
)
from roomtide.session import cut_lineage, shared_path
from roomtide.sources import hashes, readers, writers
from roomtide.sources.star import bookings, raw_bookings, scored_lines, table
from roomtide.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Settings used on the star schema, where hotels are far smaller than in the booking data.
WEEK_CONFIG = CostConfig(capacity={}, default_capacity=8, fixed_overbook_pct=0.10)
DAY_CONFIG = CostConfig(capacity={}, default_capacity=6, fixed_overbook_pct=0.20)
THREE_POLICIES = ["no_overbook", "fixed", "avg_rate"]
CUTOFF = date(2000, 5, 31)
DRIFT_COLUMNS = ["lead_time", "adr", "length_of_stay"]
# Streams are fed in order of time, over several triggers; a delay of days is enough and old state is dropped.
ORDERED_DELAY = "2 days"
FEED_FILES = 4


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round for comparison, a hair off exact ties; adding zero turns a negative zero into a plain one."""
    hair = F.lit(10.0 ** -(digits + 4))
    return df.withColumns({name: F.round(F.col(name) + hair, digits) + F.lit(0.0) for name in names})


def split_bookings(spark: SparkSession, sf_dir: str, stays: bool = False) -> DataFrame:
    return splitting.temporal_split(bookings(spark, sf_dir, stays=stays), "stay_date")


def scored_bookings(spark: SparkSession, sf_dir: str, stays: bool = False) -> DataFrame:
    """All bookings with the training rate of their hotel and calendar month as probability."""
    rows = split_bookings(spark, sf_dir, stays).withColumn("month_no", F.month("stay_date"))
    train = rows.filter(F.col("split") == "train")
    return features.baseline_predict(train, rows, ["hotel", "month_no"])


def decision_table(spark: SparkSession, sf_dir: str, stays: bool = False, by_property: bool = False) -> DataFrame:
    """Scored bookings written once: the decision and monitoring steps each read them several times.

    Nights are decided per property, of which a larger table has more.
    """
    rows = scored_bookings(spark, sf_dir, stays)
    return cut_lineage(rows.withColumn("hotel", F.col("property")) if by_property else rows, "scored")


def weekly_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored bookings with the week's first day as the night."""
    rows = decision_table(spark, sf_dir, by_property=True)
    return rows.withColumn("stay_date", F.date_trunc("week", "stay_date").cast("date"))


def weekly_capacity(nights: DataFrame) -> DataFrame:
    """Median number of new bookings per night, as whole rooms; one count per hotel and week."""
    counts = nights.groupBy("hotel", "stay_date").agg(F.count("*").alias("n"))
    return counts.groupBy("hotel").agg(half_even(F.percentile("n", 0.5)).alias("capacity"))


def daily_capacity(rows: DataFrame) -> DataFrame:
    return occupancy.estimate_capacity(occupancy.nightly_occupancy(rows))


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw bookings written once, for operators that read them or their columns many times."""
    return cut_lineage(raw_bookings(spark, sf_dir), "raw")


def cleaned_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(stored_raw(spark, sf_dir), order_by="row_key")


# --- Sources and sinks ------------------------------------------------------


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_table(raw_bookings(spark, sf_dir).drop("row_key"), shared_path(spark, "csv"), "csv")
    rows = readers.read_bookings_csv(spark, path)
    found = rows.groupBy("hotel", "deposit_type").agg(
        F.count("*").alias("n"),
        F.sum("adr").alias("adr"),
        F.sum("lead_time").alias("lead_time"),
        F.count("agent").alias("n_agent"),
        F.min("reservation_status_date").alias("first_day"),
    )
    return rounded(found, 1, "adr")


@query
def csv_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("arrival_date"))
    path = writers.write_table(days, shared_path(spark, "dates"), "csv")
    rows = readers.read_csv_with_dates(spark, path, ["arrival_date"])
    return rows.groupBy(F.trunc("arrival_date", "month").alias("month_start")).agg(F.count("*").alias("n"))


@query
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_partitioned(split_bookings(spark, sf_dir), shared_path(spark, "splits"), ["split"], ["stay_date"])
    kept = spark.read.parquet(path).groupBy("split")
    return rounded(kept.agg(F.count("*").alias("n_rows"), F.sum("adr").alias("adr")), 1, "adr")


@query
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = booking_decisions(*production_weeks(spark, sf_dir))
    path = writers.write_documents(weeks.select("week", "retrain", "reasons"), shared_path(spark, "drift"))
    found = readers.read_drift_results(spark, path)
    return found.groupBy("retrain").agg(F.count("*").alias("n_weeks"), F.sum(F.size("reasons")).alias("n_reasons"))


@query
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    day = F.col("l_shipdate").cast("date").alias("day")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", cents, day, "l_linestatus", "l_returnflag")
    found = hashes.fingerprint(lines, by=["l_returnflag"], portable=True)
    return found.withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hashes.file_checksums(spark, f"{sf_dir}/*.parquet")
    return found.withColumn("path", F.element_at(F.split("path", "/"), -1))


@query
def csv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers that order their columns differently, in one folder, and one that leaves a column out."""
    raw = raw_bookings(spark, sf_dir).drop("row_key")
    names = raw.columns
    path = shared_path(spark, "headers")
    part = F.col("lead_time") % 3
    for k, columns in enumerate([names, names[::-1], [c for c in names if c != "company"]]):
        writers.write_table(raw.where(part == k).select(*columns), f"{path}/w{k}", "csv")
    rows = readers.read_bookings_csv(spark, f"{path}/*").groupBy("hotel", "meal")
    found = rows.agg(
        F.count("*").alias("n"), F.sum("adults").alias("adults"), F.sum("babies").alias("babies"), F.sum("lead_time").alias("lead_time"),
        F.count("company").alias("n_company"), F.max("reservation_status_date").alias("last_day"),
    )
    return found


@query
def csv_quoted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and commas through a CSV file and back."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    said = F.concat(F.lit('he said "'), "event_type", F.lit(', y", and ""'), "props", F.lit('"'))
    path = writers.write_table(events.withColumn("said", said), shared_path(spark, "quoted"), "csv")
    rows = readers.read_csv_text(spark, path, corrupt=readers.CORRUPT).where(F.col(readers.CORRUPT).isNull())
    return rows.select(F.col("event_id").cast("long").alias("event_id"), "event_type", "props", "said")


# --- Validation -------------------------------------------------------------


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """Lines of text with ``header`` before those of every partition, hence of every file."""
    import pyarrow as pa

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    return lines.mapInArrow(run, "value string")


@query
def text_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as a text file with unreadable cells and surplus fields; counts per rule and column."""
    key, raw = F.col("row_key"), raw_bookings(spark, sf_dir)
    text = raw.select("row_key", *[F.col(c).cast("string").alias(c) for c in schema.RAW_COLUMNS])
    children = F.when(key % 101 == 5, "abc").when(key % 101 == 6, "7.5").otherwise(F.col("children"))
    day = F.when(key % 89 == 3, "2020-13-45").otherwise(F.col("reservation_status_date"))
    broken = text.withColumns({
        "children": children, "agent": F.when(key % 103 == 7, "zzz").otherwise(F.col("agent")),
        "reservation_status_date": F.concat(day, F.when(key % 83 == 2, ",surplus").otherwise("")),
    }).select(*schema.RAW_COLUMNS)
    path = shared_path(spark, "broken")
    lines = broken.select(F.array_join(F.array(*broken.columns), ",", "").alias("value"))
    with_header(lines, ",".join(broken.columns)).write.text(path)
    rows = readers.read_csv_text(spark, path, corrupt=readers.CORRUPT)
    report = validation.validation_report(rows, errors_only=False)
    return report.where(F.col("rule").isin("corrupt_record", "data_type", "date")).select("rule", "column", "message", "n_bad")


@query
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validation_report(stored_raw(spark, sf_dir).drop("row_key"), errors_only=False)


@query
def bad_cells_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = cleaning.break_cells(stored_raw(spark, sf_dir), cleaning.BAD_CELLS, "row_key").drop("row_key")
    years = range(1990, 2005)
    domains = {**schema.DOMAINS, "market_segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}
    return validation.validation_report(broken, years=years, domains=domains)


@query
def typed_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_bookings(spark, sf_dir)
    found = validation.count_rules(raw, validation.typed_rules(raw, validation.TYPED_BOOKING))
    return found.select("position", "rule", "column", "n_bad")


@query
def missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.missingness(raw_bookings(spark, sf_dir))


# --- Cleaning ---------------------------------------------------------------

COPY_COLUMNS = ["l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


@query
def duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *COPY_COLUMNS)
    flagged = cleaning.flag_duplicates(lines, COPY_COLUMNS)
    return flagged.select("l_orderkey", "l_linenumber", "is_duplicate")


@query
def duplicate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_totals(table(spark, sf_dir, "lineitem"), COPY_COLUMNS)


@query
def clean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.clean_filter(raw_bookings(spark, sf_dir))
    return rounded(kept.select("row_key", "adr", "adults", "children", "babies"), 4, "adr")


@query
def removal_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning.removal_rate(raw_bookings(spark, sf_dir)), 6, "percent")


@query
def clean_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaned_bookings(spark, sf_dir)
    columns = ["row_id", "hotel", "lead_time", "is_duplicate", "arrival_date", "booking_date", "adr"]
    return rounded(kept.select(*columns), 4, "adr")


@query
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers by day, which many orders share, with the order key as tie-break; cut into ranges."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ranges = 16
    per_range = min(ranking.ROWS_PER_RANGE, max(1, orders.count() // ranges))
    return ranking.row_numbers(orders, "o_orderdate", "o_orderkey", rows_per_range=per_range).select("row_id", "o_orderkey")


@query
def flipped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookings(spark, sf_dir, stays=False).select("row_id", "is_canceled")
    return cleaning.flip_first_labels(rows, "row_id")


# --- Split ------------------------------------------------------------------


@query
def temporal_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = splitting.split_stats(split_bookings(spark, sf_dir), "stay_date")
    return rounded(stats, 6, "percent", "cancellation_rate")


@query
def split_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_order(split_bookings(spark, sf_dir), "stay_date")


@query
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = ["hotel", "segment", "deposit_type", "lead_time", "is_canceled"]
    return splitting.split_overlap(split_bookings(spark, sf_dir), compared)


@query
def split_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookings(spark, sf_dir, stays=False)
    return splitting.completeness(rows, split_bookings(spark, sf_dir))


@query
def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = splitting.manifest(split_bookings(spark, sf_dir), "stay_date")
    entries = document.select("split_method", "train_months", F.explode("splits").alias("split", "entry"))
    found = entries.select(
        "split_method", "train_months", "split", "entry.rows", "entry.start_date", "entry.end_date", "entry.cancellation_rate"
    )
    return rounded(found, 6, "cancellation_rate")


@query
def retrain_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = splitting.retrain_window(bookings(spark, sf_dir, stays=False), CUTOFF, "stay_date")
    stats = splitting.split_stats(window, "stay_date").drop("percent")
    return rounded(stats, 6, "cancellation_rate")


# --- Profile ----------------------------------------------------------------


@query
def rate_by_month_hotel(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = split_bookings(spark, sf_dir).filter(F.col("split") == "train")
    return rounded(profiling.rate_by_month_hotel(train, "stay_date"), 6, "cancellation_rate")


@query
def split_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = {
        "hotel_ASIA_pct": ("hotel", "ASIA"),
        "hotel_EUROPE_pct": ("hotel", "EUROPE"),
        "deposit_URGENT_pct": ("deposit_type", "1-URGENT"),
        "deposit_absent_pct": ("deposit_type", "Non Refund"),
    }
    found = profiling.split_comparison(split_bookings(spark, sf_dir), shares)
    return rounded(found, 6, *shares, "lead_time_mean", "lead_time_median", "cancellation_rate")


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.class_balance(bookings(spark, sf_dir, stays=False)), 6, "share")


@query
def profile_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiling.profile_rate(bookings(spark, sf_dir, stays=False), ["deposit_type", "segment"], measures=["adr"])
    return rounded(rounded(found, 6, "rate", "share"), 3, "adr_mean", "adr_std")


@query
def distinct_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_counts(bookings(spark, sf_dir, stays=False), ["hotel", "stay_date"])


@query
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price quantiles per hotel: nearly every value is distinct, cut into ranges."""
    rows = bookings(spark, sf_dir, stays=False)
    per_range = min(ranking.ROWS_PER_RANGE, max(1, table(spark, sf_dir, "orders").count() // 16))
    levels = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    return rounded(quantiles.exact_quantiles(rows, "adr", levels, ["hotel"], per_range), 4, *levels)


# --- Features and records ---------------------------------------------------


@query
def baseline_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scored_bookings(spark, sf_dir).select("row_id", "p_cancel"), 8, "p_cancel")


@query
def feature_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = features.build_features(cleaned_bookings(spark, sf_dir), keep=["row_id"])
    return rounded(built, 4, "adr")


@query
def features_without_team_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = features.drop_duplicates_from_train(cleaned_bookings(spark, sf_dir))
    built = features.build_features(unique, include_team_decision=False, keep=["row_id"])
    return built.groupBy("hotel", "agent").agg(F.count("*").alias("n"), F.sum("company_missing").alias("no_company"))


@query
def request_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = raw_bookings(spark, sf_dir).drop("babies", "agent", "previous_cancellations")
    filled = records.apply_defaults(sent.select("row_key", *[c for c in sent.columns if c in records.BOOKING_FIELDS]))
    return filled.select("row_key", "children", "babies", "agent", "previous_cancellations", "country", "lead_time")


def incoming_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw bookings with two number fields as text, some of which are no numbers."""
    key = F.col("row_key")
    lead = F.when(key % 67 == 1, "abc").when(key % 67 == 2, "7.5").otherwise(F.col("lead_time").cast("string"))
    adr = F.when(key % 71 == 2, "12,5").otherwise(F.col("adr").cast("string"))
    return raw_bookings(spark, sf_dir).withColumns({"lead_time": lead, "adr": adr})


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: the checks name each column many times, and its expression would be repeated every time
    checked = records.find_problems(cut_lineage(incoming_records(spark, sf_dir), "incoming"))
    return records.problem_rows(records.rejected_rows(checked), "row_key")


@query
def request_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookings(spark, sf_dir, stays=False)
    asked = F.when(F.col("lead_time") % 50 == 0, "EUROPE").otherwise(F.col("hotel"))
    taken = F.when(F.dayofmonth("stay_date") % 7 != 0, F.dayofyear("stay_date") % 9)
    requests = rows.select(
        F.concat_ws("/", asked, F.col("stay_date").cast("string")).alias("request_id"),
        asked.alias("request_hotel"),
        "hotel",
        taken.alias("already_occupied"),
        (F.dayofmonth("stay_date") % 13 - 1).cast("double").alias("adr_ref"),
        F.when(F.dayofmonth("stay_date") % 11 != 0, F.dayofmonth("stay_date") % 5).cast("double").alias("k"),
    )
    checked = records.check_requests(requests, DAY_CONFIG, hotels=["AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"])
    fields = F.array_join(F.transform("problems", lambda x: x["field"]), ",").alias("fields")
    return checked.select("request_id", "n_bookings", "n_other_hotel", "already_occupied", fields)


# --- Occupancy and decision -------------------------------------------------


@query
def arrivals_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.moves_per_day(bookings(spark, sf_dir))


@query
def nightly_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.nightly_occupancy(bookings(spark, sf_dir))


@query
def nightly_occupancy_by_night(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.nightly_occupancy_by_night(bookings(spark, sf_dir))


@query
def capacity_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_capacity(bookings(spark, sf_dir))


@query
def stay_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = occupancy.with_stay(raw_bookings(spark, sf_dir))
    return stays.select("row_key", "stay_date", "length_of_stay", "checkout_date")


@query
def monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(overbooking.monthly_rates(bookings(spark, sf_dir, stays=False)), 8, "rate")


@query
def night_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overbooking.night_summary(scored_bookings(spark, sf_dir))
    return rounded(rounded(found, 6, "mean_p_cancel", "expected_show_ups"), 3, "adr_ref")


def _weekly_backtest(spark: SparkSession, sf_dir: str, policies: list[str], ks: list[float]) -> DataFrame:
    nights = weekly_nights(spark, sf_dir)
    rates = overbooking.monthly_rates(nights)
    return backtest.backtest_policies(nights, WEEK_CONFIG, ks, policies, rates, weekly_capacity(nights), nights=None)


RESULT_COLUMNS = ["revenue", "cost", "profit"]


@query
def backtest_no_overbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly_backtest(spark, sf_dir, ["no_overbook"], [2.0]), 2, *RESULT_COLUMNS)


@query
def backtest_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly_backtest(spark, sf_dir, ["fixed"], [2.0]), 2, *RESULT_COLUMNS)


@query
def backtest_avg_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly_backtest(spark, sf_dir, ["avg_rate"], [2.0]), 2, *RESULT_COLUMNS)


@query
def backtest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly_backtest(spark, sf_dir, ["model"], [1.5, 3.0]), 2, *RESULT_COLUMNS)


@query
def policy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = backtest.summarize(_weekly_backtest(spark, sf_dir, THREE_POLICIES, [2.0]))
    return rounded(rounded(summary, 0, "total_profit"), 6, "moved_per_1000_nights")


@query
def k_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    nights = weekly_nights(spark, sf_dir)
    found = backtest.sensitivity(
        nights,
        WEEK_CONFIG,
        policies=THREE_POLICIES,
        rates=overbooking.monthly_rates(nights),
        capacities=weekly_capacity(nights),
        nights=None,
    )
    return rounded(rounded(found, 0, "total_profit"), 6, "moved_per_1000_nights")


def _best_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nights = weekly_nights(spark, sf_dir)
    capacities = weekly_capacity(nights)
    books = overbooking.night_books(nights, overbooking.book_length(WEEK_CONFIG, capacities), label=None, nights=None)
    sized = overbooking.with_capacity(books, WEEK_CONFIG, capacities)
    level = overbooking.best_level(
        F.col("book.p"), F.col("capacity"), F.col("adr_ref"), F.lit(2.0), WEEK_CONFIG
    )
    found = sized.withColumn("level", level).select(
        "hotel",
        "stay_date",
        "capacity",
        "n_bookings",
        F.col("level.o_star").alias("o_star"),
        F.col("level.expected_cost").alias("expected_cost"),
    )
    return rounded(found, 2, "expected_cost")


@query
def optimal_overbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best level and its expected cost per hotel and week, from the exact distribution of guests."""
    return _best_levels(spark, sf_dir)


@query
def guest_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the number of guests among the bookings that each level accepts, as a native fold."""
    nights = weekly_nights(spark, sf_dir)
    capacities = weekly_capacity(nights)
    length = overbooking.book_length(WEEK_CONFIG, capacities)
    books = overbooking.with_capacity(overbooking.night_books(nights, length, label=None, nights=None), WEEK_CONFIG, capacities)
    levels = books.withColumn("o", F.explode(F.array(F.lit(0), F.lit(1), F.col("capacity"))))
    accepted = F.slice("book.p", 1, F.least(F.size("book"), F.col("capacity") + F.col("o")))
    law = overbooking.exact_guest_law(accepted)
    rows = levels.select("hotel", "stay_date", "o", F.posexplode(law).alias("guests", "probability")).distinct()
    return rounded(rows, 8, "probability")


@query
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level to overbook per hotel and day, given the rooms held by guests of earlier days."""
    rows = decision_table(spark, sf_dir, stays=True, by_property=True)
    capacities = daily_capacity(rows)
    staying = rows.filter((F.col("is_canceled") == 0) & (F.col("length_of_stay") > 1)).select(
        "hotel",
        F.date_add("stay_date", 1).alias("stay_date"),
        (F.col("length_of_stay") - 1).alias("length_of_stay"),
    )
    held = occupancy.nightly_occupancy(staying, canceled=None).select(
        "hotel", F.col("date").alias("stay_date"), F.col("occupancy").cast("int").alias("already_occupied")
    )
    found = overbooking.recommend(rows, DAY_CONFIG, held, capacities, decimals=False)
    return rounded(rounded(rounded(found, 2, "expected_cost", "adr_ref"), 4, "mean_p_cancel"), 1, "expected_show_ups")


def _sequential(spark: SparkSession, sf_dir: str, policies: list[str], ks: list[float]) -> DataFrame:
    rows = decision_table(spark, sf_dir, stays=True, by_property=True)
    return backtest.backtest_sequential(
        rows, DAY_CONFIG, ks, policies, overbooking.monthly_rates(rows), daily_capacity(rows)
    )


@query
def sequential_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_sequential(spark, sf_dir, THREE_POLICIES, [2.0]), 2, *RESULT_COLUMNS)


@query
def sequential_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_sequential(spark, sf_dir, ["model"], [1.5, 3.0]), 2, *RESULT_COLUMNS)


@query
def sequential_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backtest.summarize(_sequential(spark, sf_dir, list(overbooking.POLICIES), [2.0]))
    return rounded(rounded(found, 0, "total_profit"), 6, "moved_per_1000_nights")


# --- Metrics ----------------------------------------------------------------


@query
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five measures for a scored table with very many distinct scores."""
    return rounded(metrics.compute_metrics(scored_lines(spark, sf_dir), keys=["alias"]), 8, *metrics.METRICS)


@query
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_bookings(spark, sf_dir)
    found = metrics.compute_metrics(scored, "is_canceled", "p_cancel", ["split"])
    return rounded(found.select("split", "n_rows", "pr_auc"), 8, "pr_auc")


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_bookings(spark, sf_dir)
    found = metrics.compute_metrics(scored, "is_canceled", "p_cancel", ["split"])
    return rounded(found.select("split", "roc_auc"), 8, "roc_auc")


@query
def log_loss_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_bookings(spark, sf_dir)
    found = metrics.compute_metrics(scored, "is_canceled", "p_cancel", ["hotel"])
    return rounded(found.select("hotel", "log_loss", "brier"), 8, "log_loss", "brier")


@query
def ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.expected_calibration_error(scored_lines(spark, sf_dir), keys=["alias"]), 8, "ece")


@query
def reliability_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.reliability_curve(scored_lines(spark, sf_dir), keys=["alias"]), 8, "prob_pred", "prob_true")


@query
def metrics_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_bookings(spark, sf_dir).withColumn("p_blunt", F.sqrt("p_cancel"))
    found = metrics.metrics_by_column(scored, {"before": "p_blunt", "after": "p_cancel"}, "is_canceled")
    return rounded(found, 8, *metrics.METRICS)


@query
def threshold_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = metrics.with_label(scored_lines(spark, sf_dir))
    return labelled.groupBy("alias", "y", "will_cancel").agg(F.count("*").alias("n"))


# --- Drift and monitoring ---------------------------------------------------


def production_weeks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training rows, and production rows with their week."""
    rows = decision_table(spark, sf_dir, stays=True)
    production = rows.filter(F.col("split") == "production")
    return rows, splitting.with_week(production, "stay_date")


@query
def weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, weeks = production_weeks(spark, sf_dir)
    return rounded(monitoring.weekly_stats(weeks, day="stay_date"), 4, "cancel_rate")


@query
def event_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    weeks = splitting.with_week(events, "ts")
    kept = monitoring.first_weeks(weeks, 3)
    return monitoring.weekly_stats(kept, day="ts", label="is_error")


@query
def prior_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, weeks = production_weeks(spark, sf_dir)
    found = drift.prior_shift(rows.filter(F.col("split") == "train"), weeks, keys=["week"])
    return rounded(found, 8, "reference_rate", "current_rate", "absolute_gap")


def _event_chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = splitting.with_week(table(spark, sf_dir, "events"), "ts")
    reference = events.filter(F.col("week") == 1)
    return reference, drift.with_chunks(events.filter(F.col("week") > 1), "week", "ts", "event_id")


@query
def js_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _event_chunks(spark, sf_dir)
    return rounded(drift.data_drift(reference, current, ["value", "user_id"]), 8, "js_distance")


@query
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _event_chunks(spark, sf_dir)
    return drift.alert_count(drift.data_drift(reference, current, ["value", "user_id"]))


@query
def psi_ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, weeks = production_weeks(spark, sf_dir)
    per_range = min(ranking.ROWS_PER_RANGE, max(1, table(spark, sf_dir, "orders").count() // 8))
    found = drift.column_drift(rows.filter(F.col("split") == "train"), weeks, DRIFT_COLUMNS, rows_per_range=per_range)
    return rounded(found, 8, "psi", "ks", "wasserstein_normed")


@query
def performance_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, weeks = production_weeks(spark, sf_dir)
    found = drift.performance_drift(rows.filter(F.col("split") == "test"), weeks, "is_canceled", "p_cancel")
    return rounded(found, 6, "pr_auc", "ece", "baseline_pr_auc", "baseline_ece", "pr_auc_drop").drop("reasons")


def booking_decisions(rows: DataFrame, weeks: DataFrame) -> DataFrame:
    train, test = (rows.filter(F.col("split") == name) for name in ("train", "test"))
    chunks = drift.with_chunks(weeks, "week", "stay_date", "row_id")
    alerts = drift.alert_count(drift.data_drift(train, chunks, DRIFT_COLUMNS, limit=0.35))
    prior = drift.prior_shift(train, weeks, keys=["week"])
    performance = drift.performance_drift(test, weeks, "is_canceled", "p_cancel")
    return monitoring.retrain_decision(alerts, prior, performance)


@query
def retrain_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = booking_decisions(*production_weeks(spark, sf_dir))
    return found.select("week", "retrain", F.array_join("reasons", "; ").alias("reasons"))


@query
def cooldown_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks in which the cancellation rate is off by more than the limit, through the cooldown."""
    rows, weeks = production_weeks(spark, sf_dir)
    shift = drift.prior_shift(rows.filter(F.col("split") == "train"), weeks, keys=["hotel", "week"], limit=0.15)
    return monitoring.cooldown_actions(shift, keys=["hotel"], signal="triggered")


@query
def weekly_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, weeks = production_weeks(spark, sf_dir)
    stats = monitoring.weekly_stats(weeks, day="stay_date")
    return monitoring.simulation_summary(stats, booking_decisions(rows, weeks))


@query
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate by hotel and month as candidate against the rate by hotel as champion."""
    rows = split_bookings(spark, sf_dir, stays=True).withColumn("month_no", F.month("stay_date"))
    rows = cut_lineage(rows, "gate", ["split"])
    train, test = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")
    capacities = daily_capacity(train.withColumn("hotel", F.col("property")))
    sides = {
        "candidate": features.baseline_predict(train, test, ["hotel", "month_no"]),
        "champion": features.baseline_predict(train, test, ["hotel"]),
    }
    scored = profits = None
    for alias, side in sides.items():
        nights = side.withColumn("hotel", F.col("property"))
        walked = backtest.backtest_sequential(nights, DAY_CONFIG, [2.0], ["model"], capacities=capacities)
        profit = monitoring.total_profit(walked.withColumn("alias", F.lit(alias)))
        labelled = side.select(F.lit(alias).alias("alias"), F.col("is_canceled").alias("y"), F.col("p_cancel").alias("p"))
        scored = labelled if scored is None else scored.unionByName(labelled)
        profits = profit if profits is None else profits.unionByName(profit)
    gate = monitoring.promotion_gate(scored, profits, "2000-05-31")
    flat = gate.select(
        "cutoff",
        "passed",
        F.size("reasons").alias("n_reasons"),
        *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side in sides for name in ("pr_auc", "ece", "brier")],
        F.col("profit.candidate").alias("profit_candidate"),
        F.col("profit.champion").alias("profit_champion"),
    )
    return rounded(flat, 1, "profit_candidate", "profit_champion")


# --- Service levels ---------------------------------------------------------


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status: Column = F.when(F.col("event_type") == "error", 500).when(F.col("user_id") % 10 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "events").select(
        "ts", F.col("event_id").alias("id"), F.col("event_type").alias("path"), status.alias("status"),
        F.col("value").alias("latency_ms"),
    )


@query
def slo_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = service_levels.latency_by_path(request_log(spark, sf_dir), decimals=False)
    levels = rounded(levels, 2, "p50_ms", "p95_ms", "max_ms")
    return service_levels.with_latency_target(levels, 60.0)


@query
def slo_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_levels.service_totals(request_log(spark, sf_dir))


# --- Streams: each equal to its batch form ----------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a feed: files in order of time, one a trigger, so that a short delay is enough and state is dropped."""
    return streams.feed_in_order(table(spark, sf_dir, "events"), shared_path(spark, "events"), "ts", FEED_FILES)


@query
def stream_weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").agg(F.min(F.col("ts").cast("date"))).first()[0]
    stream = _event_stream(spark, sf_dir).withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    weekly = streams.weekly_stats_stream(stream, first, ORDERED_DELAY, label="is_error")
    return rounded(streams.run_available(weekly, "weekly", ["week"]), 6, "cancel_rate")


def shuffled_weeks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, date]:
    """Weekly statistics of a stream whose files are in no order, with a delay far too short, and its late rows."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_type") == "error").cast("int").alias("is_error"))
    first = rows.agg(F.min(F.col("ts").cast("date"))).first()[0]
    source, folder = shared_path(spark, "shuffled"), shared_path(spark, "dealt")
    span = F.pmod(F.xxhash64(F.col("ts").cast("date").cast("string")), F.lit(FEED_FILES))  # whole days come out of order
    rows.repartition(FEED_FILES, span).write.parquet(source)
    stream = streams.read_table_stream(spark, source, rows.schema, files_per_trigger=1)
    streams.split_late(stream, folder, "ts", "1 day", shared_path(spark, "dealt-state")).awaitTermination()
    on_time = streams.on_time_stream(spark, folder, rows.schema)
    weekly = streams.run_available(streams.weekly_stats_stream(on_time, first, "1 day", label="is_error"), "weekly", ["week"])
    return weekly, streams.late_rows(spark, folder, rows.schema), first


@query
def stream_late_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly statistics of a stream with late rows, after the late rows were added."""
    weekly, late, first = shuffled_weeks(spark, sf_dir)
    return rounded(streams.repair_weeks(weekly, late, first, label="is_error"), 6, "cancel_rate")


@query
def stream_service_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    log = _event_stream(spark, sf_dir).select(
        "ts", F.col("event_type").alias("path"), status.alias("status"), F.col("value").alias("latency_ms")
    )
    levels = streams.run_available(streams.service_levels_stream(log, ORDERED_DELAY), "slo", ["path", "window_start"])
    day = F.col("window_start").cast("date").alias("day")
    return levels.select("path", day, "requests", "server_errors_5xx", "p50_ms", "p95_ms", "max_ms")


@query
def stream_sliding_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    log = _event_stream(spark, sf_dir).select(
        "ts", F.col("event_type").alias("path"), status.alias("status"), F.col("value").alias("latency_ms")
    )
    sliding = streams.service_levels_stream(log, ORDERED_DELAY, "2 days", "1 day")
    levels = streams.run_available(sliding, "slo-sliding", ["path", "window_start"])
    day = F.col("window_start").cast("date").alias("day")
    return levels.select("path", day, "requests", "server_errors_5xx", "p50_ms", "p95_ms", "max_ms")


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "incoming")
    raw = incoming_records(spark, sf_dir)
    raw.write.parquet(folder)
    stream = streams.read_table_stream(spark, folder, raw.schema)
    valid, rejected = shared_path(spark, "valid"), shared_path(spark, "rejected")
    streams.quarantine_stream(stream, valid, rejected, shared_path(spark, "quarantine-state")).awaitTermination()
    return records.problem_rows(spark.read.parquet(rejected), "row_key")


@query
def stream_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookings(spark, sf_dir).select("hotel", "stay_date", "length_of_stay", "is_canceled")
    feed = streams.feed_in_order(rows, shared_path(spark, "stays"), "stay_date", FEED_FILES)
    # nights run ahead of the arrivals by the longest stay
    stream = streams.occupancy_stream(feed, "60 days")
    found = streams.run_available(stream, "occupancy", ["hotel", "night"])
    return found.select("hotel", F.col("night").cast("date").alias("date"), "occupancy")


@query
def stream_active_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms taken per property and night from the guests held as state; bookings come in order, days at a time."""
    rows = bookings(spark, sf_dir).select(F.col("property").alias("hotel"), "stay_date", "length_of_stay", "is_canceled")
    folder = shared_path(spark, "arrivals")
    stream = streams.feed_in_order(rows, folder, "stay_date")
    # a canceled booking after the last checkout closes the feed
    last = rows.agg(F.date_add(F.max(F.date_add("stay_date", F.col("length_of_stay"))), 30).alias("stay_date"))
    closing = last.select(F.lit(None).cast("string").alias("hotel"), "stay_date", F.lit(0).alias("length_of_stay"), F.lit(1).alias("is_canceled"))
    closing.select([F.col(f.name).cast(f.dataType) for f in rows.schema]).coalesce(1).write.mode("append").parquet(folder)
    found = streams.active_list_stream(stream, ORDERED_DELAY)
    # every state partition has a Python worker in every batch: one for each core
    parts = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    settings = {"spark.sql.streaming.stateStore.providerClass": streams.ROCKSDB, "spark.sql.shuffle.partitions": str(parts)}
    return streams.run_available(found, "active", settings=settings)


@query
def stream_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decision_table(spark, sf_dir, stays=True)  # both streams are fed from it
    scores = rows.select("row_id", "hotel", "p_cancel", F.col("stay_date").cast("timestamp").alias("score_ts"))
    known = F.date_add("stay_date", F.col("length_of_stay")).cast("timestamp")
    outcomes = rows.select("row_id", "is_canceled", known.alias("outcome_ts"))
    sides = []
    for name, frame, ts in (("scores", scores, "score_ts"), ("outcomes", outcomes, "outcome_ts")):
        sides.append(streams.feed_in_order(frame, shared_path(spark, name), ts, FEED_FILES))
    joined = streams.run_available(streams.late_labels_stream(*sides, ORDERED_DELAY), "labelled")
    found = metrics.compute_metrics(joined, "is_canceled", "p_cancel", ["hotel"])
    return rounded(found.select("hotel", "n_rows", "pr_auc", "ece"), 6, "pr_auc", "ece")


@query
def stream_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, weeks = production_weeks(spark, sf_dir)
    shift = drift.prior_shift(rows.filter(F.col("split") == "train"), weeks, keys=["hotel", "week"], limit=0.15)
    signals = shift.select(F.col("hotel").alias("model"), "week", F.col("triggered").alias("signal"))
    folder = shared_path(spark, "signals")
    signals.write.parquet(folder)
    stream = streams.read_table_stream(spark, folder, signals.schema)
    found = streams.run_available(streams.cooldown_stream(stream), "cooldown")
    return found.select(F.col("model").alias("hotel"), "week", "action")


# --- Models (rows only: Spark ML has no SQL counterpart) --------------------


def model_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned bookings with their split, written once: fitting reads them many times."""
    rows = splitting.temporal_split(cleaned_bookings(spark, sf_dir))
    return cut_lineage(rows.filter(F.col("split") != "production"), "model", ["split"])


@query
def preprocess_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, mean and population deviation of number columns with gaps, missing values filled with the median."""
    found = models.numeric_statistics(raw_bookings(spark, sf_dir), ["lead_time", "adr", "children", "agent", "company", "adults"])
    return rounded(found, 4, "median", "mean", "deviation")


@query
def preprocess_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the levels of later rows are to a model of the training rows."""
    rows = split_bookings(spark, sf_dir)
    train, later = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") != "train")
    return models.level_states(train, later, ["segment", "deposit_type", "property", "lead_time"], min_frequency=5)


@query
def encoded_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level numbers of all later rows, from a table of the training rows' levels; one feature has very many."""
    rows = split_bookings(spark, sf_dir).withColumn("guest", F.concat_ws("-", "property", "lead_time"))
    names = ["segment", "property", "lead_time", "guest"]
    table_ = levels.level_table(rows.filter(F.col("split") == "train"), names, 5)
    later = rows.filter(F.col("split") != "train")
    found = levels.join_levels(later, table_, {f: f for f in names}, {f: f"{f}_at" for f in names})
    return found.select("row_id", *[f"{f}_at" for f in names])


# A small forest: tree, node, feature (adr, lead_time, month), threshold, left, right, value, weight of the tree.
SMALL_FOREST = [
    (0, 0, 0, 150000.0, 1, 2, 0.4, 1.0), (0, 1, 1, 90.0, 3, 4, 0.3, 1.0), (0, 2, -1, None, -1, -1, 0.7, 1.0), (0, 3, -1, None, -1, -1, 0.125, 1.0),
    (0, 4, 2, 6.0, 5, 6, 0.5, 1.0), (0, 5, -1, None, -1, -1, 0.375, 1.0), (0, 6, -1, None, -1, -1, 0.625, 1.0),
    (1, 0, 2, 3.0, 1, 2, 0.45, 2.0), (1, 1, -1, None, -1, -1, 0.25, 2.0), (1, 2, 0, 60000.0, 3, 4, 0.5, 2.0),
    (1, 3, -1, None, -1, -1, 0.0625, 2.0), (1, 4, -1, None, -1, -1, 0.875, 2.0),
]
NODE_COLUMNS = "tree int, node int, feature int, threshold double, lft int, rgt int, value double, weight double"


def forest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_bookings(spark, sf_dir).select("row_id", F.array(F.col("adr"), F.col("lead_time").cast("double"), F.month("stay_date").cast("double")).alias("x"))


@query
def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all bookings by a stored forest."""
    nodes = spark.createDataFrame(SMALL_FOREST, NODE_COLUMNS).withColumn("categories", F.lit(None).cast("array<double>"))
    return rounded(forests.forest_scores(forest_rows(spark, sf_dir), nodes, 3), 6, "p")


@query
def forest_leaf_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What really happened in every leaf of a stored forest: bookings and cancellations against the leaf's value."""
    nodes = spark.createDataFrame(SMALL_FOREST, NODE_COLUMNS).withColumn("categories", F.lit(None).cast("array<double>"))
    ends = forests.leaves(forest_rows(spark, sf_dir), nodes, 3)
    labels = split_bookings(spark, sf_dir).select("row_id", "is_canceled")
    found = ends.join(labels, "row_id").groupBy("tree", "node", "value").agg(F.count("*").alias("n_rows"), F.avg("is_canceled").alias("rate"))
    return rounded(found, 6, "rate")


@query
def logistic_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient of the penalised loss over the training bookings at fixed weights."""
    rows = split_bookings(spark, sf_dir).filter(F.col("split") == "train")
    rows = rows.select("is_canceled", (F.col("adr") / 100000).alias("price"), (F.col("lead_time") / 100).alias("lead"), F.month("stay_date").alias("month"))
    return rounded(models.logistic_gradient(rows, {"price": 0.2, "lead": -0.1, "month": 0.03}, -0.4, penalty=0.01), 6, "gradient")


@query
def isotonic_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated value of every distinct baseline score of the validation rows."""
    rows = scored_bookings(spark, sf_dir).filter(F.col("split") == "validation")
    scored = cut_lineage(rows.select(F.round("p_cancel", 6).alias("p_raw"), "is_canceled"), "validation")
    mapped = models.monotone_map(scored, "is_canceled").transform(scored.select("p_raw").distinct())
    return rounded(mapped.select("p_raw", F.col("prediction").alias("calibrated")), 6, "calibrated")


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuned forest on train, calibrated on validation: metrics on test before and after."""
    splits = model_splits(spark, sf_dir)
    _, effect = models.train_calibrated(splits)
    return effect


@query
def experiment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group-rate baseline and classifiers compared on the validation split."""
    splits = model_splits(spark, sf_dir)
    train, validation = (splits.filter(F.col("split") == name) for name in ("train", "validation"))
    base = features.baseline_predict(train, validation)
    baseline = metrics.compute_metrics(base, schema.TARGET, "p_cancel").withColumn("run", F.lit("baseline"))
    parts = [features.build_features(part.drop("split"), keep=[schema.TARGET]) for part in (train, validation)]
    chosen = models.standard_experiments(parts[0].count())
    table_, _ = models.run_experiments(*parts, chosen)
    return table_.unionByName(baseline, allowMissingColumns=True)


@query
def scored_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated probabilities and labels of all cleaned bookings."""
    splits = cut_lineage(splitting.temporal_split(cleaned_bookings(spark, sf_dir)), "model", ["split"])
    train = splits.filter(F.col("split") == "train").drop("split")
    fitted = models.fit_classifier(
        features.build_features(features.drop_duplicates_from_train(train), keep=[schema.TARGET]),
        models.logistic_regression(train.count()),
    )
    validation = splits.filter(F.col("split") == "validation").drop("split")
    model = models.calibrate(fitted, features.build_features(validation, keep=[schema.TARGET]))
    scored = models.score_bookings(model, splits.drop("split"), lambda rows: features.build_features(rows, keep=["row_id"]))
    return scored.select("row_id", "p_cancel", "will_cancel")
