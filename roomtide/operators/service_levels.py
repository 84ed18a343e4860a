"""Service levels of a request log: totals, error rate and latency of the latest requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.operators.ranking import top_rows

# Targets of the service.
P95_TARGET_MS = 350.0
MAX_ERROR_RATE = 0.01
LATEST = 1000
SKIPPED_PATHS = ["/metrics", "/docs", "/openapi.json", "/favicon.ico"]


def latest_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], unique: str, count: int = LATEST
) -> DataFrame:
    """The latest ``count`` rows per key, thinned before the shuffle and again per piece of a large key."""
    return top_rows(df, keys, order, count, unique, rank="_rank").drop("_rank")


def latency_by_path(
    log: DataFrame,
    path: str = "path",
    ts: str = "ts",
    unique: str = "id",
    latency: str = "latency_ms",
    count: int = LATEST,
    decimals: bool = True,
) -> DataFrame:
    """Requests per path, and count, median, 95th percentile and maximum of the latest ``count``."""
    served = log.filter(~F.col(path).isin(SKIPPED_PATHS))
    requests = served.groupBy(F.col(path).alias("path")).agg(F.count("*").alias("requests"))
    latest = latest_rows(served, [path], [F.col(ts).desc(), F.col(unique).desc()], unique, count)
    # exact percentiles: at most `count` values per path
    found = {"p50_ms": F.percentile(latency, 0.5), "p95_ms": F.percentile(latency, 0.95), "max_ms": F.max(latency)}
    levels = latest.groupBy(F.col(path).alias("path")).agg(
        F.count("*").alias("count"),
        *[(F.round(value, 2) if decimals else value).alias(name) for name, value in found.items()],
    )
    return requests.join(levels, "path")


def service_totals(
    log: DataFrame, path: str = "path", status: str = "status", max_error_rate: float = MAX_ERROR_RATE
) -> DataFrame:
    """One row: requests, client and server errors, error rate and whether it is within target."""
    served = log.filter(~F.col(path).isin(SKIPPED_PATHS))
    totals = served.agg(
        F.count("*").alias("total_requests"),
        F.count_if((F.col(status) >= 400) & (F.col(status) < 500)).alias("client_errors_4xx"),
        F.count_if(F.col(status) >= 500).alias("server_errors_5xx"),
    )
    rate = F.coalesce(F.try_divide("server_errors_5xx", "total_requests"), F.lit(0.0))
    return totals.select("*", F.round(rate, 4).alias("error_rate"), (rate <= max_error_rate).alias("error_rate_ok"))


def with_latency_target(levels: DataFrame, target_ms: float = P95_TARGET_MS) -> DataFrame:
    return levels.withColumn("p95_ok", F.col("p95_ms") <= target_ms)
