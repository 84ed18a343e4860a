"""Equal-width probability bins. The two calibration measures close opposite edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomtide.functions.columns import ColumnLike, as_column


def inner_edges(n_bins: int) -> list[float]:
    """Edges between bins as ``i * (1 / n)``: the products a numeric linspace gives."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def _count_edges(tests: list[Column]) -> Column:
    total = F.lit(0)
    for test in tests:
        total = total + test.cast("int")
    return total


def calibration_error_bin(p: ColumnLike, n_bins: int = 10) -> Column:
    """Bins closed on the left: a score on an edge belongs to the upper bin."""
    p = as_column(p)
    return _count_edges([p >= F.lit(edge) for edge in inner_edges(n_bins)])


def reliability_bin(p: ColumnLike, n_bins: int = 10) -> Column:
    """Bins closed on the right: a score on an edge belongs to the lower bin."""
    p = as_column(p)
    return _count_edges([p > F.lit(edge) for edge in inner_edges(n_bins)])

