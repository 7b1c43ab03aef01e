"""Vector expressions over ``array<double>`` columns (higher-order functions,
no Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark._util import col_of


def as_vector(cols: Sequence[str]) -> Column:
    """Pack numeric columns into one ``array<double>``."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a, b) -> Column:
    """Euclidean distance of two equal-length vectors."""
    sq = F.zip_with(col_of(a), col_of(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(_sum(sq))


def bray_curtis(a, b) -> Column:
    """Bray-Curtis dissimilarity sum|x-y| / sum(x+y) (non-negative input);
    two empty profiles -> NULL."""
    num = _sum(F.zip_with(col_of(a), col_of(b), lambda x, y: F.abs(x - y)))
    den = _sum(F.zip_with(col_of(a), col_of(b), lambda x, y: x + y))
    return F.try_divide(num, den)


def distance(a, b, metric: str = "euclidean") -> Column:
    if metric == "euclidean":
        return euclidean(a, b)
    if metric in ("bray", "bray_curtis"):
        return bray_curtis(a, b)
    raise ValueError(f"unknown metric {metric!r}")
