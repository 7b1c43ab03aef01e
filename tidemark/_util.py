"""Small shared helpers (no Spark jobs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 right_keys: Sequence[str] | None = None) -> Column:
    """Join condition where NULL matches NULL on every key (dplyr default).

    Catalyst plans ``<=>`` as an ordinary equi-join (hash or sort-merge on
    ``coalesce(k, default), isnull(k)``), so this costs no extra shuffle.
    """
    right_keys = list(right_keys or keys)
    cond = None
    for lk, rk in zip(keys, right_keys):
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def any_true(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)


def all_true(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return out if out is not None else F.lit(True)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def common_type(spark, a: str, b: str) -> str:
    """The type that Spark compares values of two types in (analysis only, no job)."""
    if a == b:
        return a
    return spark.range(0).select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("t")).dtypes[0][1]
