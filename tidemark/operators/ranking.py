"""Exact row numbering inside groups that stays balanced when one group is huge.

``Window.partitionBy(keys).orderBy(o)`` puts each group into a single task, so
a group holding a third of the table is sorted by one core.  Here every row is
first given a *slice* id such that slices are ordered consistently with
``(keys, order)`` and no slice is large; rows are numbered inside each
(slice, group), and slice offsets come from a small per-(slice, group) count
table with a cumulative sum.  Result: the same numbers as ``row_number()``
with the work spread over all tasks.

Slice ids must be identical in the two branches that use them (numbering and
offsets), so they are never read from a nondeterministic source twice:

* general order columns: the table is range-partitioned on ``(keys, order)``
  (a large group is cut into many ranges), the partition id is stored as a
  column and the result is checkpointed to the session's checkpoint folder,
  which both branches then read (this also cuts lineage, so a lost executor
  does not force the range sampling to be redone);
* ``hash_col``: when the first order column is a uniform 64-bit hash, the
  slice is a pure function of it (equal-width hash buckets), no checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark._util import as_list, null_safe_on
from tidemark.session import ensure_checkpoint_dir


#: Bytes of input that one slice is meant to hold, and the most slices.
SLICE_BYTES, MAX_SLICES = 64 << 20, 100_000


def _partitions(df: DataFrame, n: int | None) -> int:
    """Slices by the planner's measured size of the input, one a core at least (no job)."""
    if n:
        return n
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(MAX_SLICES, -(-size // SLICE_BYTES)))


def _hash_slice(h: Column, n: int) -> Column:
    """Monotone bucket in [0, n) of a signed 64-bit hash."""
    u = h.cast("double") / F.lit(18446744073709551616.0) + F.lit(0.5)
    return F.least(F.floor(u * F.lit(n)).cast("int"), F.lit(n - 1))


def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rn",
                  num_ranges: int | None = None, hash_col: str | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its ``keys`` group in
    ``order`` (ties broken arbitrarily, like ``row_number``)."""
    keys = as_list(keys)
    order = as_list(order)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n = _partitions(df, num_ranges)
    if hash_col is not None:
        sliced = df.withColumn("__pid", _hash_slice(F.col(hash_col), n))
    else:
        ensure_checkpoint_dir(df.sparkSession)
        sliced = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
                  .withColumn("__pid", F.spark_partition_id())
                  .checkpoint(eager=True))
    local = sliced.withColumn(
        "__lrn", F.row_number().over(Window.partitionBy("__pid", *keys).orderBy(*order_cols)))
    counts = sliced.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0))).drop("__cnt")
    offs = offs.select(F.col("__pid").alias("__pid_o"), *[F.col(k).alias(f"{k}__o") for k in keys], "__off")
    cond = (local["__pid"] == offs["__pid_o"]) & null_safe_on(local, offs, keys, [f"{k}__o" for k in keys])
    j = local.join(offs, cond, "inner")
    return (j.withColumn(out, (F.col("__lrn") + F.col("__off")).cast("long"))
            .drop("__pid", "__lrn", "__pid_o", "__off", *[f"{k}__o" for k in keys]))
