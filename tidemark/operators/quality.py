"""Quality checks (QC family).  Each many-column check is ONE aggregate job;
only per-column totals reach the driver when a caller collects them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark._util import all_true, any_true, null_safe_on
from tidemark.session import ensure_checkpoint_dir, scratch_table

_NUM = ("double", "float", "int", "bigint", "smallint", "tinyint")


def _numeric_cols(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in _NUM or t.startswith("decimal")]


def coverage(df: DataFrame, keys: Sequence[str], cols) -> DataFrame:
    """QC-1: number of distinct values of each column per group (dates,
    transects, quadrats ...), named ``n_<col>``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*keys).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in cols])


def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """QC-2: NULL count per column, long form ``(variable, num_missing)``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return wide.unpivot([], cols, "variable", "num_missing")


def zero_summary(df: DataFrame, cols: Sequence[str] | None = None, na_rm: bool = True) -> DataFrame:
    """QC-3: zero count per numeric column, long form ``(variable, num_zeros)``.

    ``na_rm=False`` follows R's ``sum(x == 0)``: any NULL makes the total NULL."""
    cols = list(cols or _numeric_cols(df))
    aggs = []
    for c in cols:
        z = F.count(F.when(F.col(c) == 0, 1))
        if not na_rm:
            z = F.when(F.count(F.when(F.col(c).isNull(), 1)) > 0, F.lit(None).cast("bigint")).otherwise(z)
        aggs.append(z.alias(c))
    return df.agg(*aggs).unpivot([], cols, "variable", "num_zeros")


def violations(df: DataFrame, rules: Mapping[str, Column], mode: str = "rows") -> DataFrame:
    """QC-4: rows breaking any rule (with one flag column per rule), or with
    ``mode='any'`` one row telling whether each rule is ever broken."""
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in rules.items()}
    if mode == "rows":
        return df.withColumns(flags).where(any_true(F.col(n) for n in rules))
    if mode == "any":
        return df.agg(*[F.bool_or(c).alias(n) for n, c in flags.items()])
    if mode == "count":
        return df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()])
    raise ValueError(mode)


def row_invariant(before: DataFrame, after: DataFrame, relation: str = "equal") -> DataFrame:
    """QC-5: one row ``(n_before, n_after, ok)`` from ONE aggregate over the
    two inputs stacked (no join)."""
    both = (before.select(F.lit(1).alias("__b"), F.lit(0).alias("__a"))
            .unionByName(after.select(F.lit(0).alias("__b"), F.lit(1).alias("__a"))))
    cnt = both.agg(F.coalesce(F.sum("__b"), F.lit(0)).cast("long").alias("n_before"),
                   F.coalesce(F.sum("__a"), F.lit(0)).cast("long").alias("n_after"))
    ok = {"equal": F.col("n_before") == F.col("n_after"),
          "not_less": F.col("n_after") >= F.col("n_before"),
          "not_more": F.col("n_after") <= F.col("n_before")}[relation]
    return cnt.select("n_before", "n_after", ok.alias("ok"))


def check_rows(before: DataFrame, after: DataFrame, relation: str = "equal") -> None:
    """Raise when the row invariant fails (one small job)."""
    r = row_invariant(before, after, relation).first()
    if not r["ok"]:
        raise AssertionError(f"row invariant '{relation}' broken: {r['n_before']} -> {r['n_after']}")


def join_coverage(df: DataFrame, col: str, total: str = "total", matched: str = "matched",
                  share: str = "share") -> DataFrame:
    """QC-6: rows, rows with ``col`` present, and their share."""
    return df.agg(F.count(F.lit(1)).alias(total), F.count(col).alias(matched)).withColumn(
        share, F.try_divide(F.col(matched).cast("double"), F.col(total).cast("double")))


def domain(df: DataFrame, col: str) -> DataFrame:
    """QC-7: distinct values of a column."""
    return df.select(col).distinct()


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int,
              keys: Sequence[str] = ()) -> DataFrame:
    """QC-8: equal-width bin counts on [lo, hi] (right edge in the last bin).

    Values below and above the range are counted in bins 0 and ``bins + 1``,
    whose outer edge is NULL; only NULL (and NaN) values are not counted."""
    x = F.col(col).cast("double")
    width = (hi - lo) / bins
    b = (F.floor((x - F.lit(lo)) * F.lit(bins) / F.lit(hi - lo)) + 1).cast("bigint")
    b = F.when(x == F.lit(hi), F.lit(bins)).when(x < F.lit(lo), F.lit(0)).when(x > F.lit(hi), F.lit(bins + 1)).otherwise(b).cast("bigint")
    n = df.where(x.isNotNull() & ~F.isnan(x)).withColumn("bin", b).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    return (n.withColumn("bin_lo", F.when(F.col("bin") > 0, F.lit(lo) + (F.col("bin") - 1) * F.lit(width)))
            .withColumn("bin_hi", F.when(F.col("bin") <= bins, F.lit(lo) + F.col("bin") * F.lit(width))))


def value_ranks(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, x, w, upto): each distinct value with its count and the number of values up to it, per group.

    Values are counted first (partial aggregation: a value that makes up most
    of a group is one row), then the small counted table is cut into ranges of
    (keys, x), summed inside each range, and range offsets are added. The
    ranges are checkpointed, as two branches must see the same ones."""
    keys = list(keys)
    v = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("w"))
    ensure_checkpoint_dir(df.sparkSession)
    v = v.repartitionByRange(*[F.col(k) for k in keys], F.col("x")).withColumn("__p", F.spark_partition_id()).checkpoint(eager=True)
    inside = Window.partitionBy("__p", *keys).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    part = v.groupBy("__p", *keys).agg(F.sum("w").alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    off = part.select(F.col("__p").alias("__po"), *[F.col(k).alias(f"{k}__o") for k in keys], F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__off"))
    cum = v.withColumn("__c", F.sum("w").over(inside))
    on = cum["__p"] == off["__po"]
    if keys:
        on = on & null_safe_on(cum, off, keys, [f"{k}__o" for k in keys])
    return cum.join(off, on).select(*keys, "x", "w", (F.col("__c") + F.col("__off")).alias("upto"))


#: Bins that one pass cuts an interval of values into.
SELECT_BINS = 1 << 18


def _with_group(df: DataFrame, per: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group's row (one row for the table without keys)."""
    if not keys:
        one = F.broadcast(per.withColumn("__two", F.lit(1)))
        return df.withColumn("__one", F.lit(1)).join(one, F.col("__one") == F.col("__two")).drop("__one", "__two")
    p = per.select(*[F.col(k).alias(f"{k}__g") for k in keys], *[c for c in per.columns if c not in keys])
    return df.join(p, null_safe_on(df, p, list(keys), [f"{k}__g" for k in keys])).drop(*[f"{k}__g" for k in keys])


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Number of the bin of [lo, hi] that holds a value, growing with the value; -Infinity before all, Infinity and NaN after."""
    # halved where the width would not be finite; each step is monotone in x
    wide = hi - lo == F.lit(float("inf"))
    part = F.when(wide, F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)).otherwise(F.try_divide(x - lo, hi - lo)) * F.lit(float(bins))
    inner = F.least(F.greatest(F.floor(F.coalesce(part, F.lit(0.0))), F.lit(0)), F.lit(bins - 1))
    return (F.when(F.isnan(x), bins + 1).when(x == F.lit(float("inf")), bins).when(x == F.lit(float("-inf")), -1).otherwise(inner)).cast("int")


def select_ranks(df: DataFrame, keys: Sequence[str], col: str, ranks: Mapping[str, Column], bins: int = SELECT_BINS) -> DataFrame:
    """(keys, n, one column a rank): the values at the given ranks of every group, without sorting the values.

    ``ranks``: name -> expression over ``n`` (number of non-NULL values), from
    1 to n. Radix selection in value space: a pass counts the values of each
    interval that still holds a wanted rank in ``bins`` equal bins (partial
    aggregation: at most ``bins`` + 3 rows a group, however many values), and
    each rank goes on in the one bin that holds it, between the smallest and
    the largest value seen there. Smallest and largest fall into different
    bins, so every pass narrows; a rank is found when they are equal. Usual
    data take two passes. The state between passes, a row a group and rank, is
    written to the shared folder. NaN comes after Infinity, as Spark sorts it.
    """
    keys, names = list(keys), list(ranks)
    x = F.col("__x")
    base = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("__x"))
    usual = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    per = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min(F.when(usual, x)), F.lit(0.0)).alias("lo"), F.coalesce(F.max(F.when(usual, x)), F.lit(0.0)).alias("hi"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), ranks[name].cast("long").alias("r")) for name in names]))
    state = per.where("n > 0").withColumn("__w", wanted).select(*keys, "n", F.col("__w.name").alias("name"), F.col("__w.r").alias("r"), "lo", "hi", F.lit(True).alias("open"))
    state = scratch_table(state, "ranks")
    found, held = state.where("not open"), ~usual
    while not state.where("open").isEmpty():
        now = state.where("open")
        spans = now.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
        data = _with_group(base, spans, keys).withColumn("__all", held)
        # intervals of one group are those of different bins, so a value is in one of them at most; the first holds all
        inside = F.filter("__spans", lambda s: (x >= s["lo"]) & (x <= s["hi"]) | F.col("__all"))
        held = F.lit(False)
        data = data.withColumn("__s", F.get(inside, F.lit(0))).where("__s is not null").select(*keys, "__x", F.col("__s.lo").alias("lo"), F.col("__s.hi").alias("hi"))
        counts = data.withColumn("bin", _bin(x, F.col("lo"), F.col("hi"), bins)).groupBy(*keys, "lo", "hi", "bin").agg(F.count(F.lit(1)).alias("c"), F.min("__x").alias("b_lo"), F.max("__x").alias("b_hi"))
        upto = Window.partitionBy(*keys, "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("upto", F.sum("c").over(upto)).withColumnsRenamed({k: f"{k}__c" for k in keys} | {"lo": "c_lo", "hi": "c_hi"})
        on = [now["lo"] == counts["c_lo"], now["hi"] == counts["c_hi"], now["r"] <= counts["upto"], now["r"] > counts["upto"] - counts["c"]]
        met = now.join(counts, all_true([*on, *([null_safe_on(now, counts, keys, [f"{k}__c" for k in keys])] if keys else [])]))
        state = scratch_table(met.select(*keys, "n", "name", (F.col("r") - F.col("upto") + F.col("c")).alias("r"), F.col("b_lo").alias("lo"), F.col("b_hi").alias("hi"),
                                         (F.col("b_lo") < F.col("b_hi")).alias("open")), "ranks")
        found = found.unionByName(state.where("not open"))
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in names])


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str,
                    probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles (R type 7) per group, from the two ranks around each (:func:`select_ranks`)."""
    keys = list(keys)
    at = {name: (F.col("n") - 1) * F.lit(p) + 1 for name, p in probs.items()}
    ranks = {f"__{side}{i}": fn(h) for i, h in enumerate(at.values()) for side, fn in (("f", F.floor), ("c", F.ceil))}
    got = select_ranks(df, keys, col, ranks)
    out = []
    for i, (name, h) in enumerate(at.items()):
        lo, hi = F.col(f"__f{i}"), F.col(f"__c{i}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return got.select(*keys, "n", *out)


def box_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """QC-9: quartiles, 1.5 IQR whisker ends (most extreme values inside the
    fences) and the number of values outside them, per group: the quartiles
    by selection, the rest in one aggregate over the values."""
    keys = list(keys)
    q = scratch_table(exact_quantiles(df, keys, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}), "quartiles")
    x = F.col("__x")
    values = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("__x"))
    j = _with_group(values, q, keys)
    span = F.col("q3") - F.col("q1")
    inside = (x >= F.col("q1") - 1.5 * span) & (x <= F.col("q3") + 1.5 * span)
    first = [F.max(c).alias(c) for c in ("n", "q1", "median", "q3")]
    return j.groupBy(*keys).agg(*first, F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
                                F.count(F.when(~inside, 1)).alias("n_outliers"))
