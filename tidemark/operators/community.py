"""Community statistics re-expressed as Spark aggregates (COM family).

Sums over rows run on Spark; only p x p or g x g results (covariances, group
means, a handful of statistics) reach the driver, where NumPy solves the small
linear-algebra problems.  No operator here emits pairs of rows: Euclidean
PERMANOVA, dispersion and the SIMPER profile use group sums and centroids.

Permutations are exact relabellings that keep group sizes. Rows are numbered
once; every permutation is a seeded bijection of [0, N) (swap-or-not rounds in
integer arithmetic), so a task computes each of its rows' permuted positions
by itself, and the label follows from the group bounds. Only partial sums per
(permutation, label) are shuffled, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.vector import as_vector, bray_curtis, euclidean
from tidemark.functions.stats import f_tail
from tidemark.operators.ranking import row_number_by
from tidemark.session import ensure_checkpoint_dir, scratch_table, ship_package

# Fixed value: tolerance when counting permuted statistics >= observed.
PERM_EPS = 1.4901161193847656e-08


# ---------------------------------------------------------------- COM-1 ----

def complete_cases(df: DataFrame, cols: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Rows with no NULL among ``cols`` (and ``also``): one ``isnotnull`` per
    column (each constraint names one column, so constraint inference stays
    linear in the number of variables)."""
    return df.dropna(subset=list(cols) + list(also))


def _prepared(df: DataFrame, cols: Sequence[str], also: Sequence[str] = (),
              keep: Sequence[str] = ()) -> DataFrame:
    """Needed columns only, complete cases, checkpointed.

    The statistics below make several passes and self-joins over this
    matrix; checkpointing it to the session's checkpoint folder gives them a
    plain scan to start from (no inherited constraints to re-plan, no lineage
    to recompute after a lost executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    names = list(dict.fromkeys([*keep, *also, *cols]))
    # checkpoint first: the filter then sees plain columns, not the
    # expressions they were computed from
    return complete_cases(df.select(*names).checkpoint(eager=True), cols, also)


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample sd of each column (one aggregate job, 2p numbers)."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def prepare_matrix(df: DataFrame, cols: Sequence[str], scale: bool = True,
                   keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Complete cases on ``cols``, drop constant columns, z-score (optional).

    Returns the prepared frame (``keep`` + kept columns) and the kept names."""
    d = complete_cases(df, cols)
    mom = column_moments(d, cols)
    kept = [c for c in cols if mom[c][1] is not None and mom[c][1] > 0]
    if scale:
        exprs = [((F.col(c) - F.lit(mom[c][0])) / F.lit(mom[c][1])).alias(c) for c in kept]
    else:
        exprs = [F.col(c) for c in kept]
    return d.select(*keep, *exprs), kept


# ---------------------------------------------------------------- COM-2 ----

def group_centroids(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])


def distance_to_centroid(df: DataFrame, group: str, cols: Sequence[str],
                         metric: str = "euclidean", out: str = "distance") -> DataFrame:
    """Distance of each row to its group centroid (the pairwise-distance
    building block that does not need all pairs).

    The centroid table has one row per group; the distance is plain column
    arithmetic (no arrays), which keeps the plan small for many variables."""
    cols = list(cols)
    cen = group_centroids(df, group, cols)
    cen = cen.select(F.col(group).alias("__g"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(cols)])
    j = df.join(cen, df[group].eqNullSafe(cen["__g"]), "inner")
    if metric == "euclidean":
        d = F.sqrt(sum(((F.col(c) - F.col(f"__c{i}")) ** 2 for i, c in enumerate(cols)), F.lit(0.0)))
    elif metric in ("bray", "bray_curtis"):
        num = sum((F.abs(F.col(c) - F.col(f"__c{i}")) for i, c in enumerate(cols)), F.lit(0.0))
        den = sum(((F.col(c) + F.col(f"__c{i}")) for i, c in enumerate(cols)), F.lit(0.0))
        d = F.try_divide(num, den)
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return j.withColumn(out, d).drop("__g", *[f"__c{i}" for i in range(len(cols))])


def pair_distance(df: DataFrame, left: str, right: str, metric: str = "euclidean",
                  out: str = "distance") -> DataFrame:
    """Distance between two vector columns of the same row (for callers that
    already hold the pairs they need)."""
    d = euclidean(left, right) if metric == "euclidean" else bray_curtis(left, right)
    return df.withColumn(out, d)


# ------------------------------------------------------- sums of squares ---

def _group_sums(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))).alias("__s2"),
        *[F.sum(c).alias(f"__s1_{i}") for i, c in enumerate(cols)])


def _ss_expr(p: int) -> Column:
    """Centred sum of squares of one group from its sums."""
    s1sq = sum((F.col(f"__s1_{i}") * F.col(f"__s1_{i}") for i in range(p)), F.lit(0.0))
    return F.col("__s2") - s1sq / F.col("__n")


def _centre(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Subtract global means (limits cancellation in sum-of-squares forms)."""
    mom = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return df.withColumns({c: F.col(c) - F.lit(mom[f"m{i}"]) for i, c in enumerate(cols)})


def _f_stat(sst, ssw, n, g):
    return ((sst - ssw) / (g - 1)) / (ssw / (n - g))


# ---------------------------------------------------------- permutations ---

# Fixed values of the permutation arithmetic (the oracle SQL repeats them): a
# prime modulus, a multiplier, an increment and the number of rounds.
PERM_PRIME, PERM_MULT, PERM_ADD, PERM_ROUNDS = 2147483647, 630360016, 12345, 12

#: Numbers that a task may hold as sums of pairs, and (row, permutation) cells it computes at a time.
_HELD, _CELLS = 1 << 24, 1 << 14

#: Groups whose sizes the driver may hold; more raise an error.
MAX_GROUPS = 10_000


def _sizes(df: DataFrame, group: str) -> list[tuple]:
    """(label, rows) of each non-NULL group in label order; at most ``MAX_GROUPS`` reach the driver."""
    rows = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n")).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    return sorted((r[group], r["n"]) for r in rows)


def _mix(t):
    u = (t * PERM_MULT + PERM_ADD) % PERM_PRIME
    return (u * u + t) % PERM_PRIME


def permuted_position(x, n: int, perm: int, seed: int):
    """Positions of ``x`` (int64 array in [0, n)) under permutation ``perm`` of [0, n)."""
    for r in range(1, PERM_ROUNDS + 1):
        base = _mix(_mix((seed * 1000003 + perm) % PERM_PRIME) + r)
        y = (_mix(base) % n - x) % n
        bit = _mix((np.maximum(x, y) + base) % PERM_PRIME) >> 9 & 1
        x = np.where(bit == 1, y, x)
    return x


def _blocks(batches, limit: int = 1 << 16):
    """Arrow batches joined to blocks of about ``limit`` rows."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _matrix(table, name: str = "__x") -> np.ndarray:
    v = table.column(name).combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def _shipped(df: DataFrame) -> None:
    """Tasks run functions of this module: hand it to the Python workers."""
    ship_package(df.sparkSession)


def _numbered(d: DataFrame, id_col: str, group: str | None) -> DataFrame:
    """``__rank`` = 0-based position in id order, over all rows or inside each group."""
    keys = [group] if group else ["__all"]
    d = d if group else d.withColumn("__all", F.lit(0))
    return row_number_by(d, keys, [id_col], "__rank").withColumn("__rank", F.col("__rank") - 1)


# ---------------------------------------------------------------- COM-3 ----

def permanova(df: DataFrame, group: str, cols: Sequence[str], permutations: int = 999,
              seed: int = 123, id_col: str | None = None) -> DataFrame:
    """One-way PERMANOVA on Euclidean distances via group sums of squares
    (identical to the pair form, no N x N matrix).

    One row: n, groups, df_between, df_within, ss_between, ss_within,
    ss_total, f, r2, p_value (NULL when ``permutations == 0``)."""
    cols = list(cols)
    p = len(cols)
    d = _centre(_prepared(df, cols, [group], [id_col] if id_col else []), cols)
    g_sums = _group_sums(d, [group], cols)
    obs = g_sums.agg(
        F.sum("__n").alias("n"), F.count(F.lit(1)).alias("groups"),
        F.sum(_ss_expr(p)).alias("ss_within"),
        F.sum("__s2").alias("__s2"), *[F.sum(f"__s1_{i}").alias(f"__s1_{i}") for i in range(p)])
    obs = obs.withColumn("ss_total", F.col("__s2") - sum((F.col(f"__s1_{i}") ** 2 for i in range(p)), F.lit(0.0)) / F.col("n"))
    obs = obs.select(
        "n", "groups", (F.col("groups") - 1).alias("df_between"), (F.col("n") - F.col("groups")).alias("df_within"),
        (F.col("ss_total") - F.col("ss_within")).alias("ss_between"), "ss_within", "ss_total",
        _f_stat(F.col("ss_total"), F.col("ss_within"), F.col("n"), F.col("groups")).alias("f"),
        (F.lit(1.0) - F.col("ss_within") / F.col("ss_total")).alias("r2"))
    if permutations <= 0:
        return obs.withColumn("p_value", F.lit(None).cast("double"))
    obs_row = obs.first()
    sizes = _sizes(d, group)
    labels = [v for v, _ in sizes]
    counts = np.array([c for _, c in sizes], np.int64)
    n, bounds = int(counts.sum()), np.cumsum(counts)
    if id_col is None:
        d = d.withColumn("__id", F.monotonically_increasing_id())
        id_col = "__id"
    rows = _numbered(d, id_col, None).select("__rank", F.array(*cols).alias("__x"))
    _shipped(df)

    def partial(batches):
        import pyarrow as pa

        step = max(1, (1 << 22) // (len(labels) * p))
        for block in _blocks(batches):
            x, rank = _matrix(block), block.column("__rank").to_numpy()
            for first in range(1, permutations + 1, step):
                perms = range(first, min(permutations, first + step - 1) + 1)
                sums = np.zeros((len(perms), len(labels), p))
                for k, perm in enumerate(perms):
                    label = np.searchsorted(bounds, permuted_position(rank, n, perm, seed), side="right")
                    order = np.argsort(label, kind="stable")
                    there, at = np.unique(label[order], return_index=True)
                    sums[k, there] = np.add.reduceat(x[order], at, axis=0)
                yield pa.RecordBatch.from_pydict({
                    "perm": pa.array(np.repeat(np.array(perms, np.int32), len(labels))),
                    "label": pa.array(np.tile(np.arange(len(labels), dtype=np.int32), len(perms))),
                    "s": pa.array(list(sums.reshape(-1, p)), pa.list_(pa.float64())),
                })

    part = rows.mapInArrow(partial, "perm int, label int, s array<double>")
    per = part.select("perm", "label", F.posexplode("s").alias("j", "v")).groupBy("perm", "label", "j").agg(F.sum("v").alias("v"))
    size_of = F.element_at(F.array(*[F.lit(float(c)) for c in counts]), F.col("label") + 1)
    per = per.groupBy("perm").agg(F.sum(F.col("v") * F.col("v") / size_of).alias("__b"))
    # the variables are centred: the sum over groups of |sum|^2 / n is the between-group sum of squares
    sst = float(obs_row["ss_total"])
    f_perm = _f_stat(F.lit(sst), F.lit(sst) - F.col("__b"), F.lit(float(n)), F.lit(float(len(labels))))
    ge = per.agg(F.count(F.when(f_perm >= F.lit(float(obs_row["f"]) - PERM_EPS), 1)).alias("ge")).first()["ge"]
    return obs.withColumn("p_value", F.lit((ge + 1) / (permutations + 1.0)))


# ---------------------------------------------------------------- COM-4 ----

def _pair_sums(batches, counts: np.ndarray, p: int, permutations: int, seed: int):
    """Arrow batches of (a, b, perm, s): sums of the rows that permutation ``perm`` deals to the first group of each pair.

    Rows come as (__g, __rank, __x). While the sums of all pairs are few, rows are
    taken in small blocks and the sums go out once at the end; else in larger
    blocks, so that sums go out less often. Positions are computed for about
    ``_CELLS`` (row, permutation) cells at a time: memory does not grow with the rows."""
    import pyarrow as pa

    g = len(counts)
    few = g * (g - 1) // 2 * permutations * p <= _HELD
    held: dict[tuple[int, int], np.ndarray] = {}

    def told(pairs):
        for lo, hi in pairs:
            sums = held.pop((lo, hi))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(np.full(permutations, lo, np.int32)), "b": pa.array(np.full(permutations, hi, np.int32)),
                "perm": pa.array(np.arange(1, permutations + 1, dtype=np.int32)), "s": pa.array(list(sums), pa.list_(pa.float64())),
            })

    for block in _blocks(batches, max(1, (1 << 17) // p) if few else 1 << 16):
        x, rank, own = _matrix(block), block.column("__rank").to_numpy(), block.column("__g").to_numpy()
        for a in np.unique(own).tolist():
            xa, ra = x[own == a], rank[own == a]
            for b in range(g):
                if a == b:
                    continue
                lo, hi = min(a, b), max(a, b)
                n, first = int(counts[lo] + counts[hi]), int(counts[lo])
                at = ra if a == lo else ra + first
                sums = held.setdefault((lo, hi), np.zeros((permutations, p)))
                for r in range(0, len(at), _CELLS):
                    some, step = at[r : r + _CELLS], max(1, _CELLS // len(at))
                    for k in range(1, permutations + 1, step):
                        perms = np.arange(k, min(permutations, k + step - 1) + 1)
                        took = permuted_position(some[None, :], n, perms[:, None], seed + lo * g + hi) < first
                        sums[k - 1 : k - 1 + len(perms)] += took @ xa[r : r + _CELLS]
                # a task's sums go out when they are many, else once at its end
                if len(held) * permutations * p > _HELD:
                    yield from told(list(held))
    yield from told(list(held))


def pairwise_permanova(df: DataFrame, group: str, cols: Sequence[str], permutations: int = 999,
                       seed: int = 123, id_col: str | None = None) -> DataFrame:
    """PERMANOVA for every pair of groups with Bonferroni-adjusted p.

    Observed statistics of all pairs come from the per-group sums (one
    aggregate; the driver holds g x p numbers). For permutations a task
    relabels its own rows inside each of their pairs; only sums per (pair,
    permutation) are shuffled."""
    cols = list(cols)
    p = len(cols)
    d = _centre(_prepared(df, cols, [group], [id_col] if id_col else []), cols)
    sizes = _sizes(d, group)
    labels, counts = [v for v, _ in sizes], np.array([c for _, c in sizes], np.int64)
    g = len(labels)
    sums = {r[group]: r for r in _group_sums(d, [group], cols).collect()}
    s1 = np.array([[sums[v][f"__s1_{i}"] for i in range(p)] for v in labels]).reshape(g, p)
    s2 = np.array([sums[v]["__s2"] for v in labels])
    within = s2 - (s1 * s1).sum(1) / np.maximum(counts, 1)
    stat = {}
    for a in range(g):
        for b in range(a + 1, g):
            n = int(counts[a] + counts[b])
            sst = float(s2[a] + s2[b] - ((s1[a] + s1[b]) ** 2).sum() / n)
            ssw = float(within[a] + within[b])
            f = (sst - ssw) / (ssw / (n - 2)) if n > 2 and ssw > 0 else None
            stat[a, b] = (n, sst, f, 1.0 - ssw / sst if sst > 0 else None)
    ge: dict[tuple, int] = {}
    if permutations > 0 and g > 1:
        if id_col is None:
            d = d.withColumn("__id", F.monotonically_increasing_id())
            id_col = "__id"
        ranked = _numbered(d, id_col, group).select(group, "__rank", F.array(*cols).alias("__x"))
        rows = ranked.withColumn("__g", F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(group)).cast("int") - 1).drop(group)
        _shipped(df)

        def partial(batches):
            return _pair_sums(batches, counts, p, permutations, seed)

        part = rows.mapInArrow(partial, "a int, b int, perm int, s array<double>")
        sums1 = part.select("a", "b", "perm", F.posexplode("s").alias("j", "v")).groupBy("a", "b", "perm", "j").agg(F.sum("v").alias("v"))
        total = df.sparkSession.createDataFrame(
            [(a, b, n, int(counts[a]), float(sst), None if f is None else float(f), [float(t) for t in s1[a] + s1[b]]) for (a, b), (n, sst, f, _) in stat.items()],
            "a int, b int, n long, na long, sst double, f double, tot array<double>")
        j = sums1.join(total, ["a", "b"])
        rest = F.element_at("tot", F.col("j") + 1)
        # sums of squares about the pair's mean: both halves' |sum|^2 / n less |total|^2 / n
        part_b = F.col("v") * F.col("v") / F.col("na") + (rest - F.col("v")) ** 2 / (F.col("n") - F.col("na")) - rest * rest / F.col("n")
        per = j.groupBy("a", "b", "perm").agg(F.sum(part_b).alias("ssb"), F.first("sst").alias("sst"), F.first("n").alias("n"), F.first("f").alias("f"))
        fp = F.try_divide(F.col("ssb"), (F.col("sst") - F.col("ssb")) / (F.col("n") - 2))
        hits = per.groupBy("a", "b").agg(F.count(F.when(fp >= F.col("f") - F.lit(PERM_EPS), 1)).alias("ge")).collect()
        ge = {(r["a"], r["b"]): r["ge"] for r in hits}
    m = len(stat)
    out = []
    for (a, b), (n, _, f, r2) in stat.items():
        pv = (ge.get((a, b), 0) + 1) / (permutations + 1.0) if permutations > 0 else None
        out.append((labels[a], labels[b], n, f, r2, pv, None if pv is None else min(1.0, pv * m)))
    gtype = dict(df.dtypes)[group]
    return df.sparkSession.createDataFrame(
        out, f"group1 {gtype}, group2 {gtype}, n long, f double, r2 double, p_value double, p_adjusted double")


def bonferroni(df: DataFrame, p_col: str = "p_value", out: str = "p_adjusted") -> DataFrame:
    """min(p x m, 1) with m = number of rows (tests), counted first."""
    return df.withColumn(out, F.least(F.col(p_col) * F.lit(float(df.count())), F.lit(1.0)))


# ---------------------------------------------------------------- COM-5 ----

def simper_profile(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Contribution of each variable to the Bray-Curtis dissimilarity between
    the mean profiles of every pair of groups (non-negative input).

    Long output: group1, group2, variable, contribution, share, cumulative
    (variables ordered by contribution).  This is the centroid form of SIMPER;
    the all-row-pairs average is not built (it needs every between-group pair
    of rows)."""
    cols = list(cols)
    cen = scratch_table(group_centroids(_prepared(df, cols, [group]), group, cols).where(F.col(group).isNotNull()), "centroids")
    g = cen.count()
    if g > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    # groups are numbered (at most MAX_GROUPS rows); each meets those of a higher number by an equi-join
    numbered = cen.select(F.row_number().over(Window.orderBy(group)).alias("__i"), F.col(group).alias("__g"), F.array(*[F.col(c).cast("double") for c in cols]).alias("__m"))
    first = numbered.where(F.col("__i") < g).select(F.col("__g").alias("group1"), F.col("__m").alias("__a"), F.explode(F.sequence(F.col("__i") + 1, F.lit(g))).alias("__to"))
    j = first.join(numbered.select(F.col("__i").alias("__to"), F.col("__g").alias("group2"), F.col("__m").alias("__b")), "__to").drop("__to")
    den = F.aggregate(F.zip_with("__a", "__b", lambda x, y: x + y), F.lit(0.0), lambda t, x: t + x)
    gap = F.zip_with("__a", "__b", lambda x, y: F.abs(x - y))
    names = F.array(*[F.lit(c) for c in cols])
    items = F.zip_with(names, gap, lambda v, x: F.struct(v.alias("variable"), x.alias("gap")))
    long = j.withColumn("__den", den).select("group1", "group2", "__den", F.inline(items))
    long = long.select("group1", "group2", "variable", F.try_divide(F.col("gap"), F.col("__den")).alias("contribution"))
    tot = Window.partitionBy("group1", "group2")
    cum = tot.orderBy(F.desc("contribution"), "variable").rowsBetween(Window.unboundedPreceding, 0)
    return (long.withColumn("share", F.try_divide(F.col("contribution"), F.sum("contribution").over(tot)))
            .withColumn("cumulative", F.sum("share").over(cum)))


# ---------------------------------------------------------------- COM-6 ----

def spatial_medians(d: DataFrame, group: str, cols: Sequence[str], iterations: int = 60, tol: float = 1e-9) -> DataFrame:
    """Spatial median of each group by Weiszfeld steps, one aggregate over all groups each.

    Starts at the centroids; a point that coincides with its centre is left
    out of that step. Returns group, n and one column per variable. The driver
    holds g x p numbers (at most ``MAX_GROUPS`` groups)."""
    cols = list(cols)
    cen = group_centroids(d, group, cols)
    now = {r[group]: [r["n"], *[r[c] for c in cols]] for r in cen.limit(MAX_GROUPS + 1).collect()}
    if len(now) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    schema = f"__g {dict(d.dtypes)[group]}, n long, " + ", ".join(f"__c{i} double" for i in range(len(cols)))

    def frame():
        return d.sparkSession.createDataFrame([(k, int(v[0]), *map(float, v[1:])) for k, v in now.items()], schema)

    for _ in range(iterations):
        c = frame().drop("n")
        j = d.join(c, d[group].eqNullSafe(c["__g"]))
        dist = F.sqrt(sum(((F.col(x) - F.col(f"__c{i}")) ** 2 for i, x in enumerate(cols)), F.lit(0.0)))
        j = j.withColumn("__w", F.when(dist > 1e-12, F.lit(1.0) / dist))
        new = j.groupBy("__g").agg(F.sum("__w").alias("__w"), *[F.sum(F.col(x) * F.col("__w")).alias(f"__n{i}") for i, x in enumerate(cols)]).collect()
        moved = 0.0
        for r in new:
            if r["__w"]:
                to = [r[f"__n{i}"] / r["__w"] for i in range(len(cols))]
                moved = max(moved, *(abs(x - y) for x, y in zip(to, now[r["__g"]][1:])))
                now[r["__g"]] = [now[r["__g"]][0], *to]
        if moved <= tol:
            break
    return frame().withColumnsRenamed({"__g": group, **{f"__c{i}": x for i, x in enumerate(cols)}})


def dispersion(df: DataFrame, group: str, cols: Sequence[str], centre: str = "centroid") -> DataFrame:
    """Distances to group centres and a one-way ANOVA on them.

    ``centre``: ``"centroid"`` or ``"median"`` (spatial median). One row per
    group: group, n, mean_distance, plus the shared f, df1, df2 and the p_value
    of f (upper tail of the F distribution). Sums of squares come from merged
    variances, so large offsets do no harm."""
    cols = list(cols)
    d = _centre(_prepared(df, cols, [group]), cols)
    if centre == "centroid":
        dd = distance_to_centroid(d, group, cols, "euclidean", "__d")
    elif centre == "median":
        c = spatial_medians(d, group, cols)
        c = c.select(F.col(group).alias("__g"), *[F.col(x).alias(f"__c{i}") for i, x in enumerate(cols)])
        dist = F.sqrt(sum(((F.col(x) - F.col(f"__c{i}")) ** 2 for i, x in enumerate(cols)), F.lit(0.0)))
        dd = d.join(c, d[group].eqNullSafe(c["__g"])).withColumn("__d", dist).select(group, "__d")
    else:
        raise ValueError(f"unknown centre {centre!r}")
    per = dd.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg("__d").alias("mean_distance"), F.var_pop("__d").alias("__v"))
    per = _checkpointed(per)
    tot = per.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"), F.sum(F.col("n") * F.col("__v")).alias("w"),
                  F.sum(F.col("n") * F.col("mean_distance")).alias("t")).first()
    if not tot["n"]:
        return per.select(group, "n", "mean_distance", F.lit(None).cast("double").alias("f"), F.lit(0).cast("long").alias("df1"), F.lit(0).cast("long").alias("df2"), F.lit(None).cast("double").alias("p_value"))
    grand = tot["t"] / tot["n"]
    ssb = per.agg(F.sum(F.col("n") * (F.col("mean_distance") - F.lit(grand)) ** 2)).first()[0]
    df1, df2 = tot["g"] - 1, tot["n"] - tot["g"]
    f = (ssb / df1) / (tot["w"] / df2) if df1 > 0 and df2 > 0 and tot["w"] else None
    return per.select(group, "n", "mean_distance", F.lit(f).cast("double").alias("f"),
                      F.lit(df1).cast("long").alias("df1"), F.lit(df2).cast("long").alias("df2")).withColumn("p_value", f_tail("f", "df1", "df2"))


def _checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ------------------------------------------------------------- moments -----

def column_means(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return np.array([row[f"m{i}"] or 0.0 for i in range(len(cols))], float)


def scatter(df: DataFrame, cols: Sequence[str], centre: np.ndarray) -> tuple[int, np.ndarray]:
    """Row count and p x p sum of outer products about ``centre``.

    Each task accumulates its rows as one matrix product per Arrow block;
    partial matrices are summed by Spark, so the plan does not grow with p^2."""
    p = len(cols)
    _shipped(df)

    def partial(batches):
        import pyarrow as pa

        n, s = 0, np.zeros((p, p))
        for block in _blocks(batches):
            x = _matrix(block) - centre
            n += len(x)
            s += x.T @ x
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(p, dtype=np.int32)), "n": pa.array(np.full(p, n, np.int64)), "s": pa.array(list(s), pa.list_(pa.float64()))})

    part = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("__x")).mapInArrow(partial, "i int, n long, s array<double>")
    rows = part.select("i", "n", F.posexplode("s").alias("j", "v")).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    out, n = np.zeros((p, p)), 0
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
        n = r["n"]
    return n, (out + out.T) / 2


def _fix_signs(m: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of each column positive."""
    m = m.copy()
    for j in range(m.shape[1]):
        i = int(np.argmax(np.abs(m[:, j])))
        if m[i, j] < 0:
            m[:, j] = -m[:, j]
    return m


def _scored(d: DataFrame, keep: Sequence[str], cols: Sequence[str], centre: np.ndarray, loadings: np.ndarray, prefix: str) -> DataFrame:
    """``keep`` and one score column per loading: dot products with the centred row as one array (small code for many variables)."""
    x = d.select(*keep, F.array(*[F.col(c).cast("double") - F.lit(float(centre[i])) for i, c in enumerate(cols)]).alias("__x"))
    out = []
    for j in range(loadings.shape[1]):
        w = F.array(*[F.lit(float(v)) for v in loadings[:, j]])
        out.append(F.aggregate(F.zip_with("__x", w, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v).alias(f"{prefix}{j + 1}"))
    return x.select(*keep, *out)


# ---------------------------------------------------------------- COM-7 ----

def discriminant(df: DataFrame, group: str, cols: Sequence[str], keep: Sequence[str] = ()):
    """Linear discriminant analysis (the classical Fisher/Rao form).

    Returns ``(scores_df, loadings_df, info)``: scores ``LD1..`` for every row
    (column expressions, computed on Spark), loadings per variable, and the
    proportion of trace of each discriminant."""
    cols = list(cols)
    d = _prepared(df, cols, [group], keep)
    mean = column_means(d, cols)
    shifted = d.select(group, *[(F.col(c) - F.lit(float(mean[i]))).alias(c) for i, c in enumerate(cols)])
    cen = shifted.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols]).limit(MAX_GROUPS + 1).collect()
    if len(cen) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    cen.sort(key=lambda r: r[group])
    levels, g, p = [r[group] for r in cen], len(cen), len(cols)
    n = np.array([r["n"] for r in cen], float)
    means = np.array([[r[c] for c in cols] for r in cen]).reshape(g, p)
    N = n.sum()
    _, total = scatter(shifted, cols, np.zeros(p))
    W = (total - (means * n[:, None]).T @ means) / (N - g)
    f1 = np.sqrt(np.diag(W))
    Ws = W / np.outer(f1, f1)
    evals, evecs = np.linalg.eigh(Ws)
    order = np.argsort(evals)[::-1]
    evals, evecs = evals[order], evecs[:, order]
    rank = int((evals > 1e-4 * evals[0]).sum())
    sphere = (evecs[:, :rank] / np.sqrt(evals[:rank])) / f1[:, None]
    prior = n / N
    xbar = prior @ means
    X = np.sqrt(n * prior / (g - 1))[:, None] * (means - xbar) @ sphere
    _, sv, vt = np.linalg.svd(X, full_matrices=False)
    k = int((sv > 1e-4 * sv[0]).sum())
    scaling = _fix_signs(sphere @ vt.T[:, :k])
    prop = (sv[:k] ** 2) / (sv[:k] ** 2).sum()
    spark = df.sparkSession
    loadings = spark.createDataFrame(
        [(c, *[float(scaling[i, j]) for j in range(k)]) for i, c in enumerate(cols)],
        ["variable"] + [f"LD{j + 1}" for j in range(k)])
    scores = _scored(d, [*keep, group], cols, xbar + mean, scaling, "LD")
    return scores, loadings, {"proportion_of_trace": prop.tolist(), "levels": levels}


# ---------------------------------------------------------------- COM-8 ----

def ordinate(df: DataFrame, cols: Sequence[str], k: int = 2, keep: Sequence[str] = ()):
    """Principal-component ordination (re-aim of NMDS): covariance by one
    aggregate, eigenvectors on the driver, scores ``PC1..k`` as columns.

    Returns ``(scores_df, explained_variance_ratio)``."""
    cols = list(cols)
    d = _prepared(df, cols, (), keep)
    mean = column_means(d, cols)
    N, total = scatter(d, cols, mean)
    cov = total / (N - 1)
    evals, evecs = np.linalg.eigh(cov)
    order = np.argsort(evals)[::-1]
    evals, evecs = evals[order], evecs[:, order]
    load = _fix_signs(evecs[:, :k])
    ratio = (evals[:k] / evals.sum()).tolist()
    return _scored(d, keep, cols, mean, load, "PC"), ratio


#: Rows that carry the scaling of :func:`landmark_ordination`; a table of at most as many rows is scaled exactly.
LANDMARKS = 500


def _profile_distances(x: np.ndarray, to: np.ndarray, metric: str) -> np.ndarray:
    """Distances of each row of ``x`` to each row of ``to``; two empty profiles are alike."""
    if metric == "euclidean":
        return np.sqrt(((x[:, None, :] - to[None, :, :]) ** 2).sum(axis=2))
    apart = np.abs(x[:, None, :] - to[None, :, :]).sum(axis=2)
    both = x.sum(axis=1)[:, None] + to.sum(axis=1)[None, :]
    return np.divide(apart, both, out=np.zeros_like(apart), where=both > 0)


def landmark_ordination(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 2, metric: str = "bray_curtis",
                        landmarks: int = LANDMARKS, seed: int = 123, keep: Sequence[str] = ()):
    """Metric scaling of Bray-Curtis (or Euclidean) distances without a table of pairs.

    The ``landmarks`` rows with the smallest md5 of "id:seed" (a bounded sample,
    the same on every run and at every partitioning) are scaled by double
    centring of their squared distances; every row is then placed by
    triangulation from its distances to them, rows x landmarks of work in
    Arrow batches. Landmarks land where their own scaling puts them, so a table
    of at most ``landmarks`` rows has the exact classical scaling.

    Returns ``(scores, info)``. Scores: ``id_col``, ``keep``, ``MDS1..k`` (0 where
    the distances have fewer positive eigenvalues) and ``misfit``, the root of
    the squared difference between a row's distances to the landmarks and those in the
    ordination, as a share of the former. Info: ``eigenvalues`` of the landmarks
    (all, descending), ``landmarks``, ``stress`` (the same share over all rows).
    Rows with NULLs in ``cols`` are left out as in the other statistics; repeated
    rows land on one place; negative values fail for Bray-Curtis; a table without
    complete rows gives no scores, no eigenvalues and stress None."""
    if metric not in ("bray_curtis", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    cols, keep = list(cols), [c for c in keep if c != id_col]
    axes = [f"MDS{j + 1}" for j in range(k)]
    if clash := {*axes, "misfit", "__x", "__o", "__off", "__all"} & {id_col, *keep}:
        raise ValueError(f"columns to keep are called like those made here: {sorted(clash)}")
    d = complete_cases(df, cols)
    x = F.array(*[F.col(c).cast("double") for c in cols])
    if metric == "bray_curtis":
        x = F.when(F.exists(x, lambda v: v < 0), F.raise_error(F.lit("Bray-Curtis needs values of at least 0"))).otherwise(x)
    d = scratch_table(d.select(id_col, *keep, x.alias("__x")), "profiles")
    order = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))
    sample = d.select(order.alias("__o"), "__x").orderBy("__o", "__x").limit(landmarks).collect()
    marks = np.array([r["__x"] for r in sample], float).reshape(len(sample), len(cols))
    squares = _profile_distances(marks, marks, metric) ** 2
    mean = squares.mean(axis=0) if len(marks) else np.zeros(0)
    total = mean.mean() if len(marks) else 0.0
    evals, evecs = np.linalg.eigh(-(squares - mean[:, None] - mean[None, :] + total) / 2)
    evals, evecs = evals[::-1], _fix_signs(evecs[:, ::-1]) if len(marks) else evecs
    used = [j for j in range(min(k, len(evals))) if evals[j] > 1e-12 * max(abs(evals[0]), 1e-300)]
    # a row's coordinates are half the centred squared distances times the scaled eigenvectors
    turn = np.zeros((len(marks), k))
    for j in used:
        turn[:, j] = evecs[:, j] / math.sqrt(evals[j])
    placed = (mean[None, :] - squares) @ turn / 2
    _shipped(df)

    def place(batches):
        import pyarrow as pa

        step = max(1, (1 << 21) // max(1, marks.size))
        for batch in batches:
            rows, scores, parts = _matrix(pa.Table.from_batches([batch])), [], []
            for lo in range(0, len(rows), step):
                far = _profile_distances(rows[lo : lo + step], marks, metric)
                at = (mean[None, :] - far**2) @ turn / 2
                near = _profile_distances(at, placed, "euclidean")
                scores.append(at)
                parts.append(np.stack([((far - near) ** 2).sum(axis=1), (far**2).sum(axis=1)], axis=1))
            at, part = np.concatenate(scores or [np.zeros((0, k))]), np.concatenate(parts or [np.zeros((0, 2))])
            made = [*(at[:, j] for j in range(k)), part[:, 0], part[:, 1]]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), *map(pa.array, made)], names=[*batch.schema.names[:-1], *axes, "__off", "__all"])

    schema = T.StructType([*d.schema.fields[:-1], *(T.StructField(c, T.DoubleType()) for c in [*axes, "__off", "__all"])])
    rows = scratch_table(d.mapInArrow(place, schema), "scores")
    off, whole = rows.agg(F.sum("__off"), F.sum("__all")).first()
    scores = rows.select(id_col, *keep, *axes, F.sqrt(F.try_divide(F.col("__off"), F.col("__all"))).alias("misfit"))
    return scores, {"eigenvalues": evals.tolist(), "landmarks": len(marks), "stress": None if not whole else math.sqrt(off / whole)}


# ---------------------------------------------------------------- COM-9 ----

def group_shape(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Centroid and 2 x 2 covariance of two score columns per group (the
    data behind normal-theory ellipses)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
        F.var_samp(x).alias("var_x"), F.var_samp(y).alias("var_y"), F.covar_samp(x, y).alias("cov_xy"))


# --------------------------------------------------------------- COM-10 ----

#: Rows that a permutation of COM-10 mixes: strata of this many rows are permuted each by itself.
STRATUM_ROWS = 1 << 16


def vector_fit(df: DataFrame, axes: Sequence[str], variables: Sequence[str], permutations: int = 999,
               seed: int = 123, id_col: str | None = None, stratum_rows: int = STRATUM_ROWS) -> DataFrame:
    """Fit each variable as a direction in the ordination plane.

    Each variable is regressed on the (centred) axes; output per variable:
    unit direction on each axis, r2, and the permutation p of r2 (the
    variable values are permuted jointly across rows).

    Two levels keep the shuffle in proportion to the rows, not to rows x
    permutations: rows are numbered and dealt round-robin into strata of at
    most ``stratum_rows`` rows, each row moves once, into its stratum, and all
    permutations are bijections inside a stratum. Only cross moments leave it.
    A table of one stratum is permuted freely. With more strata the
    permutations are a subgroup of all of them (rows of different strata never
    change places), for which the test is exact as well."""
    axes, variables = list(axes), list(variables)
    d = _prepared(df, axes + variables, (), [id_col] if id_col else [])
    cols = axes + variables
    d = _centre(d, cols)
    q, v = len(axes), len(variables)
    _, S = scatter(d, cols, np.zeros(q + v))
    Sxx = S[:q, :q]
    Sxv = S[:q, q:]
    Svv = np.diag(S[q:, q:])
    B = np.linalg.solve(Sxx, Sxv)                    # q x v coefficients
    r2 = (B * Sxv).sum(axis=0) / Svv
    heads = B / np.linalg.norm(B, axis=0)
    pvals = [None] * v
    if permutations > 0:
        if id_col is None:
            d = d.withColumn("__id", F.monotonically_increasing_id())
            id_col = "__id"
        canon = _numbered(d, id_col, None)
        n = canon.count()
        strata = -(-n // stratum_rows)
        _shipped(df)

        def moved(key, table):
            """Cross moments of one stratum under every permutation of its rows."""
            import pyarrow as pa

            own = key[0].as_py()
            at = table.column("__at").to_numpy()
            order = np.argsort(at)
            ax, va = _matrix(table, "__a")[order], _matrix(table, "__v")[order]
            size, place = len(at), np.arange(len(at))
            # strata are dealt permutations of their own; a single one has those of the whole table
            own_seed = seed + own * 7919
            sums = np.stack([ax.T @ va[permuted_position(place, size, perm, own_seed)] for perm in range(1, permutations + 1)])
            return pa.table({"perm": pa.array(np.arange(1, permutations + 1, dtype=np.int32)), "c": pa.array(list(sums.reshape(permutations, -1)), pa.list_(pa.float64()))})

        dealt = canon.select((F.col("__rank") % strata).cast("int").alias("__stratum"), F.floor(F.col("__rank") / strata).alias("__at"), F.array(*axes).alias("__a"), F.array(*variables).alias("__v"))
        part = dealt.groupBy("__stratum").applyInArrow(moved, "perm int, c array<double>")
        per = part.groupBy("perm").agg(*[F.sum(F.get("c", F.lit(i * v + k))).alias(f"c_{i}_{k}") for i in range(q) for k in range(v)])
        Sinv = np.linalg.inv(Sxx)
        # r2_perm = c' Sxx^-1 c / Svv for each variable, as column arithmetic
        counts = []
        for k in range(v):
            quad = sum((F.col(f"c_{i}_{k}") * F.col(f"c_{l}_{k}") * F.lit(float(Sinv[i, l]))
                        for i in range(q) for l in range(q)), F.lit(0.0))
            counts.append(F.count(F.when(quad / F.lit(float(Svv[k])) >= F.lit(float(r2[k]) - PERM_EPS), 1)).alias(f"g{k}"))
        row = per.agg(*counts).first()
        pvals = [(row[f"g{k}"] + 1) / (permutations + 1.0) for k in range(v)]
    rows = [(variables[k], *[float(heads[i, k]) for i in range(q)], float(r2[k]),
             None if pvals[k] is None else float(pvals[k])) for k in range(v)]
    return df.sparkSession.createDataFrame(
        rows, ["variable"] + [f"dir_{a}" for a in axes] + ["r2", "p_value"])


# --------------------------------------------------------------- COM-11 ----

#: Growth rates tried first, times the reach of x from its mean: both signs, evenly spaced in the logarithm, and zero.
_RATE_GRID = [0.0, *(sign * 1e-3 * (300 / 1e-3) ** (k / 56) for k in range(57) for sign in (-1.0, 1.0))]
_RATE_CELLS = 32


def _rate_moments(pts: DataFrame, rates: Sequence[float], x_mean: float) -> list[tuple[float, float, float]]:
    """(rate, R2, slope of R2 up to a positive factor) of the best curve of each growth rate, ascending.

    The curve is a + b u with u = (exp(c z) - 1) / c, z = x - mean, which turns
    into the straight line as c goes to zero; a and b of each rate follow from
    variances and covariances, all rates in one aggregate."""
    z, c, y = F.col("x") - F.lit(x_mean), F.col("c"), F.col("y")
    t = c * z
    u = F.when(c == 0, z).otherwise(F.expm1(t) / c)
    w = F.when(F.abs(t) < 1e-4, z * z * (F.lit(0.5) + t / 3 + t * t / 8)).otherwise((z * F.exp(t) - F.col("u")) / c)
    every = pts.select("x", "y", F.explode(F.array(*[F.lit(float(r)) for r in rates])).alias("c"))
    per = every.withColumn("u", u).withColumn("w", w).groupBy("c").agg(
        F.var_pop("u").alias("uu"), F.var_pop(y).alias("yy"), F.covar_pop("u", "y").alias("uy"), F.covar_pop("w", "y").alias("wy"), F.covar_pop("u", "w").alias("uw"))
    return sorted((r["c"], r["uy"] ** 2 / (r["uu"] * r["yy"]), r["uy"] / r["uu"] * (r["wy"] - r["uy"] / r["uu"] * r["uw"])) for r in per.collect())


def _cell(at: list[tuple[float, float, float]]) -> int:
    """Index i such that the best rate lies between at[i] and at[i + 1]."""
    best = max(range(len(at)), key=lambda i: at[i][1])
    return min(max(best if at[best][2] > 0 else best - 1, 0), len(at) - 2)


def fit_exponential(df: DataFrame, x: str, y: str, start: tuple[float, float, float] | None = None) -> DataFrame:
    """Least-squares fit of ``y = a + b * exp(c * x)`` by variable projection.

    For a given growth rate c the best a and b are a straight-line fit, so only
    c is searched: one aggregate gives R2 and its slope for 115 rates between
    -300 and 300 over the reach of x, the best cell is cut into 32 twice, and the
    zero of the slope is interpolated. The points are written once and read by
    six aggregates, whatever the data; no start is needed (the rate of
    ``start`` is one more that is tried).

    One-row result: a, b, c, rss, tss, r2, n_points, iterations (aggregates over
    all points), converged. Rows with NULL or NaN in x or y are left out. Fewer
    than three points or a constant x or y give NULLs; data that no curve fits
    better than a straight line (c within 1e-9 of zero over the reach of x) or a
    step (the outermost rates) are told by ``converged`` false, the line with c 0
    and NULL a and b."""
    pts = scratch_table(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(), "points")
    schema = "a double, b double, c double, rss double, tss double, r2 double, n_points long, iterations int, converged boolean"
    m = pts.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.var_pop("y").alias("yy")).first()
    n = m["n"]
    if n < 3 or m["lo"] == m["hi"] or m["yy"] == 0:
        return df.sparkSession.createDataFrame([(None, None, None, None, None if n == 0 else n * m["yy"], None, n, 1, False)], schema)
    reach = max(m["hi"] - m["x"], m["x"] - m["lo"])
    rates = {r / reach for r in _RATE_GRID}
    if start is not None and abs(start[2]) * reach < 300:
        rates.add(float(start[2]))
    at = _rate_moments(pts, sorted(rates), m["x"])
    best = max(at, key=lambda r: r[1])[0]
    inside = at[0][0] < best < at[-1][0]
    i = _cell(at)
    lo, hi = at[i][0], at[i + 1][0]
    for _ in range(2):
        at = _rate_moments(pts, list(np.linspace(lo, hi, _RATE_CELLS + 1)), m["x"])
        i = _cell(at)
        lo, hi = at[i][0], at[i + 1][0]
    # the slope falls through zero inside the cell: inverse interpolation through the four rates around it
    near = at[max(0, min(i - 1, len(at) - 4)) :][:4]
    c = max(at[i], at[i + 1], key=lambda r: r[1])[0]
    if at[i][2] > 0 >= at[i + 1][2]:
        g = [r[2] for r in near]
        if all(p > q for p, q in zip(g, g[1:])):
            c = sum(near[j][0] * float(np.prod([g[k] / (g[k] - g[j]) for k in range(4) if k != j])) for j in range(4))
        c = min(max(c, lo), hi)
    straight = abs(c) * reach < 1e-9
    c = 0.0 if straight else float(c)
    z = F.col("x") - F.lit(m["x"])
    u = z if straight else F.expm1(F.lit(c) * z) / F.lit(c)
    r = pts.select("y", u.alias("u")).agg(F.var_pop("u").alias("uu"), F.covar_pop("u", "y").alias("uy"), F.avg("u").alias("u")).first()
    slope = r["uy"] / r["uu"]
    level = m["y"] - slope * r["u"]
    rss = pts.agg(F.sum(F.pow(F.col("y") - F.lit(level) - F.lit(slope) * u, F.lit(2.0)))).first()[0]
    tss = n * m["yy"]
    b = None if straight else slope / c * math.exp(-c * m["x"])
    a = None if straight else level - slope / c
    return df.sparkSession.createDataFrame([(a, b, c, float(rss), float(tss), 1.0 - rss / tss, n, 6, bool(inside and not straight))], schema)


def exponential_residuals(df: DataFrame, x: str, y: str, fit: DataFrame, fitted: str = "fitted", residual: str = "residual") -> DataFrame:
    """Rows of ``df`` with the fitted value and residual of a ``fit_exponential`` result (NULL where x or y is)."""
    r = fit.first()
    at = F.lit(r["a"]) + F.lit(r["b"]) * F.exp(F.lit(r["c"]) * F.col(x).cast("double"))
    return df.withColumn(fitted, at).withColumn(residual, F.col(y).cast("double") - at)
