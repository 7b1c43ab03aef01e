"""Survey metrics (MET family).

Group-level quantities are computed with ``groupBy().agg()`` (partial
aggregation before the shuffle) and joined back where needed, instead of
``Window.partitionBy`` over raw rows, so a very large group is reduced on the
map side rather than sorted in one task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark._util import all_true, null_safe_on
from tidemark.operators.ranking import row_number_by
from tidemark.operators.sites import rule_keys


#: A class column with more values than this is refused when the values are not listed.
MAX_CLASSES = 10_000


def _name_part(v) -> str:
    s = re.sub(r"[^0-9A-Za-z]+", "_", str(v)).strip("_").lower()
    return s or "na"


def _classes(df: DataFrame, cols: Sequence[str], values: Sequence | None, nulls: bool = True) -> list:
    """The classes to make columns of: those listed, else all that occur (NULL last; one job)."""
    if values is not None:
        return list(values)
    one = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("v")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(one) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes; list them")
    found = sorted((r["v"] for r in one if r["v"] is not None), key=str)
    return found + [None] if nulls and any(r["v"] is None for r in one) else found


def _class_names(values: Sequence, stem=lambda part: part) -> dict[int, str]:
    """Column name of each class by position; classes whose names would meet are refused."""
    parts = ["na" if v is None else _name_part(v) for v in values]
    twice = sorted({x for x in parts if parts.count(x) > 1})
    if twice:
        raise ValueError(f"classes give the same column name: {twice}; rename them first")
    return {i: stem(x) for i, x in enumerate(parts)}


def _is_class(c: Column, v) -> Column:
    return c.isNull() if v is None else c == F.lit(v)


def _none_unlisted(cols: Sequence[Column], values: Sequence, unlisted: str, nulls: bool = True) -> Column | None:
    """Aggregate that fails the query if a class is not listed (``unlisted="error"``), NULL included; None for ``"drop"``."""
    if unlisted == "drop":
        return None
    if unlisted != "error":
        raise ValueError("unlisted must be 'error' or 'drop'")
    known = [v for v in values if v is not None]

    def strange(c: Column) -> Column:
        other = ~c.isin(*known) if known else c.isNotNull()
        return F.coalesce(other, F.lit(nulls and None not in values))

    bad = F.max(F.array(*[F.when(strange(c), F.coalesce(c.cast("string"), F.lit("NULL"))) for c in cols]))
    first = F.array_max(bad)
    return F.when(first.isNotNull(), F.raise_error(F.concat(F.lit("class is not listed: "), first)).cast("boolean")).otherwise(F.lit(True))


def _join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", null_keys: bool = True) -> DataFrame:
    """Join on shared key names with NULL matching NULL; one copy of each key.

    ``null_keys=False`` (for keys that are never NULL) joins by plain equality,
    which keeps the partitioning of a frame grouped by the same keys."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"{k}__r") for k in keys],
                     *[c for c in right.columns if c not in keys])
    on = null_safe_on(left, r, keys, [f"{k}__r" for k in keys]) if null_keys else all_true(left[k] == r[f"{k}__r"] for k in keys)
    j = left.join(r, on, how)
    if how in ("full", "full_outer", "outer"):
        j = j.withColumns({k: F.coalesce(F.col(k), F.col(f"{k}__r")) for k in keys})
    return j.drop(*[f"{k}__r" for k in keys])


# ----------------------------------------------------------------- MET-1 ---

def extrapolate(df: DataFrame, spec: Mapping[str, tuple[str, str]], full: float,
                count_default: float | None = 0.0, sampled_default: float | None = None,
                drop_inputs: bool = False) -> DataFrame:
    """Subsampled counts to the full unit: ``count * (full / sampled)``.

    ``spec = {out: (count_col, sampled_col)}``.  Missing count -> ``count_default``
    (None keeps NULL); missing sampled -> ``sampled_default`` (default: ``full``);
    sampled 0 -> NULL (never Inf)."""
    sd = full if sampled_default is None else sampled_default
    out = {}
    for name, (cnt, smp) in spec.items():
        c = F.col(cnt).cast("double")
        if count_default is not None:
            c = F.coalesce(c, F.lit(float(count_default)))
        s = F.coalesce(F.col(smp).cast("double"), F.lit(float(sd)))
        out[name] = c * F.try_divide(F.lit(float(full)), s)
    res = df.withColumns(out)
    if drop_inputs:
        res = res.drop(*{c for pair in spec.values() for c in pair})
    return res


# ----------------------------------------------------------------- MET-2 ---

# Fixed values: (upper end of a range of positions on the 30 m tape, sign, offset) of the metres it stands for.
TAPE_RANGES = ((10, 1, 0), (20, 1, -10), (30, -1, 30))
FULL_SWATH_M = 10.0


def sampled_metres(position: Column) -> Column:
    """Metres sampled: entries that give a position on the tape are mapped range by range, others stay; NULL is a full swath."""
    x = position.cast("double")
    out = x
    for i, (top, sign, offset) in reversed(list(enumerate(TAPE_RANGES))):
        inside = x < top if i == 0 else x <= top
        out = F.when(inside, x * sign + offset).otherwise(out)
    return F.coalesce(out, F.lit(FULL_SWATH_M))


def swath_density(df: DataFrame, count: str, meter: str, out: str = "density_20m2",
                  full: float = 10.0) -> DataFrame:
    """Scale a subsampled swath count to the full 20 m2 swath.  A zero-length
    sample (scalar 0 or infinite) counts as fully sampled (scalar 1)."""
    lin = sampled_metres(F.col(meter))
    scalar = F.try_divide(F.lit(full), lin)
    scalar = F.when(scalar.isNull() | (scalar == 0), F.lit(1.0)).otherwise(scalar)
    return df.withColumn(out, F.col(count).cast("double") * scalar)


# ----------------------------------------------------------------- MET-3 ---

def percent_cover(df: DataFrame, unit_keys: Sequence[str], point_cols: Sequence[str],
                  denominator: str | int = "observed", scale: float = 100.0,
                  values: Sequence[str] | None = None, prefix: str = "cov_",
                  wide: bool = True, unlisted: str = "error") -> DataFrame:
    """Point-contact cover per sampling unit.

    Each class's share of the unit's observed points (or of a fixed
    ``denominator``) times ``scale``; NULL points are not observed, units
    without an observed point are left out. Wide form: ``prefix + class``,
    0 where absent, one aggregate with a conditional count per class and point
    column. ``values`` lists the classes (else one job finds them); a class
    that occurs but is not listed fails the query, or is left out of the
    columns but not of the points with ``unlisted="drop"``."""
    keys, points = list(unit_keys), [F.col(c) for c in point_cols]
    if not wide:
        long = (df.select(*keys, *point_cols).unpivot(keys, list(point_cols), "__pt", "__cls").where(F.col("__cls").isNotNull()))
        per = long.groupBy(*keys, "__cls").agg(F.count(F.lit(1)).alias("__n"))
        if denominator == "observed":
            tot = per.groupBy(*keys).agg(F.sum("__n").alias("__tot"))
            per = _join_on_keys(per, tot, keys, "inner")
            return per.select(*keys, F.col("__cls").alias("class"), (F.col("__n") / F.col("__tot") * F.lit(scale)).alias("cover"))
        return per.select(*keys, F.col("__cls").alias("class"), (F.col("__n") / F.lit(float(denominator)) * F.lit(scale)).alias("cover"))
    vals = _classes(df, point_cols, values, nulls=False)
    names = _class_names(vals, lambda x: f"{prefix}{x}")

    def hits(cond) -> Column:
        return F.sum(sum((F.when(cond(c), 1).otherwise(0) for c in points), F.lit(0)))

    check = _none_unlisted(points, vals, unlisted, nulls=False)
    aggs = [hits(lambda c: c.isNotNull()).alias("__tot")] + ([check.alias("__ok")] if check is not None else [])
    aggs += [hits(lambda c, v=v: _is_class(c, v)).alias(names[i]) for i, v in enumerate(vals)]
    per = df.groupBy(*keys).agg(*aggs).where(F.col("__tot") > 0)
    if check is not None:
        per = per.where("__ok")
    whole = F.col("__tot") if denominator == "observed" else F.lit(float(denominator))
    return per.select(*keys, *[(F.col(n) / whole * F.lit(scale)).alias(n) for n in names.values()])


# ----------------------------------------------------------------- MET-4 ---

def rowwise_share(df: DataFrame, cols: Sequence[str], outputs: Mapping[str, str],
                  na_rm: bool) -> DataFrame:
    """Share of the row's non-NULL point columns equal to each value.

    ``na_rm=False``: any NULL point makes the share NULL (substrate rule);
    ``na_rm=True``: NULL points are ignored (relief rule).  No points -> NULL."""
    n_obs = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    any_null = ~all_true(F.col(c).isNotNull() for c in cols)
    out = {}
    for name, value in outputs.items():
        hits = sum((F.when(F.col(c) == F.lit(value), 1).otherwise(0) for c in cols), F.lit(0))
        share = F.try_divide(hits.cast("double"), n_obs.cast("double"))
        out[name] = share if na_rm else F.when(any_null, F.lit(None).cast("double")).otherwise(share)
    return df.withColumns(out)


# ----------------------------------------------------------------- MET-5 ---

def uncount(df: DataFrame, count_col: str, drop: bool = True) -> DataFrame:
    """One row per counted individual (count <= 0 or NULL -> no row)."""
    n = F.greatest(F.coalesce(F.col(count_col).cast("int"), F.lit(0)), F.lit(0))
    out = df.withColumn("__rep", F.explode(F.array_repeat(F.lit(1), n))).drop("__rep")
    return out.drop(count_col) if drop else out


# ----------------------------------------------------------------- MET-6 ---

def size_stats(df: DataFrame, keys: Sequence[str], species: str, size: str, count: str,
               values: Sequence[str] | None = None, wide: bool = True,
               mean_prefix: str = "sz_mean", sd_prefix: str = "sz_sd", unlisted: str = "error",
               shift: float | None = None) -> DataFrame:
    """Mean and sd of individual sizes per group and species, weighting each
    row by its count (same result as expanding to individuals, no explosion).

    One aggregate of weighted moments about ``shift`` (default: the rounded
    mean size of the table, one small job; it guards against cancellation).
    n <= 1 -> sd NULL. Wide: columns of each listed class (NULL is a class,
    named ``na``); a class that is not listed fails the query or is dropped
    with ``unlisted="drop"``."""
    keys = list(keys)
    base = df.where(F.col(count).isNotNull() & (F.col(count) > 0) & F.col(size).isNotNull())
    if shift is None:
        shift = float(round(base.agg(F.avg(size)).first()[0] or 0.0))
    w, x = F.col(count).cast("double"), F.col(size).cast("double") - F.lit(shift)

    def moments(cond: Column | None) -> tuple[Column, Column, Column]:
        def pick(c: Column) -> Column:
            return F.sum(c if cond is None else F.when(cond, c))

        n, s1, s2 = pick(w), pick(w * x), pick(w * x * x)
        sd = F.when(n > 1, F.sqrt(F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / (n - 1)))
        return n, F.lit(shift) + s1 / n, sd

    if not wide:
        n, mean, sd = moments(None)
        return base.groupBy(*keys, species).agg(n.alias("n"), mean.alias("mean"), sd.alias("sd"))
    vals = _classes(base, [species], values)
    names = _class_names(vals)
    aggs = []
    for i, v in enumerate(vals):
        _, mean, sd = moments(_is_class(F.col(species), v))
        aggs += [mean.alias(f"{mean_prefix}_{names[i]}"), sd.alias(f"{sd_prefix}_{names[i]}")]
    return _listed(base, keys, aggs, [F.col(species)], vals, unlisted)


def _listed(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], cols: Sequence[Column], values: Sequence, unlisted: str) -> DataFrame:
    check = _none_unlisted(cols, values, unlisted)
    if check is None:
        return df.groupBy(*keys).agg(*aggs)
    return df.groupBy(*keys).agg(*aggs, check.alias("__ok")).where("__ok").drop("__ok")


# ----------------------------------------------------------------- MET-7 ---

def plant_stats(df: DataFrame, keys: Sequence[str], value: str, where: Column | None = None,
                n_col: str = "n_plants", mean_col: str = "mean_value",
                sd_col: str = "sd_value") -> DataFrame:
    """Row count, mean and sample sd of ``value`` per group (NULLs ignored in
    mean and sd, counted in n)."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col), F.avg(value).alias(mean_col),
                                 F.stddev_samp(value).alias(sd_col))


# ----------------------------------------------------------------- MET-8 ---

def true_zero_grid(units: DataFrame, n: int | None, metrics: DataFrame, keys: Sequence[str],
                   fill_cols: Sequence[str], index_col: str = "transect",
                   fill: float = 0.0) -> DataFrame:
    """Every unit x index 1..n, metrics left-joined, absent metrics -> 0.

    ``n=None`` takes the largest index of the metrics. A larger (or smaller
    than 1, or NULL) index than the grid has would lose its rows in the join
    and is refused. Only ``fill_cols`` are filled (never the whole table)."""
    lo, hi, nulls = metrics.agg(F.min(index_col), F.max(index_col), F.count(F.when(F.col(index_col).isNull(), 1))).first()
    n = int(hi or 0) if n is None else n
    if nulls or (hi is not None and (hi > n or lo < 1)):
        raise ValueError(f"index {index_col} runs from {lo} to {hi} with {nulls} NULL: the grid is 1..{n}")
    if n < 1:
        grid = units.withColumn(index_col, F.lit(1)).where("false")
    else:
        grid = units.withColumn(index_col, F.explode(F.sequence(F.lit(1), F.lit(n))))
    j = _join_on_keys(grid, metrics, list(keys) + [index_col], "left")
    return j.fillna(fill, subset=list(fill_cols))


# ----------------------------------------------------------------- MET-9 ---

def pivot_density(df: DataFrame, ids: Sequence[str], species: str, value: str,
                  values: Sequence[str] | None = None, agg: str = "sum",
                  prefix: str = "density_", fill: float = 0.0, unlisted: str = "error") -> DataFrame:
    """Long density -> one column per species (NULL is a class, named ``na``);
    duplicates summed (or averaged with ``agg='mean'``); absent -> ``fill``.
    A species that is not listed fails the query, or is dropped with
    ``unlisted="drop"``."""
    f = {"sum": F.sum, "mean": F.avg}[agg]
    vals = _classes(df, [species], values)
    names = _class_names(vals, lambda x: f"{prefix}{x}")
    aggs = [F.coalesce(f(F.when(_is_class(F.col(species), v), F.col(value))), F.lit(fill)).alias(names[i]) for i, v in enumerate(vals)]
    return _listed(df, list(ids), aggs, [F.col(species)], vals, unlisted)


# ---------------------------------------------------------------- MET-10 ---

def clamp(df: DataFrame, part: str, whole: str, out: str | None = None) -> DataFrame:
    """Cap ``part`` at ``whole``; a NULL on either side leaves ``part``."""
    return df.withColumn(out or part,
                         F.when(F.col(part) > F.col(whole), F.col(whole)).otherwise(F.col(part)))


# ---------------------------------------------------------------- MET-11 ---

# Relief is read in 10 cm steps, risk in 5 cm steps, and the
# quadrat diagonal is 141.4 cm.
RELIEF_STEP_CM = 10
RISK_STEP_CM = 5
QUADRAT_DIAGONAL_CM = 141.4


def relief_risk(df: DataFrame, relief: str = "relief", risk: str = "risk") -> DataFrame:
    """``relief_cm``, ``risk_cm`` (with the diagonal) and ``risk_index``."""
    risk_cm = F.col(risk) * RISK_STEP_CM + F.lit(QUADRAT_DIAGONAL_CM)
    return df.withColumns({
        "relief_cm": F.col(relief) * RELIEF_STEP_CM,
        "risk_cm": risk_cm,
        "risk_index": risk_cm - F.lit(QUADRAT_DIAGONAL_CM),
    })


# ---------------------------------------------------------------- MET-12 ---

# Constant added to gonad mass, and the largest credible index.
GONAD_EPS = 0.000001
GONAD_MAX_INDEX = 40


def gonad_index(df: DataFrame, gonad: str = "gonad_mass_g", mass: str = "animal_24hr_mass_g",
                out: str = "gonad_index", eps: float = GONAD_EPS,
                max_index: float = GONAD_MAX_INDEX) -> DataFrame:
    """(gonad + eps) / mass x 100; rows with index >= max or NULL are dropped."""
    g = F.col(gonad) + F.lit(eps)
    res = df.withColumn(gonad, g).withColumn(out, F.try_divide(F.col(gonad), F.col(mass)) * 100)
    return res.where(F.col(out) < max_index)


# ---------------------------------------------------------------- MET-13 ---

def drop_outliers(df: DataFrame, limits: Mapping[str, float] | None = None,
                  all_null_cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where each limited measure is below its limit or NULL, and
    drop rows where every listed measure is NULL."""
    out = df
    for c, lim in (limits or {}).items():
        out = out.where((F.col(c) < lim) | F.col(c).isNull())
    if all_null_cols:
        out = out.where(~all_true(F.col(c).isNull() for c in all_null_cols))
    return out


# ---------------------------------------------------------------- MET-14 ---

def renumber(df: DataFrame, keys: Sequence[str], order: Sequence, keep_where: Column,
             col: str, out: str | None = None) -> DataFrame:
    """Rows matching ``keep_where`` keep ``col``; the others get their position
    (1..n over ALL rows of the group, in ``order``).  Uses the balanced
    :func:`row_number_by`, not a single-task window."""
    ranked = row_number_by(df, keys, order, "__rn")
    return (ranked.withColumn(out or col, F.when(F.coalesce(keep_where, F.lit(False)), F.col(col))
                              .otherwise(F.col("__rn").cast("double")))
            .drop("__rn"))


# ---------------------------------------------------------------- MET-15 ---

def group_summary(df: DataFrame, keys: Sequence[str], n_col: str = "n",
                  means: Mapping[str, str] | None = None, sds: Mapping[str, str] | None = None,
                  props: Mapping[str, Column] | None = None) -> DataFrame:
    """Per-group n, means, sds and proportions (``avg`` of a boolean; NULL
    conditions are ignored like R's ``mean(x == v, na.rm = TRUE)``)."""
    aggs = [F.count(F.lit(1)).alias(n_col)]
    aggs += [F.avg(c).alias(n) for n, c in (means or {}).items()]
    aggs += [F.stddev_samp(c).alias(n) for n, c in (sds or {}).items()]
    aggs += [F.avg(cond.cast("double")).alias(n) for n, cond in (props or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def dissection_summary(df: DataFrame, keys: Sequence[str], index: str = "gonad_index",
                       diameter: str = "test_diameter_mm", height: str = "test_height_mm",
                       mass: str = "animal_24hr_mass_g", gonad: str = "gonad_mass_g",
                       sex: str = "sex") -> DataFrame:
    """MET-15 with the dissection column names."""
    return group_summary(
        df, keys, "n_dissected",
        means={"mean_gonad_index": index, "mean_test_diameter_mm": diameter,
               "mean_test_height_mm": height, "mean_animal_24hr_mass_g": mass,
               "mean_gonad_mass_g": gonad},
        sds={"sd_gonad_index": index},
        props={"prop_female": F.col(sex) == "Female", "prop_male": F.col(sex) == "Male"})


# ------------------------------------------------------------ MET-16..18 ---

def assemble(base: DataFrame, parts: Sequence[tuple[DataFrame, Sequence[str]]],
             keys: Sequence[str], fill: float = 0.0, null_keys: bool = True) -> DataFrame:
    """Left-join each part to ``base`` on ``keys`` (NULL matches NULL) and
    fill only that part's structural-zero columns.

    Parts are expected to be aggregated to one row per key (they are the
    outputs of the metric operators), so the row count of ``base`` is kept.
    With ``null_keys=False`` (keys never NULL) the parts' own partitioning by
    the keys serves the joins: no exchange beyond the base's."""
    out = base
    for part, fill_cols in parts:
        out = _join_on_keys(out, part, keys, "left", null_keys)
        if fill_cols:
            out = out.fillna(fill, subset=list(fill_cols))
    return out


def join_by_year(df: DataFrame, sites: DataFrame, year: str, rules: Mapping[int, Sequence[str]], cols: Sequence[str],
                 site_year: str | None = None) -> DataFrame:
    """Official site columns by a key rule for each survey year.

    ``rules``: year -> the columns that identify a site record that year
    (NULL matches NULL). Site records are those of the same year
    (``site_year``, default the same column name) and are made unique on the
    rule's keys (smallest values of ``cols``). Rows of years without a rule,
    and unmatched rows, keep NULLs; columns of ``df`` named in ``cols`` are
    replaced.

    One equi-join on a struct key serves all rules (:func:`tidemark.operators.sites.rule_key`),
    so ``df`` is read once whatever the number of years; rows of years without a
    rule are dealt over all tasks."""
    cols = list(cols)
    left, right = rule_keys(df, F.col(year), sites, F.col(site_year or year), {y: {c: c for c in keys} for y, keys in rules.items()}, spread=True)
    key, hit = f"__key_{uuid.uuid4().hex}", f"__hit_{uuid.uuid4().hex}"
    records = sites.select(right.alias(key), F.struct(*cols).alias(hit)).where(F.col(key).isNotNull()).groupBy(key).agg(F.min(hit).alias(hit))
    out = df.withColumn(key, left).join(records, key, "left")
    return out.select(*[c for c in df.columns if c not in cols], *[F.col(f"{hit}.{c}").alias(c) for c in cols])


def assemble_margin(base: DataFrame, macro: DataFrame, algae: DataFrame, urchin: DataFrame,
                    size: DataFrame, keys: Sequence[str], macro_fill: Sequence[str],
                    algae_fill: Sequence[str], null_keys: bool = True,
                    sites: tuple[DataFrame, str, Mapping[int, Sequence[str]], Sequence[str]] | None = None,
                    dissection: tuple[DataFrame, Sequence[str]] | None = None) -> DataFrame:
    """MET-16: cover base + macro + algae + urchin + size on (site, date,
    transect, segment), macro and algae zeros filled; then the official site
    columns by year (``sites`` = records, year column, rules, columns) and the
    dissection summary on its own keys."""
    out = assemble(base, [(macro, macro_fill), (algae, algae_fill), (urchin, ()), (size, ())], keys, null_keys=null_keys)
    if sites is not None:
        out = join_by_year(out, *sites)
    if dissection is not None:
        out = _join_on_keys(out, dissection[0], dissection[1], "left")
    return out


def assemble_swath(grid: DataFrame, densities: DataFrame, keys: Sequence[str],
                   fill_cols: Sequence[str], null_keys: bool = True) -> DataFrame:
    """MET-17: zero grid with macro metrics + algae densities, zeros filled."""
    return assemble(grid, [(densities, fill_cols)], keys, null_keys=null_keys)


def assemble_recovery(quadrat: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """MET-18: legacy combined table, plain left joins."""
    return assemble(quadrat, [(p, ()) for p in parts], keys, null_keys=null_keys)


# ---------------------------------------------------------------- MET-19 ---

def mean_all(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
             pivot: str | None = None, pivot_values: Sequence | None = None, unlisted: str = "error") -> DataFrame:
    """Mean of every numeric column per group; with ``pivot``, one column per
    (column, pivot value) named ``<col>_<value>`` (NULL: ``<col>_na``); a value
    that is not listed fails the query, or is dropped with ``unlisted="drop"``."""
    num = ("double", "float", "int", "bigint", "smallint", "tinyint")
    if cols is None:
        cols = [c for c, t in df.dtypes if c not in keys and c != pivot and (t in num or t.startswith("decimal"))]
    cols = list(cols)
    if pivot is None:
        return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])
    vals = _classes(df, [pivot], pivot_values)
    names = _class_names(vals)
    aggs = [F.avg(F.when(_is_class(F.col(pivot), v), F.col(c))).alias(f"{c}_{names[i]}") for i, v in enumerate(vals) for c in cols]
    return _listed(df, list(keys), aggs, [F.col(pivot)], vals, unlisted)


__all__ = ["extrapolate", "swath_density", "sampled_metres", "percent_cover", "rowwise_share",
           "uncount", "size_stats", "plant_stats", "true_zero_grid", "pivot_density", "clamp",
           "relief_risk", "gonad_index", "drop_outliers", "renumber", "group_summary",
           "dissection_summary", "assemble", "join_by_year", "assemble_margin", "assemble_swath",
           "assemble_recovery", "mean_all"]
