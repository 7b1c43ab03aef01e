"""Site tables and year-aware site resolution (SITE family)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark._util import col_of, common_type, null_safe_on
from tidemark.functions.text import parse_date, standardize_code
from tidemark.operators.normalize import cast_columns, null_tokens


def effective(revisit, original) -> Column:
    """SITE-3: the revisit value when present, else the original."""
    r = F.col(revisit) if isinstance(revisit, str) else revisit
    o = F.col(original) if isinstance(original, str) else original
    return F.coalesce(r, o)


def build_margin_sites(df: DataFrame, names: Sequence[str] = ("site_name_2024", "site_name_2025"),
                       required: str = "site_name_2025") -> DataFrame:
    """SITE-1: typed margin site table with standard names, the effective
    survey date (resite date if any) and actual-else-target coordinates."""
    d = cast_columns(df, {
        "transect": "double", "heading_out": "double",
        "target_latitude": "double", "target_longitude": "double",
        "actual_latitude": "double", "actual_longitude": "double",
        "date_surveyed": "date", "resite_date": "date"})
    d = d.where(F.col(required).isNotNull())
    d = d.withColumns({n: standardize_code(n) for n in names})
    return d.select(
        "survey_type", "region", *names, "transect", "heading_out",
        effective("actual_latitude", "target_latitude").alias("latitude"),
        effective("actual_longitude", "target_longitude").alias("longitude"),
        effective("resite_date", "date_surveyed").alias("survey_date"),
        F.col("date_surveyed").alias("date_surveyed_originally"))


def build_recovery_sites(df: DataFrame, years: Sequence[int] = (2024, 2025),
                         date_formats: Mapping[int, Sequence[str]] | None = None,
                         tokens: Sequence[str] = ("NULL",)) -> DataFrame:
    """SITE-2: recovery site table: token NULLs, numeric coordinates, the
    official survey date per year (resite date if any, else the original)
    and standard site names."""
    fmts = date_formats or {2024: ("yyyy-M-d",), 2025: ("M/d/yyyy",)}
    d = null_tokens(df, tokens)
    d = cast_columns(d, {c: "double" for c in ("old_latitude", "old_longitude",
                                               "new_latitude", "new_longitude")})
    cols = {}
    for y in years:
        f = fmts.get(y, ("yyyy-M-d", "M/d/yyyy"))
        cols[f"survey_date_{y}"] = effective(parse_date(f"resite_date_{y}", f),
                                             parse_date(f"original_date_surveyed_{y}", f))
        cols[f"site_name_{y}"] = standardize_code(f"site_name_{y}")
    d = d.withColumns(cols)
    sel = ["survey_type", "region"]
    for y in sorted(years, reverse=True):
        sel += [f"site_name_{y}", f"site_type_{y}"]
    return d.select(*sel, F.col("transect").alias("zone"),
                    F.col("new_latitude").alias("latitude"), F.col("new_longitude").alias("longitude"),
                    F.col("old_latitude").alias("latitude_old"), F.col("old_longitude").alias("longitude_old"),
                    *[f"survey_date_{y}" for y in years])


def rule_key(year: Column, fields: Mapping[str, Column], rules: Mapping[int, Sequence[str]], spread: Column | None = None) -> Column:
    """One struct key for the rules of all years: the year and the fields that its rule uses, NULL for the rest.

    Rows of one year meet by plain equality of the struct, in which NULL
    fields are equal; a row of a year without a rule has a NULL key and meets
    none. Both tables of a join build it with the same field names and types.

    With ``spread`` (a non-NULL bigint) a row without a rule gets a key of that
    number alone: it still meets none, as the number is NULL in every other
    key, and such rows do not all land in one task of an outer join."""
    no_number = F.lit(None).cast("bigint").alias("spread")
    parts = [(name, F.when(year.isin(*[y for y, used in rules.items() if name in used]), c)) for name, c in sorted(fields.items())]
    ruled = F.struct(year.cast("bigint").alias("year"), *[c.alias(name) for name, c in parts], no_number)
    key = F.when(year.isin(*rules), ruled) if rules else F.lit(None).cast("struct<year:bigint,spread:bigint>")
    if spread is None:
        return key
    # the fields are NULL here, as they are in no rule of the row's year
    return F.coalesce(key, F.struct(F.lit(None).cast("bigint").alias("year"), *[c.alias(name) for name, c in parts], spread.cast("bigint").alias("spread")))


def _row_hash(df: DataFrame) -> Column:
    """A number of the row's values (of all columns that can be hashed)."""
    names = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in names]) if names else F.lit(0)


def rule_keys(df: DataFrame, year: Column, sites: DataFrame, site_year: Column, rules: Mapping[int, Mapping[str, str]],
              spread: bool = False) -> tuple[Column, Column]:
    """The rule key over the data and over the site table, for rules year -> {data column: site column}.

    ``spread``: data rows of years without a rule get keys of their own, for joins that keep them."""
    pairs = sorted({p for on in rules.values() for p in on.items()})
    data_types, site_types = dict(df.dtypes), dict(sites.dtypes)
    kinds = {p: common_type(df.sparkSession, data_types[p[0]], site_types[p[1]]) for p in pairs}
    used = {y: [f"k{pairs.index(p)}" for p in on.items()] for y, on in rules.items()}
    left, right = ({f"k{i}": F.col(f"`{p[side]}`").cast(kinds[p]) for i, p in enumerate(pairs)} for side in (0, 1))
    return rule_key(year, left, used, _row_hash(df) if spread else None), rule_key(site_year, right, used)


def resolve_by_year(df: DataFrame, sites: DataFrame, date_col: str, rules: Mapping[int, Mapping[str, str]],
                    take: Mapping[str, str], site_year: Column | str, unmatched: str = "drop") -> DataFrame:
    """SITE-4 for several survey years in one join, so both tables are read once.

    ``rules``: year -> {data column: site-table column} that identify a record
    that year (NULL matches NULL); records are those with that ``site_year``.
    ``take`` and ``unmatched`` as in :func:`resolve_official_site`: a record
    listed twice matches twice, ``"drop"`` keeps matched rows only, and rows
    of years without a rule count as unmatched."""
    if unmatched not in ("drop", "keep"):
        raise ValueError("unmatched must be 'drop' or 'keep'")
    key = f"__key_{uuid.uuid4().hex}"
    left, right = rule_keys(df, F.year(F.col(date_col)), sites, col_of(site_year), rules, spread=unmatched == "keep")
    s = sites.select(right.alias(key), *[F.col(src).alias(f"{key}_{i}") for i, src in enumerate(take.values())]).where(F.col(key).isNotNull())
    j = df.withColumn(key, left).join(s, key, "inner" if unmatched == "drop" else "left")
    return j.select(*[c for c in df.columns if c not in take], *[F.col(f"{key}_{i}").alias(name) for i, name in enumerate(take)])


def resolve_official_site(df: DataFrame, sites: DataFrame, on: Mapping[str, str],
                          take: Mapping[str, str], year: int | None = None,
                          date_col: str | None = None, unmatched: str = "drop",
                          site_year: Column | None = None) -> DataFrame:
    """SITE-4: attach the official site record for a survey year.

    ``on`` maps data columns to site-table columns (NULL matches NULL);
    ``take`` maps output names to site-table columns, replacing same-named
    data columns.  ``year`` keeps only data rows of that year and, with
    ``site_year`` (an expression over the site table), only its records.
    ``unmatched='drop'`` keeps matched rows only (Catalyst turns the left
    join plus filter into an inner join); ``'keep'`` keeps all rows.

    The join is an equi-join; the planner broadcasts the site table by its
    measured bytes or not."""
    if year is not None:
        df = df.where(F.year(F.col(date_col)) == F.lit(year))
        if site_year is not None:
            sites = sites.where(site_year == F.lit(year))
    s_cols = list(dict.fromkeys(list(on.values()) + list(take.values())))
    # like a left join, a site record listed twice matches twice
    s = sites.select(*[F.col(c).alias(f"__s_{c}") for c in s_cols], F.lit(True).alias("__s_hit"))
    cond = null_safe_on(df, s, list(on.keys()), [f"__s_{c}" for c in on.values()])
    j = df.join(s, cond, "left")
    if unmatched == "drop":
        j = j.where(F.col("__s_hit").isNotNull())
    elif unmatched != "keep":
        raise ValueError("unmatched must be 'drop' or 'keep'")
    out_cols = [F.col(f"__s_{src}").alias(name) for name, src in take.items()]
    keep = [c for c in df.columns if c not in take]
    return j.select(*keep, *out_cols)


def latest_per_group(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """SITE-5: all rows of the latest date per group (ties kept, NULL dates
    ignored).  The per-group maximum comes from a partial aggregate and is
    semi-joined back on (keys, date) -- no window over raw rows."""
    keys = list(keys)
    mx = df.groupBy(*keys).agg(F.max(date).alias("__max"))
    mx = mx.select(*[F.col(k).alias(f"{k}__m") for k in keys], "__max")
    cond = null_safe_on(df, mx, keys, [f"{k}__m" for k in keys]) & (df[date] == mx["__max"])
    return df.join(mx, cond, "left_semi")
