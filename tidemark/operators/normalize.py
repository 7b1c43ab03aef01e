"""DataFrame-level normalisation operators (NRM family).

Column-level pieces live in :mod:`tidemark.functions.text`; these wrap them
over named columns.  None of them shuffles except ``dedupe`` (one hash
aggregate with map-side partial dedupe) and ``drop_leading`` (a bounded
top-n plus a broadcast anti join of n rows).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark._util import as_list
from tidemark.functions import text as tx


# ---------------------------------------------------------------- names ----

def _snake(name: str) -> str:
    s = name.strip()
    s = s.replace("%", "_percent_").replace("#", "_number_")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if s and s[0].isdigit():
        s = "x" + s
    return s


def clean_names_list(names: Sequence[str]) -> list[str]:
    """Snake-case names; blank -> ``x<pos>``; every copy of a duplicated name
    -> ``<name>_<pos>`` (1-based position, as sheet readers repair them)."""
    base = [_snake(n or "") for n in names]
    counts: dict[str, int] = {}
    for b in base:
        counts[b] = counts.get(b, 0) + 1
    out = []
    for i, b in enumerate(base, start=1):
        if not b:
            out.append(f"x{i}")
        elif counts[b] > 1:
            out.append(f"{b}_{i}")
        else:
            out.append(b)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """NRM-1: metadata-only rename (no job)."""
    return df.toDF(*clean_names_list(df.columns))


# ------------------------------------------------------------------ rows ---

def drop_leading(df: DataFrame, order_col: str | None = None, n: int = 1,
                 sentinel: Column | None = None) -> DataFrame:
    """NRM-2: drop the first ``n`` rows by ``order_col`` (a file row number;
    NULL comes first), or the rows matching a ``sentinel`` predicate.

    Exactly ``n`` rows go: of rows that share the last order value those that
    are first in all columns. The n order values come from a distributed
    top-n; only rows tied with the last of them are compared as a multiset.
    """
    if sentinel is not None:
        return df.where(~F.coalesce(sentinel, F.lit(False)))
    if order_col is None:
        raise ValueError("drop_leading needs order_col or sentinel")
    c = F.col(order_col)
    head = [r[0] for r in df.select(order_col).orderBy(c.asc_nulls_first()).limit(n).collect()]
    if not head:
        return df
    last = head[-1]
    tied = sum(v == last for v in head) if last is not None else len(head)
    same = c.eqNullSafe(F.lit(last).cast(df.schema[order_col].dataType))
    after = c.isNotNull() if last is None else c > F.lit(last)
    ties = df.where(same)
    gone = ties.orderBy(*[F.col(x).asc_nulls_first() for x in df.columns]).limit(tied)
    return df.where(after).unionByName(ties.exceptAll(gone))


def null_tokens(df: DataFrame, tokens: Sequence[str] = ("NULL", "NA"),
                cols: Sequence[str] | None = None) -> DataFrame:
    """NRM-3: listed tokens become NULL in the chosen (default: all string)
    columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def cast_columns(df: DataFrame, types: Mapping[str, str],
                 date_formats: Sequence[str] = tx.DEFAULT_DATE_FORMATS) -> DataFrame:
    """NRM-4: cast columns by name; bad values -> NULL (never raises).

    ``date`` uses :func:`parse_date` with the given layouts."""
    out = {}
    for c, t in types.items():
        if t == "date" and dict(df.dtypes)[c] == "string":
            out[c] = tx.parse_date(c, date_formats)
        else:
            out[c] = F.col(c).try_cast(t)
    return df.withColumns(out)


def apply_corrections(df: DataFrame, col: str, rules, out_col: str | None = None) -> DataFrame:
    """NRM-9: exact-value corrections; unmatched values are kept.

    ``rules`` is a mapping (compiled into a map literal, no join) or a
    DataFrame ``(from_value, to_value)`` (left join; the planner broadcasts it by
    its measured bytes or not).
    """
    out_col = out_col or col
    if isinstance(rules, Mapping):
        if not rules:
            return df
        m = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
        return df.withColumn(out_col, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))
    r = rules.toDF("__from", "__to").dropDuplicates(["__from"])
    joined = df.join(r, df[col] == r["__from"], "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("__to"), F.col(col)))
            .drop("__from", "__to"))


def patch_values(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    """NRM-10: set ``col`` to ``value`` where ``cond`` holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(F.coalesce(cond, F.lit(False)), v).otherwise(F.col(col)))


def split_code(df: DataFrame, col: str, into: Sequence[str], sep: str = "_",
               keep: bool = True) -> DataFrame:
    """NRM-11: split on a regex; missing pieces -> NULL, extra pieces dropped."""
    parts = F.split(F.col(col), sep)
    out = df.withColumns({name: F.get(parts, i) for i, name in enumerate(into)})
    if not keep and col not in into:
        out = out.drop(col)
    return out


def flatten_arrays(df: DataFrame, cols: Sequence[str], mode: str = "first",
                   sep: str = ",") -> DataFrame:
    """NRM-16: list cells to their first element or to joined text."""
    if mode == "first":
        return df.withColumns({c: F.get(F.col(c), 0) for c in cols})
    if mode == "join":
        return df.withColumns({c: F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), sep)
                               for c in cols})
    raise ValueError(mode)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """NRM-17: drop exact duplicate rows (or duplicates on ``subset``)."""
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def standardize_codes(df: DataFrame, cols: Sequence[str], width: int = 2) -> DataFrame:
    """NRM-7 over columns."""
    return df.withColumns({c: tx.standardize_code(c, width) for c in as_list(cols)})


def rewrite_codes(df: DataFrame, col: str, rules) -> DataFrame:
    """NRM-8 over a column."""
    return df.withColumn(col, tx.rewrite_code(col, rules))


def parse_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NRM-6 over columns."""
    return df.withColumns({c: tx.parse_number(c) for c in as_list(cols)})


def with_class(df: DataFrame, out_col: str, src: str, rules, default=None) -> DataFrame:
    """NRM-12 as a new column."""
    return df.withColumn(out_col, tx.classify(src, rules, default))


def clean_columns(df: DataFrame, cols: Sequence[str], steps) -> DataFrame:
    """NRM-13 over columns."""
    return df.withColumns({c: tx.clean_text(c, steps) for c in as_list(cols)})


def corrections_frame(spark: SparkSession, rules: Mapping[str, str]) -> DataFrame:
    """A corrections table from a literal mapping (for :func:`apply_corrections`)."""
    return spark.createDataFrame(list(rules.items()), "from_value string, to_value string")


def keep_not_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Filter ``!col %in% values`` keeping NULL (P4)."""
    return df.where(tx.not_in(col, values))


def rename_regex(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Rename every column matching ``pattern`` (metadata only)."""
    return df.toDF(*[re.sub(pattern, replacement, c) for c in df.columns])


def select_like(df: DataFrame, prefix: str | None = None, suffix: str | None = None) -> list[str]:
    """Column names by prefix/suffix (the reference selects by name patterns)."""
    return [c for c in df.columns
            if (prefix is None or c.startswith(prefix)) and (suffix is None or c.endswith(suffix))]


def col_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)

