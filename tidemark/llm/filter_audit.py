"""How text filters interact: what each removes at each place of every order, part by part.

Every document becomes a set of failed filters (a bit mask) and two label bits.
Rows of equal (part, id, bits) are counted once, then dealt by ranges of (part,
id), so that a large part is cut into many ranges. In a range each filter has a
sorted posting list of the ids that fail it; unions of lists come from k-way
merges that gallop, differences of a list and a union likewise. Their sizes,
summed over ranges, give the counts of every order of the filters.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import word_lists

#: Ids of one part that a posting list range holds at most.
RANGE_IDS = 1 << 16
#: Runs shorter than this are merged as a block instead of one by one.
SHORT_RUN = 32
_BLOCK = 1024


# ------------------------------------------------------------- posting lists


def gallop(ids: np.ndarray, least: int, at: int) -> int:
    """First place from ``at`` whose id is ``least`` or more: steps that double, then a search inside the last one."""
    step, low = 1, at
    while at < len(ids) and ids[at] < least:
        low, at = at + 1, at + step
        step *= 2
    return bisect_left(ids, least, low, min(at, len(ids)))


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted union of sorted lists, each without repeats: a k-way merge.

    The list with the smallest head is copied up to the next list's head, found
    by galloping. Where such runs are short the lists are interleaved, and the
    next range of ids is merged in one step.
    """
    out, at = [], [0] * len(lists)
    while True:
        heads = sorted((int(x[a]), k) for k, (x, a) in enumerate(zip(lists, at, strict=True)) if a < len(x))
        if not heads:
            return np.concatenate(out) if out else np.zeros(0, np.int64)
        (first, k), second = heads[0], heads[1][0] if len(heads) > 1 else None
        if second is None:
            out.append(lists[k][at[k] :])
            at[k] = len(lists[k])
            continue
        to = gallop(lists[k], second, at[k])
        if to - at[k] >= SHORT_RUN:
            out.append(lists[k][at[k] : to])
            at[k] = to
            continue
        # the range up to the nearest of the lists' ids a block ahead (or their last)
        stop = min(int(x[min(a + _BLOCK, len(x) - 1)]) for x, a in zip(lists, at, strict=True) if a < len(x)) + 1
        ends = [a + int(np.searchsorted(x[a : a + _BLOCK + 1], stop)) for x, a in zip(lists, at, strict=True)]
        out.append(np.unique(np.concatenate([x[a:b] for x, a, b in zip(lists, at, ends, strict=True)])))
        at = ends


def without(ids: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Mask of the ids that the other sorted list does not hold, both walked by galloping over ranges of ids."""
    keep = np.ones(len(ids), bool)
    a = b = 0
    while a < len(ids) and b < len(gone):
        if ids[a] < gone[b]:
            to = gallop(ids, int(gone[b]), a)
            if to - a >= SHORT_RUN:
                a = to
                continue
        elif gone[b] < ids[a]:
            to = gallop(gone, int(ids[a]), b)
            if to - b >= SHORT_RUN:
                b = to
                continue
        stop = min(int(ids[min(a + _BLOCK, len(ids) - 1)]), int(gone[min(b + _BLOCK, len(gone) - 1)])) + 1
        to, end = a + int(np.searchsorted(ids[a : a + _BLOCK + 1], stop)), b + int(np.searchsorted(gone[b : b + _BLOCK + 1], stop))
        mine, other = ids[a:to], gone[b:end]
        if len(other):
            place = np.minimum(np.searchsorted(other, mine), len(other) - 1)
            keep[a:to] = other[place] != mine
        a, b = to, end
    return keep


def range_sizes(ids: np.ndarray, masks: np.ndarray, rows: np.ndarray, marks: np.ndarray, filters: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """(set applied before, filter, failing, removed, left, marked 1 removed, marked 2 removed) of one range.

    ``ids`` are sorted and distinct, ``rows`` says how many documents each
    stands for, ``marks`` has a column a label.
    """
    posting = [ids[masks >> f & 1 == 1] for f in range(filters)]
    size = np.column_stack([rows, rows * marks[:, 0], rows * marks[:, 1]])
    of = [size[masks >> f & 1 == 1] for f in range(filters)]
    total = int(rows.sum())
    out = []
    for before in range(1 << filters):
        gone = merged([posting[f] for f in range(filters) if before >> f & 1])
        held = total - int(rows[np.searchsorted(ids, gone)].sum())
        for f in range(filters):
            if not before >> f & 1:
                removed, good, toxic = of[f][without(posting[f], gone)].sum(0).tolist()
                out.append((before, f, int(of[f][:, 0].sum()), removed, held - removed, good, toxic))
    return out


# ------------------------------------------------------------- the filters


_UPPER = bytes(range(65, 91))
_SIGNS = re.compile(r"[#$%&*|]")


def _fails(text: str) -> int:
    """Filters A (under 50 words), B (distinct words under 65 % of words), C (A-Z over 5 % of characters), D (a sign): bits 0 to 3."""
    data = text.encode("utf-8")
    words, seen = 0, set()
    for some in word_lists(data):
        words += len(some)
        seen.update(some)
    upper = len(data) - len(data.translate(None, _UPPER))
    return (words < 50) | (100 * len(seen) < 65 * words) << 1 | (100 * upper > 5 * len(text)) << 2 | (_SIGNS.search(text) is not None) << 3


def failed_bits(text: Column) -> Column:
    """Bits 0 to 3 of filters A to D; a null text is empty."""

    @pandas_udf("long")
    def bits(texts: pd.Series) -> pd.Series:
        return pd.Series([int(_fails(t or "")) for t in texts], dtype="int64")

    return bits(text)


def repeats(docs: DataFrame) -> DataFrame:
    """Rows (id, digest, ...) with ``again``: a smaller id has the same digest.

    The smallest id of each digest is counted out with partial aggregation and
    joined back on (digest, id), so copies of one text do not meet in one task.
    """
    least = docs.groupBy("digest").agg(F.min("id").alias("id")).select("digest", "id", F.lit(True).alias("least"))
    return docs.join(least, ["digest", "id"], "left").withColumn("again", F.col("id").isNotNull() & F.col("least").isNull()).drop("least")


# ------------------------------------------------------------- the audit


def sizes(bits: DataFrame, filters: int, range_ids: int = RANGE_IDS) -> DataFrame:
    """Sizes of all differences per part, from rows (part, id, mask, good, toxic).

    Returns (part, before, filter, failing, removed, left, good, toxic): of the
    documents that fail ``filter``, those left after the filters of the set
    ``before``, and what is then left of the part.
    """
    counted = bits.groupBy("part", "id", "mask", "good", "toxic").agg(F.count("*").alias("rows"))
    ranged = counted.repartitionByRange("part", "id").sortWithinPartitions("part", "id")
    names = ["part", "before", "filter", "failing", "removed", "left", "good", "toxic"]

    def told(part: str, columns: list[np.ndarray]) -> pa.RecordBatch:
        mask, rows, good, toxic = columns
        got = range_sizes(np.arange(len(mask)), mask, rows, np.column_stack([good, toxic]), filters)
        return pa.RecordBatch.from_pydict(dict(zip(names, [[part] * len(got), *map(list, zip(*got, strict=True))], strict=True)), schema=schema)

    schema = pa.schema([("part", pa.string()), *[(n, pa.int64()) for n in names[1:]]])

    def audit(batches):
        part, held, n = None, [], 0
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            data = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("mask", "rows", "good", "toxic")]
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and (parts[a] != part or n + b - a > range_ids):
                    yield told(part, [np.concatenate(x) for x in zip(*held, strict=True)])
                    held, n = [], 0
                part = parts[a]
                held.append([x[a:b] for x in data])
                n += b - a
        if held:
            yield told(part, [np.concatenate(x) for x in zip(*held, strict=True)])

    ddl = ", ".join(f"{n} {'string' if n == 'part' else 'long'}" for n in names)
    per_range = ranged.mapInArrow(audit, ddl)
    return per_range.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in names[3:]])


def orders(sized: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the sizes of differences."""
    spark, n = sized.sparkSession, len(letters)
    steps = [
        ("".join(letters[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k])
        for order in permutations(range(n))
        for k in range(n)
    ]
    plan = spark.createDataFrame(steps, "filter_order string, step int, before long, filter long")
    full = (1 << n) - 1
    ways = F.create_map(*[F.lit(x) for b in range(1 << n) for x in (b, factorial(bin(b).count("1")) * factorial(n - 1 - bin(b).count("1")) if b != full else 0)])
    alone = F.col("before") == F.lit(full) - F.pow(F.lit(2), F.col("filter")).cast("long")
    per_filter = sized.groupBy("part", "filter").agg(
        F.max(F.when(alone, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * ways[F.col("before").cast("int")]).alias("shapley"),
    )
    told = sized.join(per_filter, ["part", "filter"]).join(F.broadcast(plan), ["before", "filter"])
    return told.select(
        "part", "filter_order", "step", F.col("left").alias("kept"), "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Audit of the five filters A to E over (id, text, part) and labels (id, quality, toxic).

    Returns per part, order and step the counts of documents kept, removed,
    redundant, failing this filter only, good and toxic among the removed, and
    the filter's removals summed over all orders. Null texts are empty, null
    parts the empty string; a null id is smaller than none and repeats none.
    Repeated rows count as often as they occur; a document is good or toxic if
    any of its label rows says so. Texts of any length are read whole. An empty
    table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("id"),
        F.sha2(text, 256).alias("digest"), failed_bits(F.col(text_col)).alias("bits"),
    )
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    told = repeats(rows).join(marks, "id", "left").select(
        "part", "id", F.col("bits").bitwiseOR(F.col("again").cast("long") * 16).alias("mask"),
        F.coalesce("good", F.lit(False)).cast("long").alias("good"), F.coalesce("toxic", F.lit(False)).cast("long").alias("toxic"),
    )
    return orders(sizes(told, 5), "ABCDE")


#: DuckDB twin of ``audit`` over the given tables.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
bits AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    map(['A', 'B', 'C', 'D', 'E'], [
      len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(least < d.doc_id, false)]) AS fails
  FROM d LEFT JOIN l USING (doc_id)),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT [a.c, b.c, x.c, y.c, z.c] AS ord FROM f a, f b, f x, f y, f z WHERE len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5),
s AS (SELECT ord, array_to_string(ord, '') AS filter_order, step, ord[step] AS c, ord[1:step - 1] AS before FROM o, range(1, 6) r(step)),
flat AS (SELECT part, good, toxic, fails['A'] AS a, fails['B'] AS b, fails['C'] AS c, fails['D'] AS d, fails['E'] AS e, count(*) AS n FROM bits GROUP BY ALL),
g AS (SELECT *, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS fails FROM flat),
j AS (
  SELECT part, filter_order, step, s.c, n, good, toxic, g.fails[s.c] AS hit,
    len(list_filter(before, lambda x: g.fails[x])) > 0 AS gone, len(list_filter(ord, lambda x: g.fails[x])) = 1 AS single
  FROM g, s),
r AS (
  SELECT part, filter_order, step, c, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND single THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM r
"""
