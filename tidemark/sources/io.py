"""Readers and writers (SRC / SNK families)."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.normalize import clean_names
from tidemark.session import scratch_table


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, clean: bool = False,
               **options) -> DataFrame:
    """SRC-1: read a headed table.  CSV takes an explicit ``schema`` when given
    (no inference pass over the data); otherwise types are inferred."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", options.pop("nullValue", "NA"))
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return clean_names(df) if clean else df


def read_text_table(spark: SparkSession, path: str, clean: bool = True, **options) -> DataFrame:
    """SRC-2: read a headed CSV keeping every column as text."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    return clean_names(df) if clean else df


def read_sheets(spark: SparkSession, paths: str | Sequence[str], clean: bool = True, sheet: str = "sheet", row: str = "row",
                multi_line: bool = False, max_multi_line_bytes: int = 1 << 28, **options) -> DataFrame:
    """SRC-2 over many headed CSV files: all columns as text, the file of each row and its place there (from 0).

    A file may be read in several splits by different tasks. Inside a split
    rows are numbered in order; how many each split holds is counted (one row a
    split), and the counts of the splits before it are added. Both passes must
    see the same splits: a row whose split was not counted fails the query.

    ``multi_line`` reads records with line breaks in quotes: such a file cannot
    be split, so one task reads it, and a file beyond ``max_multi_line_bytes``
    fails the query. Leading rows go with ``where(row >= n)`` on every sheet.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("multiLine", multi_line)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    names = df.columns
    at, start, size, inner = (f"__{n}_{uuid.uuid4().hex}" for n in ("file", "start", "size", "id"))
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.col("_metadata.file_path").alias(at), F.col("_metadata.file_block_start").alias(start),
                     F.col("_metadata.file_size").alias(size), F.monotonically_increasing_id().alias(inner))
    if multi_line:
        rows = rows.withColumn(at, F.when(F.col(size) <= max_multi_line_bytes, F.col(at)).otherwise(
            F.raise_error(F.concat(F.lit(f"multi-line sheet of more than {max_multi_line_bytes} bytes: "), F.col(at))).cast("string")))
    splits = scratch_table(rows.groupBy(F.col(at).alias("f"), F.col(start).alias("s")).agg(F.min(inner).alias("first"), F.count(F.lit(1)).alias("n")), "splits")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = rows.join(splits.withColumn("before", before), (F.col(at) == F.col("f")) & (F.col(start) == F.col("s")), "left")
    inside = F.col(inner) - F.col("first")
    place = F.when((inside >= 0) & (inside < F.col("n")), F.col("before") + inside).otherwise(F.raise_error(F.lit("the files were split differently by the two passes")).cast("long"))
    out = j.select(*[F.col(f"`{c}`") for c in names])
    out = clean_names(out) if clean else out
    return j.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(names, out.columns)], F.col(at).alias(sheet), place.alias(row))


# Candidate types tried in order when typing text columns, the
# layouts of numbers (no zero padding, no type suffix), dates and times, and
# the tokens that stand for a missing value.
_INFER_ORDER = ("boolean", "bigint", "decimal(38,0)", "double", "date", "timestamp", "string")
_BIGINT = r"^-?(0|[1-9][0-9]*)$"
_DOUBLE = r"^[-+]?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][-+]?[0-9]+)?$"
DATE_LAYOUTS = ("yyyy-MM-dd", "M/d/yyyy")
TIME_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm")
MISSING_TOKENS = ("", "NA", "NULL")


def _first_of(x, layouts, parse):
    return F.coalesce(*[parse(x, f) for f in layouts])


def _present(c: str):
    x = F.trim(F.col(c))
    return F.when(~x.isin(*MISSING_TOKENS), x)


def infer_type_plan(df: DataFrame, cols: Sequence[str] | None = None,
                    date_layouts: Sequence[str] = DATE_LAYOUTS, time_layouts: Sequence[str] = TIME_LAYOUTS) -> dict[str, str]:
    """Decide a type for each text column with ONE aggregate over the table.

    For every column it counts the values that are present (not NULL, blank or
    a missing token) and how many of them parse as each type; the first type
    that parses all wins. Zero-padded codes stay text; integers beyond 64 bits
    are decimal(38,0), beyond 38 digits or mixed with fractions text. Only the
    counts (a few numbers per column) reach the driver.
    """
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = _present(c)
        tests = {
            "n": x.isNotNull(),
            "boolean": F.upper(x).isin("TRUE", "FALSE"),
            "bigint": x.rlike(_BIGINT) & x.try_cast("bigint").isNotNull(),
            "decimal(38,0)": x.rlike(_BIGINT) & x.try_cast("decimal(38,0)").isNotNull(),
            # an integer beyond 64 bits would lose digits
            "double": x.rlike(_DOUBLE) & x.rlike("[0-9]") & x.try_cast("double").isNotNull() & (~x.rlike(_BIGINT) | x.try_cast("bigint").isNotNull()),
            "date": _first_of(x, date_layouts, F.try_to_date).isNotNull(),
            "timestamp": _first_of(x, time_layouts, lambda v, f: F.try_to_timestamp(v, F.lit(f))).isNotNull(),
        }
        aggs += [F.count(F.when(t, 1)).alias(f"{i}_{k}") for k, t in tests.items()]
    row = df.agg(*aggs).first().asDict()
    plan = {}
    for i, c in enumerate(cols):
        n = row[f"{i}_n"]
        plan[c] = next((t for t in _INFER_ORDER[:-1] if row[f"{i}_{t}"] == n), "string") if n else "string"
    return plan


def infer_types(df: DataFrame, cols: Sequence[str] | None = None,
                date_layouts: Sequence[str] = DATE_LAYOUTS, time_layouts: Sequence[str] = TIME_LAYOUTS) -> DataFrame:
    """SRC-3: missing tokens to NULL, then type text columns (one job for the plan)."""
    plan = infer_type_plan(df, cols, date_layouts, time_layouts)
    out = {}
    for c, t in plan.items():
        x = _present(c)
        if t == "string":
            out[c] = F.when(x.isNotNull(), F.col(c))
        elif t == "date":
            out[c] = _first_of(x, date_layouts, F.try_to_date)
        elif t == "timestamp":
            out[c] = _first_of(x, time_layouts, lambda v, f: F.try_to_timestamp(v, F.lit(f)))
        elif t == "boolean":
            out[c] = F.upper(x) == "TRUE"
        else:
            out[c] = x.try_cast(t)
    return df.withColumns(out) if out else df


def union_years(dfs: Sequence[DataFrame], check: bool = False,
                allow_missing: bool = False) -> DataFrame:
    """SRC-4: stack same-shaped tables by column name.

    ``check=True`` verifies the stacked row count equals the sum of the parts
    (costs one count job per input, as the reference's count arithmetic)."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
    if check:
        expected = sum(d.count() for d in dfs)
        got = out.count()
        if got != expected:
            raise AssertionError(f"union lost rows: {got} != {expected}")
    return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", na: str = "NA",
              single_file: bool = False) -> None:
    """SNK-1: CSV with header, NULL printed as ``NA``.

    ``single_file`` coalesces to one task and is only for small result tables
    (diff reports); large tables keep their partitioning."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", True).option("nullValue", na)
     .option("emptyValue", "").csv(path))


def write_tables(tables: Mapping[str, DataFrame], directory: str, fmt: str = "parquet",
                 mode: str = "overwrite", partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """SNK-2: save several result tables together (one folder each)."""
    paths = {}
    for name, df in tables.items():
        path = f"{directory.rstrip('/')}/{name}"
        w = df.write.mode(mode).format(fmt)
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.save(path)
        paths[name] = path
    return paths


_MANIFESTS = "_manifests"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, directory: str) -> list[int]:
    fs, folder = _store(spark, f"{directory}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if re.fullmatch(r"v\d{10}\.json", n))


def publish_tables(tables: Mapping[str, DataFrame], directory: str, fmt: str = "parquet",
                   partition_by: Mapping[str, Sequence[str]] | None = None) -> int:
    """SNK-2, all or nothing: save several tables so that readers see the former set or the whole new one.

    Every table goes to a folder that only this attempt uses. When all are
    written, one small manifest (name -> folder, format) is created and renamed
    to the next version; readers (:func:`published_tables`) resolve through the
    newest manifest. A job that fails between two tables publishes nothing, and
    of two writers of one version the later fails. Returns the version.
    """
    spark = next(iter(tables.values())).sparkSession
    directory = directory.rstrip("/")
    version = max(_versions(spark, directory), default=0) + 1
    attempt = uuid.uuid4().hex
    places = {}
    for name, df in tables.items():
        places[name] = f"set-{attempt}/{name}"
        w = df.write.mode("errorifexists").format(fmt)
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.save(f"{directory}/{places[name]}")
    fs, draft = _store(spark, f"{directory}/{_MANIFESTS}/.draft-{attempt}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"format": fmt, "tables": places}).encode()))
    out.close()
    _, final = _store(spark, f"{directory}/{_MANIFESTS}/v{version:010d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of {directory} was published by another writer")
    return version


def _manifest(spark: SparkSession, directory: str, version: int) -> dict:
    text = spark.read.option("wholetext", True).text(f"{directory}/{_MANIFESTS}/v{version:010d}.json").first()[0]
    return json.loads(text)


def published_tables(spark: SparkSession, directory: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest (or the given) published version, by name."""
    directory = directory.rstrip("/")
    known = _versions(spark, directory)
    version = version or max(known, default=0)
    if version not in known:
        raise FileNotFoundError(f"no published tables in {directory}" if not known else f"{directory} has no version {version}")
    told = _manifest(spark, directory, version)
    return {name: spark.read.format(told["format"]).load(f"{directory}/{place}") for name, place in told["tables"].items()}


def forget_versions(spark: SparkSession, directory: str, keep: int = 2) -> None:
    """Delete all published versions but the newest ``keep``, and folders of attempts that no kept version names.

    For quiet times: it would also take the folder of a set that is being written."""
    directory = directory.rstrip("/")
    known = _versions(spark, directory)
    kept = known[-keep:] if keep else []
    sets = {place.split("/")[0] for v in kept for place in _manifest(spark, directory, v)["tables"].values()}
    for v in known[: len(known) - len(kept)]:
        fs, p = _store(spark, f"{directory}/{_MANIFESTS}/v{v:010d}.json")
        fs.delete(p, False)
    fs, folder = _store(spark, directory)
    for f in fs.listStatus(folder):
        if f.getPath().getName().startswith("set-") and f.getPath().getName() not in sets:
            fs.delete(f.getPath(), True)


def with_row_order(df: DataFrame, col: str = "row_order") -> DataFrame:
    """Attach a row-order column to a freshly read single-file source.

    ``monotonically_increasing_id`` grows with the split index and the
    position inside the split, so for ONE file it follows file order without a
    shuffle.  Across several files Spark packs splits by size; there
    :func:`read_sheets` gives each row its place in its own file."""
    return df.withColumn(col, F.monotonically_increasing_id())
