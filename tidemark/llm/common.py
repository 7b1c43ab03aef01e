"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of an Arrow batch sent to a Python worker: texts run to a hundred kilobytes and more.
BATCH_ROWS = 1000

_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers (once per application), with Arrow batches sized for long texts."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset a private folder is made, but only under a ``local``
    master, where driver and executors are one process.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        made = spark.sparkContext.getCheckpointDir()
        if made:
            path = made
        elif spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(path)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one: archives, shards and tables between steps go there."""
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def discard(spark: SparkSession) -> None:
    """Delete this application's folder (``run_dir``). Results still read from it must be saved before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in this application's folder and read it back."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` is called so (in any case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def spread(df: DataFrame, *keys: str, rows: int | None = None, most: int = 20_000) -> DataFrame:
    """Deal a small table of work items (files, shards) over as many tasks as it has rows.

    An explicit partition count: by bytes Spark would put them all into one
    task, though each row stands for a file's work.
    """
    n = df.count() if rows is None else rows
    return df.repartition(max(1, min(most, 2 * n)), *keys)


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id printed as text, mod 4; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(doc_id: Column | str) -> Column:
    return fold(doc_id) == 2


def text_batches(texts, limit: int = 1 << 20):
    """Cut a list of texts into runs of at most ``limit`` bytes (a longer text stands alone).

    Yields (first index, list of UTF-8 bytes); a null text is empty.
    """
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if run and size + len(b) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b)
    if run:
        yield first, run


def word_lists(data: bytes, limit: int = 1 << 24):
    """Lists of the words between ASCII white space; a text beyond ``limit`` bytes is cut at white space."""
    at = 0
    while at < len(data):
        end = min(at + limit, len(data))
        while end < len(data) and data[end : end + 1].strip():
            end += 1
        yield data[at:end].split()
        at = end
