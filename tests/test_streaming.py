import tempfile

from pyspark.sql import functions as F

from tidemark.functions.text import standardize_code
from tidemark.streaming import ingest_stream


def test_ingest_stream(spark):
    src, sink, ck = (tempfile.mkdtemp(prefix=p) for p in ("src-", "sink-", "ck-"))
    spark.createDataFrame([("mar6", "3"), ("rec12_for", "x")], "site string, count string") \
        .write.mode("overwrite").option("header", True).csv(src + "/batch1")
    q = ingest_stream(spark, src + "/batch1", "site string, count string", sink, ck,
                      transform=lambda d: d.select(standardize_code("site").alias("site"),
                                                   F.col("count").try_cast("double").alias("count")))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    assert got == [("MAR_06", 3.0), ("REC_12_for", None)]
