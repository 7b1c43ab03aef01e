"""Readers and writers: row order over files and splits, sets of tables, long integers."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import io


def test_rows_keep_file_order_over_files_and_splits(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    sheets = {f"s{n}.csv": [f"{n}-{i}-{'x' * (i % 50)}" for i in range(rows)] for n, rows in enumerate((1, 700, 0, 3000))}
    for name, rows in sheets.items():
        (tmp_path / name).write_text("Row Text,B\n" + "".join(f"{r},{i}\n" for i, r in enumerate(rows)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = io.read_sheets(spark, str(tmp_path))
        assert got.columns == ["row_text", "b", "sheet", "row"]
        assert spark.read.csv(str(tmp_path)).rdd.getNumPartitions() > 10
        rows = got.collect()
        # the example row of every sheet goes
        assert got.where("row >= 1").count() == sum(max(0, len(x) - 1) for x in sheets.values())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.sheet.rsplit("/", 1)[1], r.row, r.row_text, r.b) for r in rows} == {(n, i, r, str(i)) for n, x in sheets.items() for i, r in enumerate(x)}
    assert len(rows) == sum(map(len, sheets.values()))
    with pytest.raises(Exception, match="split differently"):  # other splits than those counted
        got.where("row >= 0").collect()


def test_multi_line_sheets(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text("a,row\n" + "".join(f'"line {i}\nof {n}",{i}\n' for i in range(40)))
    got = io.read_sheets(spark, str(tmp_path), multi_line=True, row="place").collect()
    assert len(got) == 120 and all(r.a == f"line {r.place}\nof {r.sheet[-5]}" and r.row == str(r.place) for r in got)
    with pytest.raises(Exception, match="multi-line sheet"):
        io.read_sheets(spark, str(tmp_path), multi_line=True, max_multi_line_bytes=100).collect()


def test_a_set_of_tables_is_published_whole(spark, tmp_path):
    home = f"file://{tmp_path}/set"
    one, two = spark.range(3).withColumn("p", F.col("id") % 2), spark.range(5)
    assert io.publish_tables({"a": one, "b": two}, home, partition_by={"a": ["p"]}) == 1
    bad = spark.range(4).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        io.publish_tables({"a": spark.range(100), "b": bad}, home)
    assert {k: v.count() for k, v in io.published_tables(spark, home).items()} == {"a": 3, "b": 5}
    assert io.publish_tables({"a": spark.range(7)}, home) == 2
    assert {k: v.count() for k, v in io.published_tables(spark, home).items()} == {"a": 7}
    assert {k: v.count() for k, v in io.published_tables(spark, home, 1).items()} == {"a": 3, "b": 5}
    io.forget_versions(spark, home, keep=1)
    assert io.published_tables(spark, home)["a"].count() == 7
    assert len([x for x in (tmp_path / "set").iterdir() if x.name.startswith("set-")]) == 1
    with pytest.raises(FileNotFoundError):
        io.published_tables(spark, home, 1)
    with pytest.raises(FileNotFoundError):
        io.published_tables(spark, f"file://{tmp_path}/none")


def test_long_integers_keep_their_digits(spark):
    df = spark.createDataFrame([("99999999999999999999", "1" * 39, "99999999999999999999", "1"), ("7", "2", "1.5", "2.5")], "a string, b string, c string, d string")
    assert io.infer_type_plan(df) == {"a": "decimal(38,0)", "b": "string", "c": "string", "d": "double"}
    assert [str(r.a) for r in io.infer_types(df).collect()] == ["99999999999999999999", "7"]
