from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.sources import files
from talkatlas.sources.split_csv import read_csv_split

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
VALUES = [None, "x", "two words", 'a "quoted" word', '"', '""', "line\nbreak", "\n", '\n"\n', "a,b", "é\n☃", '","', "end\n" * 9]


@pytest.fixture()
def small_splits(spark):
    """Sets the size of a split in bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, old)


def written(folder, n, feed="\n", seed=1, name="a.csv"):
    """A CSV file of ``n`` rows with quotes and line breaks everywhere, written by hand, and its rows."""
    rng = random.Random(seed)
    rows = [(i, rng.choice(VALUES), rng.choice(VALUES)) for i in range(n)]
    text = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"' if set(v) & set('",\n') else v
    lines = ["n,a,b"] + [f"{i},{text(a)},{text(b)}" for i, a, b in rows]
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((feed.join(lines) + feed).encode())
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size, n", [(5, 2), (11, 8), (64, 40), (1 << 20, 40)])
def test_same_rows_with_any_split(spark, tmp_path, small_splits, size, n):
    path = tmp_path / "csv"
    rows = written(path, n) + written(path, n // 2, seed=2, name="b.csv")
    whole = rows_of(files.read_csv(spark, str(path), SCHEMA))
    small_splits(size)
    got = rows_of(read_csv_split(spark, str(path), SCHEMA))
    assert got == whole == sorted(rows, key=str)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "csv"
    rows = written(path, 3000)
    small_splits(4096)
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 7
    assert rows_of(read_csv_split(spark, str(path), SCHEMA)) == sorted(rows, key=str)


def test_large_split_tables_are_joined_in_order(spark, tmp_path, small_splits, monkeypatch):
    path = tmp_path / "csv"
    rows = written(path, 30)
    small_splits(64)
    monkeypatch.setattr("talkatlas.sources.split_csv.LOOKUP_BYTES", 0)
    assert rows_of(read_csv_split(spark, str(path), SCHEMA)) == sorted(rows, key=str)


def test_line_ends_of_two_bytes_and_empty_lines(spark, tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_bytes(b'n,a,b\r\n1,"x\r\ny",z\r\n\r\n2,,"w"')
    assert rows_of(read_csv_split(spark, str(path), SCHEMA)) == [(1, "x\r\ny", "z"), (2, None, "w")]


def test_open_quotes_are_refused_and_bad_rows_audited(spark, tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text('n,a,b\n1,"x,y\n')
    with pytest.raises(ValueError, match="a.csv"):
        read_csv_split(spark, str(path), SCHEMA)
    (path / "a.csv").write_text('n,a,b\n1,"x\ny",z\nbad,x,y\n')
    got = read_csv_split(spark, str(path), SCHEMA, audit=True)
    assert [r[files.REJECTED] for r in got.where(F.col("n").isNull()).collect()] == ["bad,x,y"]


def test_header_alone_and_empty_file(spark, tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text("n,a,b\n")
    (path / "b.csv").write_text("")
    assert rows_of(read_csv_split(spark, str(path), SCHEMA)) == []
