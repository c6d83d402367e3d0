"""The connector of published folders: pushed filters, whole versions, failed writes."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from modeloom.sources import published, sinks, tables

ROWS = [
    (1, "a", 0.5, datetime.date(2020, 1, 1)),
    (2, None, float("nan"), None),
    (None, "b", None, datetime.date(2021, 1, 1)),
    (4, "", -0.0, datetime.date(2022, 5, 1)),
    (4, "ß\n", 7.0, datetime.date(2022, 5, 1)),
]
SCHEMA = "id long, word string, x double, day date"


def files(folder):
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))


@pytest.fixture(scope="module")
def known(spark):
    published.register(spark)
    return spark


def read(spark, path):
    return tables.read_table(spark, path, format=published.FORMAT)


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize(
    "where",
    [
        "id = 4", "id > 1 and word is not null", "id in (1, 2, null)", "word = ''", "word >= 'a'",
        "x > 1", "x = 0", "x is null", "day < date'2021-06-01'", "id is null", "not (id = 4)",
        "id <=> null", "word like 'a%'", "id = 1 or word = 'b'",
    ],
)
def test_filters_keep_the_rows_spark_keeps(known, tmp_path, where):
    df = known.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "folder")
    sinks.write_table(df, path, format=published.FORMAT)
    assert plain(read(known, path).where(where)) == plain(df.where(where))


def test_filter_is_pushed(known, tmp_path):
    path = str(tmp_path / "folder")
    sinks.write_table(known.range(1000).toDF("id"), path, format=published.FORMAT)
    reader = published.FolderReader(path, known.range(1).schema)
    kept = list(reader.pushFilters([published.GreaterThan(("id",), 990), published.GreaterThan(("id",), 9.5)]))
    assert [f.value for f in kept] == [9.5]
    got = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    assert sum(got) == 9
    plan = read(known, path).where("id > 990")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan


def test_failed_write_leaves_nothing(known, tmp_path):
    path = str(tmp_path / "folder")
    sinks.write_table(known.range(100).toDF("id"), path, format=published.FORMAT)
    held, manifest = files(path), open(f"{path}/{published.MANIFEST}").read()
    bad = known.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id")
    )
    with pytest.raises(Exception, match="no"):
        sinks.write_table(bad, path, format=published.FORMAT)
    assert open(f"{path}/{published.MANIFEST}").read() == manifest
    assert files(path) == held
    assert read(known, path).count() == 100


def test_versions(known, tmp_path):
    path = str(tmp_path / "folder")
    with pytest.raises(Exception, match="nothing is published"):
        read(known, path)
    sinks.write_table(known.createDataFrame([], SCHEMA), path, format=published.FORMAT)
    assert read(known, path).count() == 0 and read(known, path).columns == ["id", "word", "x", "day"]
    df = known.createDataFrame(ROWS, SCHEMA)
    df.write.format(published.FORMAT).mode("append").save(path)
    df.write.format(published.FORMAT).mode("append").save(path)
    assert plain(read(known, path)) == plain(df.union(df))
    old = files(path)
    for turn in range(3):
        sinks.write_table(df, path, format=published.FORMAT)
        assert plain(read(known, path)) == plain(df)
        assert (set(old) <= set(files(path))) == (turn == 0)
