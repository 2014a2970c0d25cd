from datetime import datetime

import pytest
from pyspark.sql import functions as F

from minuteflow.functions import filenames


def parse(spark, name, stream=None):
    df = spark.createDataFrame([(name, stream)], "name string, topic string")
    return filenames.parse_file_names(df, "name", "topic" if stream else None).first()


@pytest.mark.parametrize(
    "name, stream, number",
    [("test-2012-11-05-14-20_00000", "test", 0), ("a-test-2012-11-05-14-20_00012", "a-test", 12)],
)
def test_collector_names(spark, name, stream, number):
    row = parse(spark, name)
    assert row.valid and row.stream == stream and row.file_id == number
    assert row.file_minute == datetime(2012, 11, 5, 14, 20) and row.collector is None


@pytest.mark.parametrize(
    "name",
    ["invalid", "test-2012-11-05-14-20", "test-2012-11-05-14-20_", "test-2012-11-05-14-20_abc",
     "test-2012-11-05-14_00000", "test-2012-13-05-14-20_00000", "test-2012-11-05-14-20_00000.gz"],
)
def test_bad_collector_names(spark, name):
    row = parse(spark, name)
    assert not row.valid and row.stream is None and row.file_minute is None


def test_committed_names(spark):
    row = parse(spark, "host-1-a-test-2012-11-05-14-20_00003.gz", "a-test")
    assert (row.valid, row.collector, row.stream, row.file_id, row.ext) == (True, "host-1", "a-test", 3, "gz")


@pytest.mark.parametrize(
    "name",
    ["test-2012-11-05-14-20_00000.gz", "c-test-2012-11-05-14-20_00000", "c-other-2012-11-05-14-20_00000.gz",
     "c-test-2012-11-05-14-20.gz", "invalid"],
)
def test_bad_committed_names(spark, name):
    assert not parse(spark, name, "test").valid


def test_print_parse_round_trip(spark):
    at = F.lit("2012-11-05 14:20:00").cast("timestamp")
    name = filenames.committed_file_name(
        F.lit("host-1"), filenames.collector_file_name(F.lit("a-b"), at, F.lit(7))
    )
    df = spark.range(1).select(name.alias("name"))
    assert df.first().name == "host-1-a-b-2012-11-05-14-20_00007.gz"
    assert parse(spark, df.first().name, "a-b").collector == "host-1"


def test_positional_parts_agree_with_the_pattern(spark):
    names = [
        "c1-a-test-2012-11-05-14-20_00003.gz", "c.x_1-a-test-2012-11-05-14-20_00003.gz",
        "a-test-2012-11-05-14-20_00003.gz", "c1-b-test-2012-11-05-14-20_00003.gz", "invalid", "",
        "c1-a-test-2012-13-05-14-20_00003.gz", "c1-a-test-2012-11-05-14-20_x.gz", "_", "a_b",
    ]
    df = spark.createDataFrame([(n, "a-test") for n in names], "name string, topic string")
    name = F.col("name")
    rows = filenames.parse_file_names(df, "name", "topic").select(
        "name", "valid", "collector", "file_minute", "file_id",
        filenames.collector_of(name, "a-test").alias("c"),
        filenames.file_minute_of(name).alias("m"),
        filenames.file_id_of(name).alias("i"),
    ).collect()
    assert sum(r.valid for r in rows) == 2
    for r in rows:
        whole = r.c is not None and r.m is not None and r.i is not None
        assert whole == r.valid, r
        if whole:
            assert (r.c, r.m, r.i) == (r.collector, r.file_minute, r.file_id)
