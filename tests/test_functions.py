"""Functions, one by one."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.functions.json import json_get, normalised, parse_paths, select_paths
from eventmart.functions.keys import bucket_of, hex_md5
from eventmart.functions.time import hours_ago, lookback_day, trunc_hour
from eventmart.session import scratch_dir

# JSON texts, and the text at $.a.b.
AT_PATH = {
    '{"a":{"b":"x"}}': "x",
    '{"a":{"b":null}}': None,
    '{"a":{}}': None,
    '{"a":null}': None,
    '{"a":"s"}': None,
    '{"a":[{"b":1}]}': None,
    '{"a":{"b":42}}': "42",
    '{"a":{"b":1.50}}': "1.5",
    '{"a":{"b":true}}': "true",
    '{"a":{"b":{"c":1, "d":[1, 2]}}}': '{"c":1,"d":[1,2]}',
    '{"a":{"b":[1, "x"]}}': '[1,"x"]',
    '{"a":{"b":""}}': "",
    '{"a":{"b":"é\\n"}}': "é\n",
    '{"x":1}': None,
    "[1]": None,
    "{bad": None,
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in [*AT_PATH, None]], "t string")


def test_json_get(texts):
    rows = texts.select("t", json_get("t", "$.a.b").alias("got"), F.get_json_object("t", "$.a.b").alias("same"))
    for row in rows.collect():
        assert row["got"] == AT_PATH.get(row["t"]) == row["same"]


def test_json_get_last_of_repeated_keys(spark):
    rows = spark.createDataFrame([('{"a":1,"a":2}',)], "t string")
    assert rows.select(json_get("t", "$.a")).first()[0] == "2"


def test_many_paths_in_one_pass(texts):
    paths = {"b": "$.a.b", "x": "$.x"}
    rows = texts.select("t", parse_paths("t", list(paths.values())).alias("p")).select("t", *select_paths("p", paths))
    for row in rows.collect():
        assert row["b"] == AT_PATH.get(row["t"])
        assert row["x"] == ("1" if row["t"] == '{"x":1}' else None)


@pytest.mark.parametrize("paths", [["$.a", "$.a.b"], ["a"], ["$"]])
def test_paths_that_cannot_be_read_together(paths):
    with pytest.raises(ValueError):
        parse_paths("t", paths)


def test_normalised(spark):
    rows = spark.createDataFrame([('{ "b" : [1, {"a": null}],\n "a": "x y" }',)], "t string")
    assert rows.select(normalised("t")).first()[0] == '{"b":[1,{"a":null}],"a":"x y"}'


def test_time(spark):
    at = datetime(2024, 1, 2, 1, 59, 59, 999999)
    rows = spark.createDataFrame([(at,)], "at timestamp_ntz")
    hour, before = rows.select(trunc_hour("at").alias("h"), hours_ago(3, at)).first()
    assert hour == datetime(2024, 1, 2, 1)
    assert before == datetime(2024, 1, 1, 22, 59, 59, 999999)
    assert dict(rows.select(trunc_hour("at").alias("h"), hours_ago(3).alias("b")).dtypes) == {
        "h": "timestamp_ntz",
        "b": "timestamp_ntz",
    }
    assert lookback_day(at, 3) == datetime(2024, 1, 1)


def test_keys(spark):
    rows = spark.createDataFrame([("abc",)], "t string")
    digest, bucket = rows.select(hex_md5("t"), bucket_of("t", 16)).first()
    assert digest == "900150983cd24fb0d6963f7d28e17f72"
    assert 0 <= bucket < 16


def test_scratch_folder_comes_from_the_session(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second
