"""The line test against Python's json, case by case."""

import json
from pathlib import Path

from chatterlens.functions.wordlists import SLANG
from chatterlens.operators import validate as V
from chatterlens.sources.results import BatchTable
from pyspark.sql import functions as F

LINES = [
    '{"a":1} trailing', '{"a":1}{"x":1}', "{'a':1}", '{"a":1,}', '{"a":1', '{"a":NaN}', '{"a":Infinity}', '{"a":-Infinity}',
    "[1,2]", "5", '"x"', "null", "true", "", "  ", '{"a":null}', '{"b":1}', "x", '{"a":{"b":[1,{"c":2}]},"t":"q"}', ' {"a":1} ',
    '{"a":1}],[{"a":2}', '{"a":01}', '{"a":"\t"}', '{"a":1},"b":{"a":1}', "{}", '{"a":1}}', "NaN", '{"a" 1}', "{a:1}", '{"a":+1}',
    '{"a":1,"a":2}', '{"a":{"x":1,"x":[2,]}}', '{"b":1,"b":2}', '{"a":{"x":1,"x":2},"a":null}', '{"a":1,"a":}', '{"a":1,\'a\':2}',
    '{"a":"x\\y"}', '{"a":1]', '{"a":[1,],"b":2}', '{"a":{"x":1,}}', '[{"a":1}]', '{"a":1 "b":2}', "]", "[", '{"a":"NaN",}',
]


def test_lines_as_python_reads_them(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    value = F.col("value")
    for row in lines.select("value", V.is_json(value).alias("valid"), V.has_keys(value, ["a"]).alias("has")).collect():
        try:
            found, valid = json.loads(row.value), True
        except ValueError:
            found, valid = None, False
        assert (row.valid, row.has) == (valid, isinstance(found, dict) and "a" in found), row.value


def test_last_value_of_a_repeated_key_counts(spark):
    lines = ['{"id":"1","id":"2","score":1,"score":7}', '{"id":"1","score":3,"id":null}', '{"id":"1","score":[1],"score":"4"}']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    for row in V.parse_json_lines(frame).select("value", "is_json", "id", "score").collect():
        wanted = json.loads(row.value)
        assert row.is_json and row.id == wanted["id"] and row.score == int(wanted["score"])


def test_no_slang_entry_is_missing():
    assert len(SLANG) == 227 and {"ily", "imu", "glhf", "lmfao", "iow", "aamof", "oic", "sk8", "wassup", "IG"} <= set(SLANG)


def test_uncommitted_batch_is_not_there(spark, folder):
    table = BatchTable(spark, folder("state"), "n bigint")
    table.write(spark.range(3).toDF("n"), 0)
    (Path(folder("state")) / "batch_id=1" / "_temporary").mkdir(parents=True)
    assert table.newest_batch() == 0 and not table.has_batch(1) and table.read_batch(0).count() == 3
