import json

from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, MapType, StringType,
                               StructField, StructType)

from tessera.functions.decode import bad_sets, decode_attributes, image_size, raw_numbers

SCHEMA = StructType([
    StructField("name", StringType()), StructField("age", LongType()), StructField("score", DoubleType()),
    StructField("active", BooleanType()), StructField("gone", StringType()),
    StructField("tags", ArrayType(StringType())), StructField("nums", ArrayType(LongType())),
    StructField("address", StructType([StructField("city", StringType()), StructField("zip", LongType())])),
    StructField("prefs", MapType(StringType(), StringType())), StructField("cats", ArrayType(StringType())),
    StructField("scores", ArrayType(DoubleType())), StructField("missing", StringType()),
])


def _decode(spark, image: dict):
    df = spark.createDataFrame([(json.dumps(image),)], "j string").select(F.parse_json("j").alias("v"))
    return df.select(decode_attributes(F.col("v"), SCHEMA).alias("d"), raw_numbers(F.col("v"), SCHEMA).alias("b"), bad_sets(F.col("v")).alias("s"),
                     image_size(F.col("v")).alias("n")).first()


def test_scalar_tags(spark):
    r = _decode(spark, {"name": {"S": "Ann"}, "age": {"N": "25"}, "score": {"N": "95.5"},
                        "active": {"BOOL": True}, "gone": {"NULL": True}})
    d = r.d
    assert (d.name, d.age, d.score, d.active, d.gone, d.missing) == ("Ann", 25, 95.5, True, None, None)
    assert r.b is None and r.n == 5 and not r.s


def test_nested_and_set_tags(spark):
    r = _decode(spark, {
        "tags": {"L": [{"S": "a"}, {"S": "b"}]}, "nums": {"NS": ["1", "2"]},
        "address": {"M": {"city": {"S": "Lisbon"}, "zip": {"N": "1000"}}},
        "prefs": {"M": {"theme": {"S": "dark"}, "lang": {"S": "pt"}}},
        "cats": {"SS": ["x", "y"]}, "scores": {"NS": ["1.5", "2"]}})
    d = r.d
    assert d.tags == ["a", "b"] and d.nums == [1, 2] and d.cats == ["x", "y"] and d.scores == [1.5, 2.0]
    assert d.address.city == "Lisbon" and d.address.zip == 1000
    assert d.prefs == {"theme": "dark", "lang": "pt"}


def test_unparseable_number_keeps_its_text(spark):
    r = _decode(spark, {"age": {"N": "abc"}, "score": {"N": "1.5x"}})
    assert r.d.age is None and r.d.score is None
    assert r.b == {"age": "abc", "score": "1.5x"} and not r.s
    # without a point only digits are a number
    assert _decode(spark, {"age": {"N": "1E5"}}).b == {"age": "1E5"}
    assert _decode(spark, {"age": {"N": "1E5"}}).d.age is None


def test_unparseable_set_element_fails(spark):
    assert _decode(spark, {"nums": {"NS": ["1", "x"]}}).s
    assert _decode(spark, {"unknown": {"NS": ["1.5", "y"]}}).s
    assert not _decode(spark, {"nums": {"NS": ["1", "2.5"]}, "name": {"S": '"NS"'}}).s


def test_fractional_number_into_integer_column(spark):
    assert _decode(spark, {"age": {"N": "25.0"}}).d.age == 25


def test_string_tag_wins_over_number(spark):
    assert _decode(spark, {"name": {"S": "x", "N": "1"}}).d.name == "x"


def test_null_image_gives_null_struct(spark):
    df = spark.createDataFrame([(None,)], "j string").select(F.parse_json("j").alias("v"))
    assert df.select(decode_attributes(F.col("v"), SCHEMA).alias("d")).first().d is None
