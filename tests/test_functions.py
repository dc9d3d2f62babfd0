import datetime as dt

import pytest
from conftest import rows

from millstream.functions import numbers, text


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression).collect()[0][0]


@pytest.mark.parametrize("value", [
    "  a b \r\n", "\t\x0b\x0c x  ", "\x1c\x1dz\x85", "", " \n ", "plain", "　日本 "])
def test_strip_all_is_python_strip(spark, value):
    assert one(spark, value, text.strip_all("c")) == value.strip()


@pytest.mark.parametrize("value", ["..ab,Cd  ef!", "", "...", "one", "naïve café", "a1b2c"])
def test_words_split_on_non_letters(spark, value):
    import re

    expected = [w for w in re.split("[^a-zA-Z]+", value) if w]
    assert one(spark, value, text.words("c")) == expected


@pytest.mark.parametrize("value", [
    ("STR_2", 216), ("it's", -1), ('say "hi"', 0), ("a'b\"c", 5), ("back\\slash", 1), ("x\ny", 2)])
def test_pair_text_is_tuple_text(spark, value):
    df = spark.createDataFrame([value], "k string, v bigint")
    assert df.select(text.pair_text("k", "v")).collect()[0][0] == str(value)


def test_pair_text_of_one_field_and_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v bigint")
    assert df.select(text.pair_text("k")).collect()[0][0] == "('a',)"
    assert df.select(text.pair_text("k", "v")).collect()[0][0] == "('a', None)"


def test_fields(spark):
    df = spark.createDataFrame([("1,ann,5",), ("2",)], "value string")
    split = df.select(text.split_fields("value").alias("f"))
    got = rows(split.select(text.field("f", 1), text.fields_after("f", 0)))
    assert got == [("ann", ["ann", "5"]), (None, [])]


def test_separator_is_literal(spark):
    assert one(spark, "a|b.c", text.split_fields("c", "|")) == ["a", "b.c"]


def test_bytes_roundtrip(spark):
    assert one(spark, "grüße 日", text.from_bytes(text.to_bytes("c"))) == "grüße 日"


def test_record_bytes(spark):
    df = spark.createDataFrame([(7, "a:b")], "id int, name string")
    coded = df.select(text.encode_record("id", "name").alias("c"))
    assert bytes(coded.collect()[0][0]) == b"7:a:b"
    assert rows(coded.select(text.decode_record("c", ["id", "name"]))) == [(("7", "a:b"),)]


def test_numbers(spark):
    assert one(spark, " 42\r", numbers.to_int("c")) == 42
    assert one(spark, "-7", numbers.to_int("c")) == -7
    assert one(spark, "x", numbers.to_int("c", "null")) is None
    assert one(spark, "1.5", numbers.to_int("c", "null")) is None
    assert one(spark, None, numbers.to_int("c")) is None
    assert one(spark, "2.5", numbers.to_float("c")) == 2.5
    assert one(spark, "03-11-2019", numbers.to_day("c")) == dt.date(2019, 11, 3)
    assert one(spark, 29.27, numbers.to_cents("c"), "double") == 2927


@pytest.mark.parametrize("convert,bad", [
    (numbers.to_int, "4x"), (numbers.to_float, "four"), (numbers.to_day, "2019-11-03")])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_stops_the_job(spark, convert, bad, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a"):
            one(spark, bad, convert("c"))
        assert one(spark, bad, convert("c", on_error="null")) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
