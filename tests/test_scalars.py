import hashlib

import pytest
from pyspark.sql import functions as F

from wardlake.functions import scalars


def column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "number",
    [
        "98.6", "5", "100.0", "12345678.9", "0.0005", "1e-05", "1.5e-07", "1e16",
        "9999999.0", "1e7", "12345678901234.5", "-0.00025", "-1234567890.125",
        "0.001", "123456789012345680.0", "2.5e+100", "10000000.0", "1234567.0",
    ],
)
def test_number_text_prints_like_a_float(spark, number):
    frame = spark.range(1).select(
        F.from_json(F.lit(f'{{"v":{number}}}'), "v string").alias("r")
    )
    printed = frame.select(scalars.number_text(F.col("r.v"))).first()[0]
    exact = "." in number or "e" in number
    assert printed == (str(float(number)) if exact else number)


def test_number_text_leaves_other_text(spark):
    values = ["E", "1E5x", "abc", "", None]
    assert column(spark, values, scalars.number_text) == values


def test_reference_tail(spark):
    values = ["Patient/abc", "abc", "a/b/c", "Patient/", "", None]
    expected = ["abc", "abc", "c", "", None, None]
    assert column(spark, values, scalars.reference_tail) == expected


def test_stable_key_matches_md5(spark):
    expected = hashlib.md5(b"patient:p-1").hexdigest()
    found = column(spark, ["p-1", None], lambda c: scalars.stable_key("patient", c))
    assert found == [expected, None]


def test_wall_clock_reads_local_time_in_any_session_zone(spark):
    values = [
        "2180-05-01T10:20:30-04:00",
        "2180-05-01",
        "2180-05",
        "2180",
        "2180-05-01T24:00:00",
        "unknown",
        "2021-03-14T02:30:00",  # skipped by daylight saving in New York
        None,
    ]
    found = column(spark, values, lambda c: scalars.wall_clock(c).cast("string"))
    assert found == [
        "2180-05-01 10:20:30",
        "2180-05-01 00:00:00",
        None,
        None,
        "2180-05-02 00:00:00",
        None,
        "2021-03-14 02:30:00",
        None,
    ]


def test_hour_boundaries_count_marks_not_elapsed_hours(spark):
    pairs = [
        ("2180-01-01T22:30:00", "2180-01-02T00:15:00", 2),
        ("2180-01-01T22:30:00", "2180-01-01T22:59:00", 0),
        ("2180-01-02T00:15:00", "2180-01-01T22:30:00", -2),
        ("2180-01-01", None, None),
    ]
    frame = spark.createDataFrame(pairs, "a string, b string, n bigint")
    a, b = (scalars.wall_clock(F.col(c)) for c in "ab")
    for row in frame.select(scalars.hour_boundaries(a, b).alias("h"), "n").collect():
        assert row["h"] == row["n"]


def test_number_or_null(spark):
    values = ["12.5", " 7 ", "1e3", "1d", "2.0F", "1_000", "abc", "", "inf", None]
    found = column(spark, values, scalars.number_or_null)
    assert found == [12.5, 7.0, 1000.0, None, None, 1000.0, None, None, float("inf"), None]


def test_ascii_escaped(spark):
    values = ["plain", "é€", "a😀b", None]
    found = column(spark, values, scalars.ascii_escaped)
    assert found == ["plain", "\\u00e9\\u20ac", "a\\ud83d\\ude00b", None]


def test_filled_or(spark):
    found = column(spark, ["x", "", None], lambda c: scalars.filled_or(c, F.lit("f")))
    assert found == ["x", "f", "f"]
