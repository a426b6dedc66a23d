import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from arriero.functions.calendar import date_key, iso_weekday, month_start, previous_month, to_local
from arriero.functions.identity import is_natural_person, pseudonym, surrogate_key
from arriero.functions.text import blank_to_null, day_first_timestamp, decimal_comma, iso_date, iso_timestamp, last_letter, whole_number, yes_flag


def one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x").alias("y")).collect()]


def test_decimal_comma(spark):
    got = one(spark, ["", " 1,5 ", "1.234,56", None, "-3", "abc", "12345678901234567890,1"], decimal_comma)
    assert got == [None, Decimal("1.5000"), None, None, Decimal("-3.0000"), None, None]


def test_decimal_comma_other_type(spark):
    assert one(spark, ["19,0", "1234,5"], lambda c: decimal_comma(c, 5, 2)) == [Decimal("19.00"), None]


def test_blank_and_flag(spark):
    assert one(spark, ["", " ", "a", None], blank_to_null) == [None, " ", "a", None]
    assert one(spark, ["Si", "si", "No", "", None], yes_flag) == [True, False, False, False, None]


def test_whole_number_cuts_fraction(spark):
    assert one(spark, ["7", "7.9", "x", "", None, "99999999999"], whole_number) == [7, 7, None, None, None, None]
    assert one(spark, ["99999999999"], lambda c: whole_number(c, "bigint")) == [99999999999]


def test_dates(spark):
    assert one(spark, ["2026-09-01", "2026-02-30", "x", "2026-09-01 10:00:00", None], iso_date) == [
        dt.date(2026, 9, 1), None, None, dt.date(2026, 9, 1), None]
    assert one(spark, ["2026-09-01T10:00:00.25", "nunca"], iso_timestamp) == [dt.datetime(2026, 9, 1, 10, 0, 0, 250000), None]


def test_day_first(spark):
    got = one(spark, ["05-09-2026 23:59:59", "2026-09-05 23:59:59", "32-01-2026 00:00:00", "5-9-26 1:1:1", None], day_first_timestamp)
    assert got == [dt.datetime(2026, 9, 5, 23, 59, 59), None, None, None, None]


def test_last_letter(spark):
    assert one(spark, ["T502 00I", "506R", "X", "", None], lambda c: last_letter(c, ("I", "R"))) == ["I", "R", None, None, None]


def test_natural_person(spark):
    ids = ["12.345.678-9", "49999999-K", "50.000.000-1", "76543210", None, "sin rut", "", "-5"]
    assert one(spark, ids, is_natural_person) == [True, True, False, False, None, None, None, None]


def test_pseudonym_ignores_spelling(spark):
    got = one(spark, ["12.345.678-k", "12345678-K", "12345678K", None], lambda c: pseudonym(c, "k'ey"))
    assert got[0] == got[1] == got[2] == hashlib.sha256(b"k'ey12345678K").hexdigest()
    assert got[3] is None


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "x string, y int").select(surrogate_key("x", "y").alias("k"))
    a, b, c = [r.k for r in df.collect()]
    assert a == b != c


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 4),)], "d date")
    r = df.select(date_key("d").alias("k"), iso_weekday("d").alias("w"), previous_month("d").alias("p"),
                  month_start(F.lit("2026-01")).alias("s")).first()
    assert (r.k, r.w, r.p, r.s) == (20260104, 7, "2025-12", dt.date(2026, 1, 1))


def test_local_time_knows_summer(spark):
    df = spark.createDataFrame([("2026-01-01 02:00:00",), ("2026-07-01 02:00:00",)], "t string")
    got = [r[0] for r in df.select(to_local(F.col("t").cast("timestamp_ntz"))).collect()]
    assert got == [dt.datetime(2025, 12, 31, 23, 0), dt.datetime(2026, 6, 30, 22, 0)]
