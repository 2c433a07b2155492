from pavilion.functions.blanks import blank_zero, divide, minus, plus, text
from pavilion.functions.cricket import two_decimals
from pavilion.functions.elapsed import elapsed_measure, elapsed_report, seconds_between
from pyspark.sql import functions as F


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def null():
    return F.lit(None).cast("int")


def test_blanks(spark):
    three, none = F.lit(3), null()
    assert one(spark, plus(three, none), plus(none, none), minus(none, three), minus(three, three)) == (3, None, -3, 0)
    assert one(spark, divide(three, F.lit(0)), divide(three, none), divide(three, F.lit(2))) == (None, None, 1.5)
    assert one(spark, text("a", none, three), blank_zero(F.lit(0).cast("long"))) == ("a3", None)


def test_two_decimals(spark):
    cases = [(1, 3, ".33"), (1, 2, ".50"), (1, 8, ".13"), (57, 8, "7.13"), (19, 1, "19.00"), (0, 4, ".00"), (2999, 1000, "3.00")]
    assert one(spark, *[two_decimals(F.lit(a), F.lit(b)) for a, b, _ in cases]) == tuple(c[2] for c in cases)


def test_elapsed(spark):
    seconds = [0, 59, 60, 3600, 3661, 90061, 86400]
    assert one(spark, *[elapsed_report(F.lit(s)) for s in seconds]) == (
        "0 sec", "59 sec", "1 min 0 sec", "1 hrs 0 min", "1 hrs 1 min", "1 day 1 hrs 1 min", "1 day 0 hrs 0 min",
    )
    assert one(spark, *[elapsed_measure(F.lit(s)) for s in seconds]) == (
        "", "59 sec", "1 min ", "1hrs ", "1hrs 1 min 1 sec", "1 day 1hrs 1 min 1 sec", "1 day ",
    )
    start, end = F.lit("2024-01-01 00:00:00.9"), F.lit("2024-01-01 00:00:01.1")
    assert one(spark, seconds_between(start, end)) == (1,)  # boundaries, not whole seconds
