"""Durations of jobs, and their two text forms."""

from pyspark.sql import Column, functions as F

from pavilion.functions.blanks import text


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed, as DATEDIFF counts them."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def whole(a: Column, b: int) -> Column:
    """Whole part of a / b for a non-negative a."""
    return ((a - a % b) / b).cast("long")


def elapsed_report(sec: Column) -> Column:
    """The job report's text: the largest units only."""
    hours, minutes = whole(sec % 86400, 3600), whole(sec % 3600, 60)
    return (
        F.when(sec < 60, text(sec, " sec"))
        .when(sec < 3600, text(whole(sec, 60), " min ", sec % 60, " sec"))
        .when(sec < 86400, text(whole(sec, 3600), " hrs ", minutes, " min"))
        .otherwise(text(whole(sec, 86400), " day ", hours, " hrs ", minutes, " min"))
    )


def elapsed_measure(sec: Column) -> Column:
    """The monitor measure's text: every unit above zero."""
    units = [
        (whole(sec, 86400), " day "),
        (whole(sec, 3600) % 24, "hrs "),
        (whole(sec, 60) % 60, " min "),
        (sec % 60, " sec"),
    ]
    return text(*[F.when(n > 0, text(n, unit)) for n, unit in units])
