"""Blank-aware arithmetic and text.

The measure definitions treat a missing value as "blank": it counts as 0 next to a
number, as "" next to a text, and stays blank when there is nothing but blanks.
"""

from pyspark.sql import Column, functions as F


def blank_zero(n: Column) -> Column:
    """A row count of nothing shows blank, not 0."""
    return F.nullif(n, F.lit(0).cast("long"))


def plus(*terms: Column) -> Column:
    total = F.coalesce(terms[0], F.lit(0))
    for term in terms[1:]:
        total = total + F.coalesce(term, F.lit(0))
    return F.when(F.coalesce(*terms).isNotNull(), total)


def minus(first: Column, *rest: Column) -> Column:
    return plus(first, *[-term for term in rest])


def divide(a: Column, b: Column) -> Column:
    """Blank on a blank or zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def text(*parts) -> Column:
    """Joins values to one text; blanks add nothing."""
    return F.concat_ws("", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
