"""Running totals over an ordinal (overs, ball numbers), safe for very long groups."""

from pyspark.sql import DataFrame, Window as W, functions as F

SPAN = 4096  # ordinals per span: one task never sorts more of one group than this


def running_totals(df: DataFrame, keys, ordinal: str, totals: dict, span=SPAN) -> DataFrame:
    """Adds, for each {output: column} of totals, the sum over rows with ordinal <= this row's.

    Rows that share an ordinal are peers and see each other, as in a range frame. Every group is cut into spans of
    ordinals; each span runs on its own, and starts from the totals of the spans before it, of which a group has one row
    each. Null keys form a group like any other; rows without an ordinal come before all.
    """
    # A struct of keys equals another one with the same nulls.
    cut = df.withColumn("__span", F.struct(*keys, F.floor(F.col(ordinal) / span).alias("__at")))
    earlier = W.partitionBy(*[f"__span.{k}" for k in keys]).orderBy("__span.__at").rowsBetween(W.unboundedPreceding, -1)
    sums = cut.groupBy("__span").agg(*[F.sum(c).alias(f"__{out}") for out, c in totals.items()])
    carried = sums.select("__span", *[F.sum(f"__{out}").over(earlier).alias(f"__{out}") for out in totals])
    within = W.partitionBy("__span").orderBy(ordinal).rangeBetween(W.unboundedPreceding, 0)
    local = cut.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(out) for out, c in totals.items()])
    return local.join(carried, "__span", "left").select(
        *df.columns, *[(F.col(out) + F.coalesce(f"__{out}", F.lit(0))).alias(out) for out in totals]
    )
