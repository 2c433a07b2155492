"""Ordered text aggregation."""

from pyspark.sql import DataFrame, functions as F


def joined_text(df: DataFrame, keys, order, value: str, sep: str, name: str) -> DataFrame:
    """One text per key: the values joined by sep in the given order.

    A key's values meet in one task, so keys must bound them: a group that can grow without
    end is to be cut into parts by one more key.
    """
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__text"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda r: r["__text"]), sep).alias(name))
