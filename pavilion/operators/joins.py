"""Top rows with ties, and lookups of keys that may be missing."""

from pyspark.sql import Column, DataFrame, functions as F


def top_ties(df: DataFrame, value: str) -> DataFrame:
    """The rows with the highest value, all ties kept. The highest value is one row."""
    top = df.agg(F.max(value).alias("__top"))
    return df.join(F.broadcast(top), df[value].eqNullSafe(top["__top"]), "left_semi")


def left_join_apart(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """df left joined to dim by key; rows without a key, which match nothing, never enter the exchange.

    df is read twice, with a filter on the key that reaches the scan. For several keys see left_join_spread.
    """
    keyed = df.filter(F.col(key).isNotNull()).join(dim, key, "left")
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema if f.name != key]
    rest = df.filter(F.col(key).isNull()).select("*", *added)
    return keyed.select(*rest.columns).unionAll(rest)


def left_join_spread(df: DataFrame, dim: DataFrame, key: str, none: Column) -> DataFrame:
    """df left joined to dim by key; a row without a key takes the key none, which dim has nowhere.

    none differs from row to row, so that a shuffled join spreads the rows without a key instead of sending all to one task.
    """
    keyed = df.withColumn("__key", F.coalesce(F.col(key), none))
    named = dim.withColumnRenamed(key, "__key")
    return keyed.join(named, "__key", "left").drop("__key")
