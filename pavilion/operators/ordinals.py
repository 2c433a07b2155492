"""Row numbers that hold up when one group has a third of all rows.

A plain row_number() puts a whole group in one task, which is right for small ones. Rows of a large group are range-partitioned
by (keys, order) instead: each slice numbers its own rows, and the rows of earlier slices are
added as an offset. A null key is a key like any other.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from pavilion.session import materialize

HOT = 1 << 20  # rows of a group above which it is cut into slices


def row_numbers(df: DataFrame, keys, order, name: str, slices=None, hot=HOT) -> DataFrame:
    """df plus row_number() over (partition by keys order by order), a total order. Groups of more than hot rows are spread over
    slices, all groups if slices says how many.

    df is counted by its keys first. There are fewer large groups than one for each hot rows.
    """
    if not keys or slices is not None:
        return _sliced_numbers(df, keys, order, name, slices)
    # A struct of keys equals another one with the same nulls, so null keys find each other in the join.
    marked = df.withColumn("__keys", F.struct(F.lit(0), *keys))
    large = marked.groupBy("__keys").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot).select("__keys")
    large = materialize(large, "large")
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    if large.isEmpty():
        return df.withColumn(name, number)
    few, many = (marked.join(F.broadcast(large), "__keys", how).drop("__keys") for how in ("left_anti", "left_semi"))
    return few.withColumn(name, number).unionByName(_sliced_numbers(many, keys, order, name, slices))


def _sliced_numbers(df, keys, order, name, slices) -> DataFrame:
    """Row numbers of groups of any size.

    The slices are written out before they are counted: range bounds come from a sample,
    and a second run of the same plan could draw others.
    """
    by = [*keys, *order]
    ranges = df.repartitionByRange(*by) if slices is None else df.repartitionByRange(slices, *by)
    sliced = ranges.withColumns({"__slice": F.spark_partition_id(), "__keys": F.struct(F.lit(0), *keys)})
    slices = materialize(sliced, "slices")
    in_slice = W.partitionBy("__slice", "__keys").orderBy(*order)
    before = W.partitionBy("__keys").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    # One row per (slice, key in it): as many as slices, plus one per further key.
    offsets = (
        slices.groupBy("__slice", "__keys")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__slice", "__keys", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    return (
        slices.withColumn(name, F.row_number().over(in_slice).cast("long"))
        .join(offsets, ["__slice", "__keys"])
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop("__slice", "__keys", "__before")
    )


def dense_ids(names: DataFrame, name: str, id_name: str, first=1) -> DataFrame:
    """Distinct names with ids first, first + 1, ... in name order; same ids on every run."""
    distinct = names.select(name).filter(F.col(name).isNotNull()).distinct()
    ids = row_numbers(distinct, [], [name], id_name)
    return ids.select((F.col(id_name) + (first - 1)).alias(id_name), name)


def positions(df: DataFrame, *order, name="position") -> DataFrame:
    """df with the place of each row in a total order, so that the order is a value and survives any shuffle."""
    return row_numbers(df, [], list(order), name)
