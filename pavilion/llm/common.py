"""What several operators share: tables by name, keys of rows, arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Longest int64: a null doc_id is ordered after every other.
NULL_ID = (1 << 63) - 1
# Rows that a task turns into Python values at a time, and bytes that it gathers before it hands them on.
SLICE, FLUSH_BYTES = 256, 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text="text"):
    """64 bits of a text; with doc_id it tells rows apart, equal for repeated rows only."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def id_or_last(doc_id="doc_id"):
    return F.coalesce(F.col(doc_id), F.lit(NULL_ID))


class Remembered(dict):
    """make(key) of every key asked for. The last bound keys and those asked again since the bound before them are kept."""

    def __init__(self, make, bound: int):
        super().__init__()
        self.make, self.bound, self.older = make, bound, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def map_rows(df: DataFrame, row, schema: str) -> DataFrame:
    """Each row's tuple of values to a tuple of the schema's, batch by batch; no state outlives a task.

    row is a factory called once a task, so that what it sets up is made there.
    """
    spark_schema = df.sparkSession.createDataFrame([], schema).schema

    def batches(its):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(spark_schema)
        one = row()
        for batch in its:
            for start in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(start, SLICE).columns]
                out, size = [], 0
                for values in zip(*columns):
                    made = one(*values)
                    out.append(made)
                    size += sum(v.nbytes if isinstance(v, np.ndarray) else len(v) for v in made if isinstance(v, (str, bytes, list, np.ndarray)))
                    if size > FLUSH_BYTES:
                        yield _batch(out, target)
                        out, size = [], 0
                if out:
                    yield _batch(out, target)

    return df.mapInArrow(batches, spark_schema)


def _batch(rows, target):
    arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def spread(df: DataFrame, *keys) -> DataFrame:
    """Deal rows out by a hash of the keys, into as many parts as shuffles have."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def where_after(df: DataFrame, condition) -> DataFrame:
    """df.filter(condition), worked out from df's columns as they are.

    A plain filter is written into the expressions below it, where lambdas would repeat them for each element. It is not moved
    below a column that depends on the partition, and this one asks for such a column.
    """
    return df.withColumn("__fence", F.spark_partition_id()).filter(condition & (F.col("__fence") >= 0)).drop("__fence")
