"""Tables by name: read, replace, append, merge, gate.

A table is an external catalog table over a versioned folder. Replacing it writes a new
folder and then points the table to it, so readers see the old rows or the new ones, and a
job that reads a table may replace it.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pavilion.operators.ordinals import dense_ids
from pavilion.session import materialize


def create_schemas(spark: SparkSession, *schemas) -> None:
    for schema in schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def list_schemas(spark: SparkSession) -> list:
    return [db.name for db in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, schema: str) -> list:
    return [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def digits_only(value: Column) -> Column:
    """The number left of a text once everything but its digits is removed."""
    return F.regexp_replace(value, "[^0-9]", "").try_cast("long")


def _location(spark, name) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _add_missing_columns(df: DataFrame, name: str) -> None:
    known = set(df.sparkSession.table(name).columns)
    new = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name not in known]
    if new:
        df.sparkSession.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def evenly(df: DataFrame) -> DataFrame:
    """Rows dealt out so that a write makes files of the session's advisory partition size."""
    return df.hint("rebalance")


def replace_table(df: DataFrame, name: str) -> None:
    """Creates or replaces a table; new columns are added, columns df lacks read as null."""
    spark = df.sparkSession
    schema, table = name.split(".")
    home = spark.sql(f"DESCRIBE SCHEMA {schema}").filter("info_name = 'Location'").first()["info_value"]
    path = f"{home}/{table}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if table_exists(spark, name):
        _add_missing_columns(df, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(name)


def append_table(df: DataFrame, name: str) -> None:
    spark = df.sparkSession
    if not table_exists(spark, name):
        return replace_table(df, name)
    _add_missing_columns(df, name)
    target = spark.table(name)
    known = set(df.columns)
    row = [F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema]
    df.select(*row).write.insertInto(name)
    spark.catalog.refreshTable(name)


def merged_files(spark: SparkSession, name: str) -> DataFrame:
    """A table's rows under one schema merged from those of its files, whatever the catalog knows of later columns."""
    return spark.read.option("mergeSchema", True).parquet(_location(spark, name))


def create_partitioned(df: DataFrame, name: str, by: list) -> None:
    """Creates a table with a folder for each value of the columns by, which come last. Writes overwrite only the folders they have
    rows for.
    """
    spark = df.sparkSession
    schema, table = name.split(".")
    home = spark.sql(f"DESCRIBE SCHEMA {schema}").filter("info_name = 'Location'").first()["info_value"]
    ordered = df.select(*[c for c in df.columns if c not in by], *by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY ({', '.join(by)}) LOCATION '{home}/{table}/{uuid.uuid4().hex}'"
    )
    _overwrite_partitions(ordered, name, by)


def _overwrite_partitions(df: DataFrame, name: str, by: list) -> None:
    # A folder's rows are dealt out evenly, not all to one task, and make files of the advisory size.
    df.hint("rebalance", *by).write.mode("overwrite").insertInto(name)
    df.sparkSession.catalog.refreshTable(name)


def partition_columns(spark: SparkSession, name: str) -> list:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def merge_insert(source: DataFrame, name: str, on) -> None:
    """Appends the source rows whose key the table does not have."""
    target = source.sparkSession.table(name).select(*on)
    append_table(source.join(target, on, "left_anti"), name)


def updated(target: DataFrame, source: DataFrame, on, changes: dict) -> DataFrame:
    """target with {column: expression over t and s} applied where a source row matches on the key.

    Two source rows with one key are an error, as it is not said which of them to take.
    """
    alone = F.count(F.lit(1)).over(Window.partitionBy(*on)) == 1
    several = F.raise_error(F.lit(f"several source rows for one {', '.join(on)}")).cast("boolean")
    joined = target.alias("t").join(
        source.withColumn("__matched", F.when(alone, True).otherwise(several)).alias("s"),
        [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on],
        "left",
    )
    row = [
        F.when(F.col("s.__matched"), F.expr(changes[c])).otherwise(F.col(f"t.{c}")).alias(c)
        if c in changes else F.col(f"t.{c}")
        for c in target.columns
    ]
    return joined.select(*row)


def merge_update(source: DataFrame, name: str, on, changes: dict) -> None:
    """Updates a table's rows. Of a partitioned table only the folders that have a row to be updated are written again.

    The columns of the partitioning cannot change. Rows are written apart before they replace the folders they are read from.
    """
    spark = source.sparkSession
    target, by = spark.table(name), partition_columns(spark, name)
    if not by:
        return replace_table(updated(target, source, on, changes), name)
    if set(by) & set(changes):
        raise ValueError(f"rows cannot move between partitions: {', '.join(by)}")
    matched = target.join(source.select(*on), on, "left_semi").select(*[F.col(c).alias(f"__{c}") for c in by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    rows = materialize(updated(target.join(matched, same, "left_semi"), source, on, changes), "updated")
    _overwrite_partitions(rows, name, by)


def upsert_names(existing: DataFrame, names: DataFrame, id_name: str, name: str) -> DataFrame:
    """The rows to insert: names not yet in the dimension, with ids that follow its highest."""
    new = names.select(name).distinct().join(existing.select(name), name, "left_anti")
    highest = existing.agg(F.max(id_name)).first()[0]
    return dense_ids(new, name, id_name, first=max(highest or 0, 0) + 1)


def create_or_insert_names(names: DataFrame, table: str, id_name: str, name: str) -> None:
    """Dimension upsert: creates the table, or inserts the names it does not know."""
    spark = names.sparkSession
    if table_exists(spark, table):
        append_table(upsert_names(spark.table(table), names, id_name, name), table)
    else:
        replace_table(dense_ids(names, name, id_name), table)


def name_hash(name, bits=63, seed="") -> Column:
    """A number from 1 to 2^bits that follows from a name alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(name)), F.lit((1 << bits) - 1)) + 1


def hashed_rows(names: DataFrame, table: str, name: str) -> DataFrame:
    """The names that a dimension does not have, with the moment; what create_or_insert_hashed appends."""
    spark = names.sparkSession
    new = names.select(name).filter(F.col(name).isNotNull()).distinct()
    if table_exists(spark, table):
        new = new.join(spark.table(table).select(name), name, "left_anti")
    return new.withColumn("since", F.current_timestamp())


def create_or_insert_hashed(names: DataFrame, table: str, name: str) -> None:
    """Dimension upsert for writers that do not know of each other: rows are only appended, and no highest id is looked up."""
    append_table(hashed_rows(names, table, name), table)


def hashed_ids(rows: DataFrame, id_name: str, name: str, bits=63) -> DataFrame:
    """One id per name of a dimension of hashed_rows, however often writers put the name in.

    The id is a hash of the name. Of different names with one hash the first to come keeps it; those that come after take a
    number below zero, by a hash of their own, so no id that has been given out changes. Should two of these clash again, the
    read fails rather than to mix them up.
    """
    first = rows.groupBy(name).agg(F.min("since").alias("since")).withColumn("__hash", name_hash(name, bits))
    # Names of one hash: one, but for clashes.
    place = F.row_number().over(Window.partitionBy("__hash").orderBy("since", name))
    ids = first.withColumn("__place", place)
    late = F.col("__place") > 1
    ids = ids.withColumn(id_name, F.when(late, -1 - name_hash(name, 62, "late")).otherwise(F.col("__hash")))
    sharing = F.count(F.lit(1)).over(Window.partitionBy(id_name))
    clash = F.raise_error(F.concat(F.lit("two names share an id: "), name)).cast("bigint")
    return ids.select(F.when(sharing == 1, F.col(id_name)).otherwise(clash).alias(id_name), name)


class NoNewData(Exception):
    """Raised by the gate; a job that ends with it counts as completed."""

    def __init__(self):
        super().__init__("No new data")


def count_gate(have: DataFrame, offered: DataFrame) -> DataFrame:
    """One row: both counts, the difference, and whether there is anything new."""
    sides = have.select(F.lit(1).alias("have"), F.lit(0).alias("offered"))
    sides = sides.unionAll(offered.select(F.lit(0), F.lit(1)))
    counts = sides.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("have", "offered")])
    delta = F.col("offered") - F.col("have")
    return counts.select("have", "offered", delta.alias("delta"), (delta != 0).alias("has_new"))


def new_rows(have: DataFrame, offered: DataFrame, on) -> DataFrame:
    """The rows that are really new, by key; equal counts can hide them."""
    return offered.join(have.select(*on), on, "left_anti")


def require_new_data(spark: SparkSession, name: str, offered: DataFrame) -> int:
    """The number of new rows; raises NoNewData on equal counts. An absent table lets all in."""
    if not table_exists(spark, name):
        return offered.count()
    gate = count_gate(spark.table(name), offered).first()
    if not gate["has_new"]:
        raise NoNewData()
    return gate["delta"]
