"""Shards of near equal bytes by sampled splitters; DataFrame operations only.

Records are ordered by (hash of the text, hash of the row, doc_id), so equal texts are neighbours. A sample in which a
record's chance follows its bytes gives the splitters: quantiles of it cut the order into ranges of about
equal bytes, also inside a group of equal texts, however large. Exact totals are then taken per range; a range that
holds far more than its share is cut again by a denser sample of its own. Totals of the ranges before it
and a running total within give each record its exact place, and the place gives shard and slot: the law is `bytes`, shards
differ by less than a record.

Defined cases: a null text counts as empty (its own 16 bytes, crc32 0); equal rows are placed one after the other in
any order, as no one can tell them apart; an empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pavilion.session import materialize

SHARDS = 40
RECORD_BYTES = 16
# Ranges a shard is made of, records sampled for a range, and the share of a range from which it is cut again.
RANGES_PER_SHARD, SAMPLED, OVERFULL = 4, 24, 2.0
ROUNDS = 4
KEY = ("__text_hash", "__row_hash")


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("__id"),
        (F.octet_length(text).cast("long") + RECORD_BYTES).alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc32"),
        F.xxhash64(text).alias("__text_hash"),
        F.xxhash64(F.lit("row"), F.col("doc_id"), text).alias("__row_hash"),
    )


def _draw(rows: DataFrame, rate) -> DataFrame:
    """Records whose own random number falls below bytes x rate: a sample weighted by size, the same on every run."""
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "__row_hash", "__text_hash"), 11).cast("double") / float(1 << 53)
    return rows.filter(chance < F.col("__size") * rate)


def _quantiles(sample: DataFrame, parts: int) -> list:
    """parts - 1 keys that cut the sample evenly. The sample holds about parts x SAMPLED records: bounded."""
    keys = sorted((r[0], r[1]) for r in sample.select(*KEY).collect())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _range_of(splitters: list, first: int = 0):
    """The number of splitters at or below a record's key, by binary search."""
    if not splitters:
        return F.lit(first)
    middle = len(splitters) // 2
    text, row = splitters[middle]
    below = (F.col(KEY[0]) < text) | ((F.col(KEY[0]) == text) & (F.col(KEY[1]) < row))
    return F.when(below, _range_of(splitters[:middle], first)).otherwise(_range_of(splitters[middle + 1 :], first + middle + 1))


def splitters(rows: DataFrame, shards=SHARDS, per_shard=RANGES_PER_SHARD, sampled=SAMPLED) -> list:
    """Keys between ranges none of which holds much more than its share, if its records can be told apart."""
    total = rows.agg(F.sum("__size")).first()[0]
    if not total:
        return []
    parts = shards * per_shard
    found = _quantiles(_draw(rows, F.lit(parts * sampled / total)), parts)
    for _ in range(ROUNDS):
        ranged = rows.withColumn("__range", _range_of(found))
        held = ranged.groupBy("__range").agg(F.sum("__size").alias("bytes"), F.countDistinct(*KEY).alias("keys"))
        over = held.filter((F.col("bytes") > OVERFULL * total / parts) & (F.col("keys") > 1)).collect()
        if not over:
            break
        full = {r["__range"]: r["bytes"] for r in over}
        added = []
        for number, size in full.items():
            pieces = int(size * parts / total) + 1
            added += _quantiles(_draw(ranged.filter(F.col("__range") == number), F.lit(pieces * sampled / size)), pieces)
        found = sorted({*found, *added})
    return found


def shard(docs: DataFrame, shards=SHARDS, per_shard=RANGES_PER_SHARD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: shards are not grown by key) of every row."""
    rows = materialize(records(docs), "records")
    ranged = rows.withColumn("__range", _range_of(splitters(rows, shards, per_shard)))
    held = ranged.groupBy("__range").agg(F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
    # One row a range: bounded by the number of splitters, which the shards and not the records set.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        "__range",
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        F.sum("__bytes").over(Window.partitionBy(F.lit(0))).alias("__total"),
    )
    order = Window.partitionBy("__range").orderBy(*KEY, "__id", "__size")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumns(
        {"__bytes_in": F.coalesce(F.sum("__size").over(running), F.lit(0)), "__rank_in": F.row_number().over(order) - 1}
    )
    place = F.col("__bytes_before") + F.col("__bytes_in") + (F.col("__size") / 2).cast("long")
    placed = within.join(F.broadcast(offsets), "__range").select(
        "__id", "__size", "__crc32",
        F.least(F.floor(place.cast("decimal(38,0)") * shards / F.col("__total")), F.lit(shards - 1)).cast("int").alias("__shard"),
        (F.col("__rows_before") + F.col("__rank_in")).alias("__rank"),
    )
    placed = materialize(placed, "places")
    # One row a shard.
    firsts = placed.groupBy(F.col("__shard").alias("__of")).agg(F.min("__rank").alias("__first"))
    return placed.join(F.broadcast(firsts), F.col("__shard") == F.col("__of")).select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__crc32").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("__shard").alias("shard"),
        (F.col("__rank") - F.col("__first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
