import collections
import struct
import zlib

import pytest
import xxhash
from pavilion.llm import sharding


def check(rows, got, shards, slack):
    want = collections.Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in got)
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= slack


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, sharding.shard(docs).collect(), 40, 2 * max(len((t or "").encode()) + 16 for _, t in rows))


def brute_places(rows, shards):
    """(doc_id, size, crc32, shard, slot) by one sort of all records and one running total."""

    def key(doc_id, text):
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        raw = (text or "").encode()
        row = xxhash.xxh64_intdigest(b"row", 42)
        if doc_id is not None:
            row = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), row)
        return signed(xxhash.xxh64_intdigest(raw, 42)), signed(xxhash.xxh64_intdigest(raw, row)), (doc_id is not None, doc_id or 0)

    rows = sorted(rows, key=lambda r: key(*r))
    sizes = [len((t or "").encode()) + 16 for _, t in rows]
    total, before, places, filled = sum(sizes), 0, [], collections.Counter()
    for (doc_id, text), size in zip(rows, sizes):
        shard = min((before + size // 2) * shards // total, shards - 1)
        places.append((doc_id, size, zlib.crc32((text or "").encode()), shard, filled[shard]))
        filled[shard] += 1
        before += size
    return sorted(places, key=str)


@pytest.mark.parametrize("shards", [7, 40])
def test_places_against_one_sort(spark, sf_dir, shards):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(None, "x"), (None, None), (5, "x"), (5, "x")], "doc_id long, text string")
    rows = docs.union(more)
    got = sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard(rows, shards).collect()), key=str)
    assert got == brute_places([tuple(r) for r in rows.collect()], shards)


def test_a_third_in_one_group(spark):
    """Copies that hold a third of all rows are cut at shard borders, not kept in one shard."""
    rows = [(i, "copy " * 20 if i % 3 == 0 else f"text {i} " * (i % 30)) for i in range(3000)] + [(None, None), (5, ""), (5, ""), (5, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, size int")
    got = sharding.shard(docs, shards=7).collect()
    check(rows, got, 7, 1100)
    found = sharding.splitters(sharding.records(docs), shards=7)
    assert len(found) >= 20 and found == sorted(found)


def test_small_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    got = sharding.shard(docs).collect()
    assert len(got) == 3 and all(0 <= r.shard < 40 for r in got)
    assert sharding.shard(docs.limit(0)).count() == 0
