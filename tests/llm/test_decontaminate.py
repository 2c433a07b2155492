import collections
import hashlib
import re

from pavilion.llm import decontaminate

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def brute(docs, items):
    windows, lengths = collections.defaultdict(set), set()
    for item, text in items:
        own = words(text)
        n = min(10, len(own))
        if n and item is not None:
            lengths.add(n)
            for i in range(len(own) - n + 1):
                windows[tuple(own[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if items_of := windows.get(tuple(own[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


DOCS = [
    (1, "a b c d e f g h i j k l m"), (1, "a b c d e f g h i j k l m"), (2, None), (3, ""), (None, "k l m n O p"), (5, "c d"),
    (4, "X y\x00Z. É é 9 " + "a " * 30), (6, "zz A-b c d e f g h i j zz b c d e f g h i j k zz"), (1, "n o"), (7, "... \n"),
]
ITEMS = [
    (1, "a b c d e f g h i j k"), (2, "l m"), (3, "y z é"), (4, None), (5, ""), (6, "a " * 11), (7, "a b c d e f g h i j k"), (7, "a b c d e f g h i j k"),
    (8, "k l m n"), (None, "a b"), (10, "É"), (11, "a b c d e f g h i"),
]


def test_small_cases(spark):
    docs = spark.createDataFrame([(*d, 1, "h") for d in DOCS], "doc_id long, text string, grams int, hash string")
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, pos int")
    assert sorted(map(tuple, decontaminate.judge(docs, items).collect()), key=str) == brute(DOCS, ITEMS)
    clean = decontaminate.keep_clean(docs, items)
    assert clean.columns == docs.columns
    expected = [d for d, row in zip(DOCS, (brute([d], ITEMS)[0] for d in DOCS)) if not row[-1]]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(expected, key=str)


def test_every_long_shared_span_is_found(spark):
    """Items and documents that share spans of 8 to 14 words at all offsets, repeated words included."""
    item = [f"w{i % 7}" for i in range(40)]
    docs = [(n * 100 + i, " ".join(["x", *item[i : i + n], "y"])) for n in range(8, 15) for i in range(0, 40 - n, 3)]
    items = [(1, " ".join(item)), (2, " ".join(item[5:30]))]
    got = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_whole_table(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, tests = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert sorted(map(tuple, decontaminate.judge(docs, items).collect()), key=str) == brute(rows, tests)


def test_native_plan(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.judge(docs, items)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
