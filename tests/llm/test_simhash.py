import numpy as np
import pytest
import xxhash
from pavilion.llm import simhash
from pavilion.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """{position: least doc_id reachable} over fingerprints at 4 or fewer differing bits."""
    prints = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4):
            parent[find(i)] = find(i + 1 + int(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, f"{int(prints[i]):016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)]


ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "a b c d e"), (6, "a b c d e"), (None, "x y"), (7, "x é Y\x0bz" * 50), (None, "")]


def test_small_cases(spark):
    docs = spark.createDataFrame([(*r, "f", 1) for r in ROWS], "doc_id long, text string, fingerprint string, component_id int")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute_components(ROWS), key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(0, "x y"), (4, "One"), (6, "a b c d e"), (7, "x é Y\x0bz" * 50)]
    assert [r.doc_id for r in kept.collect() if not r.text] == [1]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == sorted(brute_components(rows))


@pytest.mark.parametrize(("subtree", "block"), [(8192, 32768), (64, 100), (1, 40)])
def test_links_of_clusters(spark, subtree, block):
    """Dense clusters around a few centres, in one subtree or cut into blocks, with one to three matched segments."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = set()
    for i in range(900):
        value = int(centres[i % 6] if i % 3 else centres[0])
        for bit in rng.integers(0, 64, rng.integers(0, 9)):
            value ^= 1 << int(bit)
        values.add(value)
    values = np.array(sorted(values), np.uint64)
    signed = [(int(v),) for v in values.view(np.int64)]
    found = components(simhash.links(spark.createDataFrame(signed, "__fingerprint long"), subtree=subtree, block=block)).collect()
    root = {r.node: r.root for r in found}
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4):
            parent[find(i)] = find(i + 1 + int(j))
    got, want = {}, {}
    for i, (v,) in enumerate(signed):
        got.setdefault(root.get(v, v), set()).add(v)
        want.setdefault(find(i), set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}
    assert components(edges.limit(0)).count() == 0
