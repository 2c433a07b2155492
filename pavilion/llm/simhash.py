"""SimHash near-duplicates: fingerprints linked by a self-join of binary tries.

Fingerprints of a budget of k differing bits agree on at least m of k + m segments of their bits. For every choice of
m segments the bits are reordered so that these come first: the subtrees of a binary trie below each value of
them hold all pairs. A subtree is joined with itself from its root: pairs of nodes go down together, their differing
bits are added up, and a pair whose sum exceeds the budget is dropped with everything below. Subtrees are dealt out by
prefix; one that holds too many fingerprints is cut into blocks, and each pair of blocks is a task. Tasks
return spanning links, never all pairs of a group.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; a text of fewer words than a
shingle is one shingle; repeated shingles count as often as they occur; rows repeat as they come; null doc_ids never name a component
unless it has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import id_or_last, map_rows, text_key
from pavilion.llm.components import components
from pavilion.session import materialize

BITS = 64
SHINGLE = 4
BUDGET = 4
SEED = 42
# Fingerprints that a task should hold about, and at most, before its subtree is cut into blocks.
SUBTREE, BLOCK = 8192, 32768
# Node pairs that go down at a time, and pairs of fingerprints below which they are compared.
FRONTIER, LEAF = 200_000, 32
# Shingles whose bits are summed at a time.
SUMMED = 65536


def fingerprint(text: str | None, shingle=SHINGLE) -> int:
    """A bit is 1 if set in over half the shingles' hashes; signed, as Spark's longs are."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        parts = [joined]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        parts = map(joined.__getitem__, map(slice, (ends - lengths)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()))
    counts, total, rows = np.zeros(BITS, np.int64), max(n - shingle + 1, 1), b"".join([xxh64_digest(p, SEED) for p in parts])
    octets = np.frombuffer(rows, np.uint8).reshape(-1, 8)
    for start in range(0, total, SUMMED):
        counts += np.unpackbits(octets[start : start + SUMMED], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle=SHINGLE, keys=("doc_id",)) -> DataFrame:
    """The key columns and __fingerprint, in one pass over the texts."""

    def factory():
        return lambda text, *key: (*key, fingerprint(text, shingle))

    schema = ", ".join(f"`{k}` long" for k in keys) + ", __fingerprint long"
    return map_rows(docs.select("text", *keys), factory, schema)


# --- the join of one task's subtrees


class Links:
    """Sets that grow together; the root of a set is its least member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at):
        at = self.parent[at]
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = up

    def unite(self, a, b):
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def join_trie(values: np.ndarray, shared: int, budget: int = BUDGET) -> np.ndarray:
    """Roots of the sets of sorted distinct 64-bit values linked at budget or fewer differing bits, below each
    prefix of shared bits."""
    links = Links(len(values))
    prefix = values >> np.uint64(BITS - shared)
    starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    ends = np.r_[starts[1:], len(values)]
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    stack = [(shared, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    while stack:
        depth, al, ah, bl, bh, bits = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack.append((depth, al[half:], ah[half:], bl[half:], bh[half:], bits[half:]))
            stack.append((depth, al[:half], ah[:half], bl[:half], bh[:half], bits[:half]))
            continue
        small = (ah - al) * (bh - bl) <= LEAF
        if small.any():
            _compare(values, al[small], ah[small], bl[small], bh[small], budget, links)
            al, ah, bl, bh, bits = al[~small], ah[~small], bl[~small], bh[~small], bits[~small]
        if len(al):
            stack.append((depth + 1, *_children(values, depth, al, ah, bl, bh, bits, budget)))
    return links.roots(np.arange(len(values)))


def _split(values, depth, low, high):
    """Where a node's values turn from bit 0 to bit 1 at this depth."""
    below = np.uint64(BITS - depth)
    first_one = (values[low] >> below << below) | np.uint64(1 << (BITS - 1 - depth))
    return np.clip(np.searchsorted(values, first_one), low, high)


def _children(values, depth, al, ah, bl, bh, bits, budget):
    am, bm = _split(values, depth, al, ah), _split(values, depth, bl, bh)
    own = al == bl
    pairs = [(al, am, bl, bm, bits), (am, ah, bm, bh, bits), (al, am, bm, bh, bits + 1)]
    other = ~own  # a node with itself meets its two halves once
    pairs.append((am[other], ah[other], bl[other], bm[other], bits[other] + 1))
    a0, a1, b0, b1, sums = (np.concatenate(c) for c in zip(*pairs))
    keep = (a1 > a0) & (b1 > b0) & (sums <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
    return a0[keep], a1[keep], b0[keep], b1[keep], sums[keep].astype(np.int8)


def _compare(values, al, ah, bl, bh, budget, links):
    """All pairs below small pairs of nodes, by exclusive or."""
    width = bh - bl
    counts = (ah - al) * width
    node = np.repeat(np.arange(len(al)), counts)
    inside = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
    a, b = al[node] + inside // width[node], bl[node] + inside % width[node]
    near = (a < b) & (np.bitwise_count(values[a] ^ values[b]) <= budget) if len(a) else np.zeros(0, bool)
    links.unite(a[near], b[near])


# --- the tasks


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of n segments."""
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _reordered(value, chosen, segments):
    """The value with the chosen segments' bits first."""
    order = [segments[i] for i in chosen] + [s for i, s in enumerate(segments) if i not in chosen]
    out, at = F.lit(0).cast("long"), 0
    for first, width in order:
        part = F.shiftrightunsigned(value, BITS - first - width).bitwiseAND(F.lit((1 << width) - 1))
        out = out.bitwiseOR(F.shiftleft(part, BITS - at - width))
        at += width
    return out


def links(distinct: DataFrame, budget=BUDGET, subtree=SUBTREE, block=BLOCK) -> DataFrame:
    """Links (u, v) that connect the distinct values of __fingerprint at budget or fewer differing bits."""
    n = distinct.count()
    matched = 1
    # More matched segments make longer prefixes in more orders: as long as one subtree would hold too many.
    while matched < 3 and n >> (BITS * matched // (budget + matched)) > subtree:
        matched += 1
    segments = _segments(budget + matched)
    orders = list(combinations(range(len(segments)), matched))
    shared = [sum(segments[i][1] for i in chosen) for chosen in orders]
    cell_bits = min(min(shared), max(n // subtree, 1).bit_length())
    value = F.col("__fingerprint")
    rows = distinct.select(
        value, F.posexplode(F.array(*[_reordered(value, chosen, segments) for chosen in orders])).alias("__order", "__value")
    ).withColumn("__cell", F.shiftrightunsigned("__value", BITS - cell_bits))
    # At most orders x 2 ** cell_bits rows, which is n / subtree x orders: one for thousands of fingerprints.
    sizes = rows.groupBy("__order", "__cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__blocks"))
    cut = sizes.filter("__blocks > 1")
    rows = rows.join(cut, ["__order", "__cell"], "left").fillna(1, ["__blocks"])
    mine = F.pmod(F.xxhash64("__fingerprint"), F.col("__blocks")).cast("int")
    tasks = rows.select(
        "__fingerprint", "__value", "__order", "__cell", mine.alias("__mine"),
        F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__other"),
    )
    shared_bits = {i: bits for i, bits in enumerate(shared)}

    def join(key, pdf):
        values = pdf["__value"].to_numpy().view(np.uint64)
        order = np.argsort(values)
        roots = join_trie(values[order], shared_bits[int(key[0])], budget)
        own = pdf["__fingerprint"].to_numpy()[order]
        linked = roots != np.arange(len(roots))
        return pd.DataFrame({"u": own[linked], "v": own[roots[linked]]})

    grouped = tasks.select(
        "__fingerprint", "__value", "__order", "__cell",
        F.least("__mine", "__other").alias("__a"), F.greatest("__mine", "__other").alias("__b"),
    ).groupBy("__order", "__cell", "__a", "__b")
    return grouped.applyInPandas(join, "u long, v long")


def classes(rows: DataFrame, budget=BUDGET) -> DataFrame:
    """(__fingerprint, __component) of rows with __id and __fingerprint: the least __id reachable over links."""
    distinct = materialize(rows.groupBy("__fingerprint").agg(F.min("__id").alias("__least")), "fingerprints")
    roots = components(links(distinct.select("__fingerprint"), budget))
    rooted = distinct.join(roots, distinct["__fingerprint"] == roots["node"], "left").select(
        "__fingerprint", "__least", F.coalesce("root", "__fingerprint").alias("__root")
    )
    least = rooted.groupBy("__root").agg(F.min("__least").alias("__component"))
    return rooted.join(least, "__root").select("__fingerprint", "__component")


def near_duplicates(docs: DataFrame, shingle=SHINGLE, budget=BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    rows = materialize(fingerprints(docs, shingle), "simhash").withColumnRenamed("doc_id", "__id")
    joined = rows.join(classes(rows, budget), "__fingerprint")
    return joined.select(
        F.col("__id").alias("doc_id"),
        F.lower(F.lpad(F.hex("__fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("__component").alias("component_id"),
    )


def grouped(docs: DataFrame, shingle=SHINGLE, budget=BUDGET) -> DataFrame:
    """__id, __key and __component, the least __id reachable over links, of every row."""
    keyed = docs.select(id_or_last().alias("__id"), text_key().alias("__key"), "text")
    rows = materialize(fingerprints(keyed, shingle, ("__id", "__key")), "simhash")
    # Written, as what is asked of the groups next would hold the plan that finds them several times.
    return materialize(rows.join(classes(rows, budget), "__fingerprint").select("__id", "__key", "__component"), "groups")


def keep_one(docs: DataFrame, shingle=SHINGLE, budget=BUDGET) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id, with its own columns.

    Of rows that share that doc_id the one with the least key of its text stays, and of equal rows one.
    """
    own = grouped(docs, shingle, budget).filter(F.col("__id") == F.col("__component"))
    chosen = own.groupBy("__component").agg(F.min("__key").alias("__kept")).select(F.col("__component").alias("__kept_id"), "__kept")
    kept = docs.withColumns({"__id": id_or_last(), "__key": text_key()}).join(
        chosen, (F.col("__id") == F.col("__kept_id")) & (F.col("__key") == F.col("__kept"))
    )
    return kept.dropDuplicates(["__id", "__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
