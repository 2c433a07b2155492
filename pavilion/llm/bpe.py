"""Byte-level BPE: pre-tokenise overlapping chunks, stitch them where their boundaries meet, encode the pieces.

A pattern without look-behind splits the rest of a text alike from any true boundary on. So two chunks that
share a boundary in their overlap agree from there on, whatever the later one made of its first characters.
Chunks that share none (a run without any boundary) stay one piece, however long: no text is cut by force.

Defined cases: a null text counts as empty and has no ids; rows repeat as they come; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import Remembered, map_rows, spread

CHUNK_CHARS = 65536
OVERLAP_CHARS = 4096
# A match that ends this near to a window's end might go on in the text; the pattern looks no further ahead.
LOOKAHEAD = 8
# Pieces whose ids a task remembers.
REMEMBERED = 300_000
# Longer pieces are merged with a heap instead of a list.
SHORT_PIECE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    pair_ranks = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair_ranks:
        lowest = min(pair_ranks)
        if lowest == none:
            break
        i = pair_ranks.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair_ranks[i]
        if i:
            pair_ranks[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pair_ranks):
            pair_ranks[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges off a heap, in n log n, for runs of any length."""
    n = len(piece)
    parts = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i):
        j = after[i]
        if j < n and (rank := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (rank, i, len(parts[i]) + len(parts[j])))

    for i in range(n):
        offer(i)
    while heap:
        rank, i, length = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= n or len(parts[i]) + len(parts[j]) != length or ranks.get(parts[i] + parts[j]) != rank:
            continue
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[part] for part in parts if part is not None]


def merged(piece: str, ranks: dict[bytes, int]) -> bytes:
    """Ids of a piece as little-endian unsigned 32-bit integers."""
    raw = piece.encode()
    whole = ranks.get(raw)
    ids = [whole] if whole is not None else (merge_short if len(raw) < SHORT_PIECE else merge_long)(raw, ranks)
    return np.array(ids, "<u4").tobytes()


class Encoder(Remembered):
    """Ids of pieces; all but very long ones are remembered, up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(lambda piece: merged(piece, ranks), REMEMBERED)

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) < SHORT_PIECE else self.make(piece)


def pieces_until(pattern, text: str, end: int) -> list[str]:
    """The matches that start before end; the text beyond is only looked at."""
    if end >= len(text):
        return pattern.findall(text)
    out = []
    for match in pattern.finditer(text):
        if match.start() >= end:
            break
        out.append(match.group())
    return out


def zone_boundaries(pattern, text: str, first: int, last: int) -> list[int]:
    """Where trusted matches of a window start within [first, last)."""
    trusted = len(text) - LOOKAHEAD
    return [m.start() for m in pattern.finditer(text) if first <= m.start() < last and m.start() <= trusted]


def _windows(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of texts longer than one chunk."""
    n = F.ceil(F.length("__text") / F.lit(chunk)).cast("int")
    starts = docs.select("__id", "__key", "__text", F.explode(F.sequence(F.lit(0), n - 1)).alias("__chunk"))
    return starts.select(
        "__id", "__key", "__chunk",
        F.substring(F.col("__text"), F.col("__chunk") * chunk + 1, F.lit(chunk + overlap)).alias("__window"),
    )


def _cuts(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Per long text the places where neighbouring chunks resynchronise, in order."""

    def factory():
        import regex

        split = regex.compile(pattern)

        def boundaries(doc_id, key, number, window):
            head = zone_boundaries(split, window[: overlap + LOOKAHEAD], 0, overlap - LOOKAHEAD) if number else []
            tail = zone_boundaries(split, window, chunk, chunk + overlap - LOOKAHEAD)
            start = number * chunk
            return doc_id, key, number, [start + b for b in head], [start + b for b in tail]

        return boundaries

    windows = spread(_windows(docs, chunk, overlap), "__id", "__key", "__chunk")
    zones = map_rows(
        windows, factory, "__id long, __key long, __chunk int, __head array<long>, __tail array<long>"
    )
    both = zones.select("__id", "__key", "__chunk", F.col("__tail").alias("__other"), F.lit(True).alias("__is_tail")).union(
        zones.select("__id", "__key", F.col("__chunk") - 1, "__head", F.lit(False))
    )
    # An overlap's two lists of boundaries meet in one row.
    meet = both.groupBy("__id", "__key", "__chunk").agg(
        F.max(F.when(F.col("__is_tail"), F.col("__other"))).alias("__tail"),
        F.max(F.when(~F.col("__is_tail"), F.col("__other"))).alias("__head"),
    )
    cut = F.array_min(F.array_intersect("__tail", "__head"))
    cuts = meet.select("__id", "__key", cut.alias("__cut")).filter("__cut is not null")
    return cuts.groupBy("__id", "__key").agg(F.array_sort(F.collect_set("__cut")).alias("__cuts"))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, chunk=CHUNK_CHARS, overlap=OVERLAP_CHARS, decoded=False
) -> DataFrame:
    """doc_id, n_tokens, ids of every text: each match of the pattern merged by the ranks, no special tokens.
    With decoded, also the bytes that the ids stand for, decoded where they were made.

    ids are little-endian unsigned 32-bit integers in one binary. Texts of one chunk are encoded where they are
    read; only longer ones are dealt out by chunk, and their pieces concatenated in order.
    """
    if chunk <= overlap or overlap <= 2 * LOOKAHEAD:
        raise ValueError("a chunk must be longer than its overlap, an overlap longer than twice the look-ahead")
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def factory():
        import regex

        split, ids_of = regex.compile(pattern), Encoder(ranks.value)
        raw = tokens_by_id(ranks.value) if decoded else None

        def encode_piece(doc_id, key, number, text, end):
            ids = b"".join([ids_of[p] for p in pieces_until(split, text, end)])
            return doc_id, key, number, ids, decode_ids(ids, raw) if decoded else None

        return encode_piece

    schema = "__id long, __key long, __piece int, __ids binary, __decoded binary"
    rows = docs.select(F.col("doc_id").alias("__id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    short = rows.filter(F.length("__text") <= chunk).select(
        "__id", F.lit(0).cast("long").alias("__key"), F.lit(0).alias("__piece"), "__text", F.length("__text").alias("__end")
    )
    whole = map_rows(short, factory, schema).select("__id", "__ids", "__decoded")

    # Equal rows are encoded once and repeated at the end, as pieces are put together by id and text.
    long = rows.filter(F.length("__text") > chunk).groupBy("__id", "__text").agg(F.count(F.lit(1)).alias("__n"))
    long = long.withColumn("__key", F.xxhash64("__text"))
    cuts = _cuts(long, pattern, chunk, overlap)
    edges = F.concat(
        F.array(F.lit(0).cast("long")), F.coalesce("__cuts", F.array().cast("array<long>")),
        F.array(F.length("__text").cast("long")),
    )
    joined = long.alias("l").join(
        cuts.alias("c"), F.expr("l.__id <=> c.__id and l.__key = c.__key"), "left"
    ).select("l.__id", "l.__key", "l.__text", "l.__n", edges.alias("__edges"))
    spans = joined.select("*", F.explode(F.sequence(F.lit(0), F.size("__edges") - 2)).alias("__piece")).select(
        "__id", "__key", "__piece", "__n", "__text",
        F.get("__edges", F.col("__piece")).alias("__from"), F.get("__edges", F.col("__piece") + 1).alias("__to"),
    )
    pieces = spans.select(
        "__id", "__key", "__piece",
        F.substring("__text", (F.col("__from") + 1).cast("int"), (F.col("__to") - F.col("__from") + LOOKAHEAD).cast("int")).alias("__text"),
        (F.col("__to") - F.col("__from")).cast("int").alias("__end"),
    )
    encoded = map_rows(spread(pieces, "__id", "__key", "__piece"), factory, schema)
    put = encoded.groupBy("__id", "__key").agg(F.array_sort(F.collect_list(F.struct("__piece", "__ids", "__decoded"))).alias("__parts"))
    copies = long.select("__id", "__key", "__n").alias("l")
    stitched = put.alias("p").join(copies, F.expr("l.__id <=> p.__id and l.__key = p.__key")).select(
        "p.__id", _concatenated("__ids"), _concatenated("__decoded"),
        F.explode(F.sequence(F.lit(1).cast("long"), "__n")),
    ).select("__id", "__ids", "__decoded")
    both = whole.unionByName(stitched)
    columns = [
        F.col("__id").alias("doc_id"),
        F.floor(F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
        F.col("__ids").alias("ids"),
    ]
    return both.select(*columns, *[F.col("__decoded").alias("decoded")] * decoded)


def _concatenated(column: str):
    return F.unhex(F.expr(f"array_join(transform(__parts, x -> hex(x.{column})), '')")).alias(column)


def tokens_by_id(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks.items()}


def decode_ids(ids: bytes, raw: dict[int, bytes]) -> bytes:
    return b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()])


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded, the raw bytes of the ids one after the other."""
    tokens = encoded.sparkSession.sparkContext.broadcast(tokens_by_id(read_ranks(ranks_path)))

    def factory():
        return lambda doc_id, n_tokens, ids: (doc_id, n_tokens, ids, decode_ids(ids, tokens.value))

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return map_rows(rows, factory, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, **chunks) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""
    return encode(docs, ranks_path, pattern, **chunks, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
