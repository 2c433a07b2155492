"""Removal of repeated byte strings by suffix order: multi-document Burrows-Wheeler construction, column by column.

A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller doc_id. The order of
all suffixes by their first LENGTH bytes decides that, and is built in pieces that fit a task:

1. Documents fall into parts by a hash of their id; a part is what a task holds. Content-defined chunks whose bytes (with the
   strings that start in them) also occur in a smaller document are settled at once: their strings are all repeats.
2. Any other string is named by two minimizers, the least hashes of a GRAM in it in two orders, so that no common gram gathers
   too much. Equal strings have equal minimizers. Parts tell which pairs they have, once each, and learn which ones a
   second document has too.
3. Runs of strings under one shared pair are the small documents whose suffixes are ordered, group by group: each round inserts one more symbol of every
   run, from its end, into the collection's Burrows-Wheeler transform and updates the longest common prefixes beside the
   new suffixes. Neighbours that share LENGTH bytes or more are equal strings, and the least doc_id goes to all of them.
   Columns are counted from the least gram of the strings, and a symbol is its column and byte: equal strings start in one
   column, a column's suffixes are a stretch of the transform of their own, and a round leaves the stretches before it alone.
4. Parts read those ids and cut their texts.

A round over whole documents would be a pass over all data for each byte of the longest one; runs are short, so the rounds are as few
as a string has columns on both sides of its gram, and the sequential files become a task's arrays. What a group or a part sends
is merged before it is shuffled, so a copy in a third of all documents is a row a part. Short texts are hashed many at a time.

Defined cases: a null text counts as empty; a text under LENGTH bytes is left as it is; a null doc_id counts as larger than all;
rows with the same doc_id are never a reason to cut one another; rows repeat as they come.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pavilion.llm.common import NULL_ID, SLICE, id_or_last

LENGTH, GRAM = 50, 16
# Average bytes of a chunk is about twice CHUNK, none is shorter than CHUNK (but for a text's last).
CHUNK = 128
# Bytes of text a part and a group stand for.
PART_BYTES, GROUP_BYTES = 2_000_000, 4_000_000
# Bytes whose hashes are worked out at a time, and strings of a run at most.
BLOCK, RUN = 1 << 17, 64
# Bytes of runs whose suffixes are ordered at a time; runs that could share a string stay together.
ORDERED = 500_000
# Runs whose strings are compared at a time.
SOME = 1 << 15
CHUNKS, SHARED, FIRSTS = 0, 1, 2  # kinds of what comes back to a part


# --- strings of a text


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of the GRAM bytes at each position."""
    n = len(raw) - GRAM + 1
    bytes_ = np.concatenate([raw, np.zeros(16, np.uint8)]).tobytes()
    words = np.empty(n + 8, np.uint64)  # of the 8 bytes at each position
    for first in range(8):
        own = words[first::8]
        own[:] = np.frombuffer(bytes_, "<u8", len(own), first)
    with np.errstate(over="ignore"):
        mixed = words[:n] * np.uint64(0x9E3779B97F4A7C15) + words[8 : n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    return mixed


class Hashed:
    """A text with its gram hashes block by block of strings; those of a text of one block are kept."""

    def __init__(self, raw: bytes):
        self.raw, self.array = raw, np.frombuffer(raw, np.uint8)
        self.strings = max(len(raw) - LENGTH + 1, 0)
        self.kept = gram_hashes(self.array) if 0 < self.strings <= BLOCK else None

    def __iter__(self):
        """(first string, strings, hashes of the grams in them) of each block."""
        for at in range(0, self.strings, BLOCK):
            n = min(BLOCK, self.strings - at)
            yield at, n, self.kept if self.kept is not None else gram_hashes(self.array[at : at + n + LENGTH - 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of width values from each position, by doubling."""
    done, span = values, 1
    while span * 2 <= width:
        done = np.minimum(done[:-span], done[span:])
        span *= 2
    rest = width - span
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def minimizers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the string that starts at each position the least gram hash, in two unrelated orders."""
    width = LENGTH - GRAM + 1
    with np.errstate(over="ignore"):
        other = (hashes ^ (hashes >> np.uint64(23))) * np.uint64(0xD6E8FEB86659FD93)
    return sliding_min(hashes, width), sliding_min(other, width)


class Batch:
    """Texts one after the other, hashed as one. No string of one runs into the next."""

    def __init__(self, docs: list[int], raws: list[bytes]):
        self.docs, self.text = np.array(docs, np.int64), Hashed(b"".join(raws))
        self.ends = np.cumsum([len(r) for r in raws])
        self.starts = np.r_[0, self.ends[:-1]]

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        """doc_id of the text at each place."""
        return self.docs[np.searchsorted(self.ends, places, side="right")]


def batches(docs, raws):
    """Batches of at most BLOCK bytes, or of one text. Where a text is cut into blocks does not depend on the texts around it."""
    some, size = [], 0
    for doc, raw in zip(docs, raws):
        if some and size + len(raw) > BLOCK:
            yield Batch(*zip(*some))
            some, size = [], 0
        some.append((doc, bytes(raw)))
        size += len(raw)
    if some:
        yield Batch(*zip(*some))


def chunks(batch: Batch) -> list[tuple[int, int, int, bytes]]:
    """(number of the text, first string, end of strings, digest of the bytes that these strings cover) of each chunk with a string.

    Chunks start where the bytes there say so.
    """
    raw, mark = batch.text.raw, np.uint64(CHUNK - 1) << np.uint64(40)
    places = np.concatenate([np.zeros(0, np.int64), *(np.flatnonzero((hashes[:n] & mark) == 0) + at for at, n, hashes in batch.text)])
    ends = batch.ends - LENGTH + 1
    low, high, places = np.searchsorted(places, batch.starts).tolist(), np.searchsorted(places, ends).tolist(), places.tolist()
    out = []
    for i, (last, end) in enumerate(zip(batch.starts.tolist(), ends.tolist())):
        if last >= end:
            continue
        for place in places[low[i] : high[i]]:
            if place - last >= CHUNK:
                out.append((i, last, place))
                last = place
        out.append((i, last, end))
    return [(i, a, b, hashlib.blake2b(raw[a : b + LENGTH - 1], digest_size=16).digest()) for i, a, b in out]


def runs(text: Hashed, open_strings: list[tuple[int, int]]):
    """(starts, ends, hash of both minimizers) of runs of strings, within the given ranges, under the same minimizers."""
    out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)]
    low, high = np.array(open_strings, np.int64).reshape(-1, 2).T
    for at, n, hashes in text if open_strings else ():
        # 0 outside the ranges, and inside each range a number of its own.
        here = np.flatnonzero((low < at + n) & (high > at))
        if not len(here):
            continue
        turns = np.zeros(n + 1, np.int64)
        np.add.at(turns, np.maximum(low[here] - at, 0), here + 1)
        np.subtract.at(turns, np.minimum(high[here] - at, n), here + 1)
        inside = np.cumsum(turns[:n])
        first, second = minimizers(hashes)
        edge = np.flatnonzero((first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (inside[1:] != inside[:-1])) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
        there = inside[starts] > 0
        starts, ends = starts[there], ends[there]
        pieces = -(-(ends - starts) // RUN)
        of = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cut = starts[of] + nth * RUN
        with np.errstate(over="ignore"):
            both = first[cut] ^ (second[cut] * np.uint64(0x9E3779B97F4A7C15))
        out.append((at + cut, at + np.minimum(cut + RUN, ends[of]), both >> np.uint64(1)))
    return tuple(np.concatenate(column) for column in zip(*out))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges with touching ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


# --- suffix order of a group


def suffix_groups(texts: list[bytes]):
    """(text, position, group) arrays of all suffixes of at least LENGTH bytes; equal first LENGTH bytes, equal group.

    Strings of a text with the same least gram, the first of equal ones, are a piece. Equal strings have it at the same distance, so columns are
    counted from there: a round inserts the symbols of one column, which take their places by counting within the order of the
    column after it. Symbols are the bytes' ranks among those that occur, from 1, and 0 stands for a piece's end.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(lengths)
    base = ends - lengths
    used = np.zeros(256, bool)
    used[flat] = True
    ranks = np.cumsum(used)[flat].astype(np.uint8 if used.sum() < 256 else np.uint16)
    # The place of each string's least gram, by the upper half of its hash.
    hashes = gram_hashes(flat)
    places = np.arange(len(hashes), dtype=np.uint64)
    anchors = (sliding_min(hashes >> np.uint64(32) << np.uint64(32) | places, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(flat) + 1, np.int8)
    inside[base] = 1
    inside[ends - LENGTH + 1] = -1
    inside = np.cumsum(inside[: len(anchors)], dtype=np.int8) > 0
    edge = np.r_[True, (anchors[1:] != anchors[:-1]) | (inside[1:] != inside[:-1]), True]
    bounds = np.flatnonzero(edge)
    pieces = np.flatnonzero(inside[bounds[:-1]])
    starts, stops = bounds[pieces], bounds[pieces + 1] + LENGTH - 1
    anchors = anchors[starts]
    low, high = starts - anchors, stops - anchors
    order, common = np.zeros(0, np.int64), np.zeros(0, np.uint8)  # of the column's suffixes; with the suffix before, LENGTH at most
    out, groups = [], 0
    for column in range(LENGTH - 1, GRAM - LENGTH - 1, -1):
        # The empty suffixes of pieces that end here stay in front.
        ending = np.flatnonzero(high == column + 1)
        order, common = np.concatenate([ending, order]), np.concatenate([np.zeros(len(ending), np.uint8), common])
        symbols = np.where(low <= column, ranks[np.maximum(anchors + column, 0) % len(ranks)], 0)[order]
        turn = np.argsort(symbols, kind="stable")
        # Whole pieces have no symbol before them; the others' symbols are followed by their suffixes, in this order.
        turn = turn[len(symbols) - np.count_nonzero(symbols) :]
        order, symbols = order[turn], symbols[turn]
        alike = np.flatnonzero(symbols[1:] == symbols[:-1])
        grown = np.zeros(len(order), np.uint8)
        grown[alike + 1] = _least_between(common, turn[alike], turn[alike + 1])
        common = grown
        if column <= 0:
            group = np.cumsum(common < LENGTH) + groups
            groups += len(order)
            whole = np.flatnonzero(high[order] - column >= LENGTH)
            out.append((order[whole], anchors[order[whole]] + column, group[whole]))
    piece, place, group = (np.concatenate(x) for x in zip(*out))
    text = np.searchsorted(ends, starts, side="right")[piece]
    return text, place - base[text], group


def _least_between(common, low, high):
    """One more than the least of common over (low, high], LENGTH at most."""
    if not len(low):
        return np.zeros(0, np.uint8)
    ranges = np.stack([low + 1, high + 1], axis=1).ravel()
    return np.minimum(np.minimum.reduceat(np.append(common, np.uint8(0)), ranges)[::2] + np.uint8(1), np.uint8(LENGTH))


# --- what parts and groups send each other


def _open_ranges(batch: Batch, settled: dict[bytes, int]):
    """(repeated, open) ranges of strings: those of chunks that a smaller document has, and the others."""
    repeated, unsettled, docs = [], [], batch.docs.tolist()
    for i, a, b, digest in chunks(batch):
        (repeated if settled.get(digest, NULL_ID) < docs[i] else unsettled).append((a, b))
    return joined(repeated), joined(unsettled)


def _codes(values: np.ndarray, groups: int):
    """Group of a pair of minimizers and the 32 bits that name it there."""
    return (values % np.uint64(groups)).astype(np.int64), ((values // np.uint64(groups)) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _settled(side: pd.DataFrame) -> dict[bytes, int]:
    rows = side[side["kind"] == CHUNKS]
    return dict(zip(map(bytes, rows["name"]), rows["doc"]))


def _shared(side: pd.DataFrame) -> np.ndarray:
    rows = side[side["kind"] == SHARED]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(d, np.int64) for d in rows["data"])]))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted known ones, none below 0. Only those whose low bits occur there are looked up."""
    there = np.zeros(len(values), bool)
    if len(known):
        low = (1 << min(max(8 * len(known), 1).bit_length(), 22)) - 1
        bits = np.zeros(low + 1, bool)
        bits[(known & known.dtype.type(low)).astype(np.int64)] = True
        maybe = np.flatnonzero(bits[(values & values.dtype.type(low)).astype(np.int64)])
        some = values[maybe]
        there[maybe[known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some]] = True
    return there


def _name(run: bytes) -> bytes:
    return hashlib.blake2b(run, digest_size=16).digest()


def _firsts(part, both, runs_, low, high, batch) -> list[tuple]:
    """For each part's run that a smaller document shares strings with: the least doc_id of each of its strings."""
    distinct: dict[bytes, int] = {}
    at = [distinct.setdefault(bytes(runs_[i]), len(distinct)) for i in batch]
    least = np.full(len(distinct), NULL_ID, np.int64)
    np.minimum.at(least, at, low[batch])
    names = list(distinct)
    text, place, group = suffix_groups(names)
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    first = np.minimum.reduceat(least[text], edge)[np.cumsum(np.r_[False, group[1:] != group[:-1]])]
    by_text = np.lexsort((place, text))
    text, first = text[by_text], first[by_text]
    bounds = np.searchsorted(text, np.arange(len(names) + 1))
    rows = []
    for i, which in zip(batch, at):
        own = first[bounds[which] : bounds[which + 1]]
        if own.min() < high[i]:
            rows.append((part[i], FIRSTS, _name(names[which]), both[i], own.tobytes()))
    return rows


def _smaller(batch: Batch, starts, ends, at, firsts) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of the strings of runs, in their order, whose least doc_id is smaller than their text's. That of a run's first string is firsts[at]."""
    out = [(np.zeros(0, np.int64),) * 2]
    for i in range(0, len(starts), SOME):
        first, n = starts[i : i + SOME], (ends - starts)[i : i + SOME]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        smaller = firsts[np.repeat(at[i : i + SOME], n) + nth] < np.repeat(batch.doc_at(first), n)
        hit = (np.repeat(first, n) + nth)[smaller]
        gap = np.flatnonzero(hit[1:] != hit[:-1] + 1)
        out.append((hit[np.r_[0, gap + 1][: len(hit)]], hit[np.r_[gap, len(hit) - 1][: len(hit)]] + 1))
    return tuple(np.concatenate(x) for x in zip(*out))


def cuts(batch: Batch, starts: np.ndarray, ends: np.ndarray):
    """(removed bytes, runs of them, what is left) of each text for ranges of repeated strings."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order] + LENGTH - 1)
    text = np.searchsorted(batch.ends, starts, side="right")
    new = np.flatnonzero(np.r_[True, (starts[1:] > reach[:-1]) | (text[1:] != text[:-1])][: len(starts)])
    starts, ends, text = starts[new], reach[np.r_[new[1:] - 1, len(reach) - 1][: len(new)]], text[new]
    removed, spans = np.zeros(len(batch.docs), np.int64), np.bincount(text, minlength=len(batch.docs))
    np.add.at(removed, text, ends - starts)
    raw, at, left = batch.text.raw, 0, []
    starts, ends = starts.tolist(), ends.tolist()
    for low, high, n in zip(batch.starts.tolist(), batch.ends.tolist(), spans.tolist()):
        edges = zip([low, *ends[at : at + n]], [*starts[at : at + n], high])
        left.append(b"".join([raw[a:b] for a, b in edges]))
        at += n
    return removed.tolist(), spans.tolist(), left


# doc is the least doc_id of CHUNKS, and the hash of both minimizers of FIRSTS. It has no nulls, which would make numbers of pandas inexact.
SIDE = "part int, kind int, name binary, doc long, data binary"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) of every row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, groups = size // PART_BYTES + 1, size // GROUP_BYTES + 1
    part_of = F.pmod(F.xxhash64("__id"), F.lit(parts)).cast("int")
    texts = docs.select(
        id_or_last().alias("__id"), F.col("doc_id").isNull().alias("null_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw")
    ).withColumn("part", part_of)

    # 1. Chunks that more than one document has.
    def cut_chunks(its):
        for rows in (whole.slice(at, SLICE) for whole in its for at in range(0, whole.num_rows, SLICE)):
            ids, part, raws = (c.to_pylist() for c in rows.columns)
            at = 0
            for batch in batches(ids, raws):
                names = [[] for _ in batch.docs]
                for i, _, _, digest in chunks(batch):
                    names[i].append(digest)
                to = at + len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[at:to], pa.int32()), pa.array(ids[at:to], pa.int64()), pa.array(map(b"".join, names), pa.binary())],
                    names=["part", "doc", "names"],
                )
                at = to

    cut = texts.select("__id", "part", "raw").mapInArrow(cut_chunks, "part int, doc long, names binary")
    positions = F.sequence(F.lit(0), (F.octet_length("names") / 16).cast("int") - 1)
    named = cut.filter(F.octet_length("names") > 0).select("part", "doc", "names", F.explode(positions).alias("i")).select(
        "part", "doc", F.substring(F.col("names"), F.col("i") * 16 + 1, F.lit(16)).alias("name")
    )
    ends = named.groupBy("part", "name").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    least = F.min("low").over(Window.partitionBy("name"))
    settled = ends.select("part", "name", "high", least.alias("doc")).filter("doc < high")
    chunk_side = settled.select("part", F.lit(CHUNKS).alias("kind"), "name", "doc", F.lit(None).cast("binary").alias("data"))

    # 2. Pairs of minimizers of the other strings that more than one document has. A document is in one part only, so what two
    # parts tell is in two documents; ids stay where they are.
    def tell(key, pdf, side):
        known, pairs, docs = _settled(side), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches(pdf["__id"], pdf["raw"]):
            starts, _, pair = runs(batch.text, _open_ranges(batch, known)[1])
            pairs.append(pair)
            docs.append(batch.doc_at(starts))
        pairs, docs = np.concatenate(pairs), np.concatenate(docs)
        pair = np.sort(pairs)
        again = np.unique(pair[1:][pair[1:] == pair[:-1]])
        some = np.flatnonzero(_among(pairs, again))
        order = some[np.lexsort((docs[some], pairs[some]))]
        several = pairs[order][1:][(pairs[order][1:] == pairs[order][:-1]) & (docs[order][1:] != docs[order][:-1])]
        pair = pair[np.r_[True, pair[1:] != pair[:-1]][: len(pair)]]
        group, code = _codes(pair, groups)
        # Those of several documents of the part come first.
        order = np.sort(group << 33 | ~_among(pair, np.unique(several)) * (1 << 32) | code)
        group, code, several = order >> 33, order.astype("<u4"), order >> 32 & 1 == 0
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else np.zeros(0, int)
        rows = [(int(group[a]), int(key[0]), code[a:b].tobytes(), int(several[a:b].sum())) for a, b in zip(edge[:-1], edge[1:])]
        return pd.DataFrame(rows, columns=["group", "part", "codes", "several"])

    part_texts = texts.groupBy("part")
    told = part_texts.cogroup(chunk_side.groupBy("part")).applyInPandas(tell, "group int, part int, codes binary, several int")

    def answer(key, pdf):
        codes = [np.frombuffer(c, "<u4") for c in pdf["codes"]]
        code = np.sort(np.concatenate(codes))
        again = code[1:][code[1:] == code[:-1]]
        shared = np.unique(np.concatenate([again, *(own[:n] for own, n in zip(codes, pdf["several"]))]))
        rows = []
        for part, own in zip(pdf["part"], codes):
            mine = own[_among(own, shared)].astype(np.int64) | (int(key[0]) << 32)
            if len(mine):
                rows.append((part, SHARED, None, 0, mine.tobytes()))
        return pd.DataFrame(rows, columns=["part", "kind", "name", "doc", "data"])

    shared_side = told.groupBy("group").applyInPandas(answer, SIDE)

    # 3. Runs of strings under shared pairs, each once a part, and the order of their suffixes.
    def send(key, pdf, side):
        known, shared = _settled(side), _shared(side)
        ids: dict[bytes, int] = {}
        at, docs, pairs = [], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for batch in batches(pdf["__id"], pdf["raw"]):
            raw = batch.text.raw
            starts, ends, both = runs(batch.text, _open_ranges(batch, known)[1])
            group, code = _codes(both, groups)
            there = np.flatnonzero(_among(group << 32 | code, shared))
            starts, ends, both = starts[there], ends[there], both[there]
            at += [ids.setdefault(raw[a:b], len(ids)) for a, b in zip(starts.tolist(), (ends + LENGTH - 1).tolist())]
            docs.append(batch.doc_at(starts))
            pairs.append(both)
        at, docs = np.array(at, np.int64), np.concatenate(docs)
        low, high, both = np.full(len(ids), NULL_ID), np.full(len(ids), -NULL_ID - 1), np.zeros(len(ids), np.int64)
        np.minimum.at(low, at, docs)
        np.maximum.at(high, at, docs)
        both[at] = np.concatenate(pairs)
        return pd.DataFrame({"group": both % groups, "both": both, "part": key[0], "run": list(ids), "low": low, "high": high})

    sent = part_texts.cogroup(chunk_side.union(shared_side).groupBy("part")).applyInPandas(
        send, "group int, both long, part int, run binary, low long, high long"
    )

    def order_suffixes(key, pdf):
        pdf = pdf.sort_values("both", kind="stable")
        both, runs_, low, high = (pdf[c].to_numpy() for c in ("both", "run", "low", "high"))
        edge = np.flatnonzero(np.r_[True, both[1:] != both[:-1], True])
        # Runs of one document alone share nothing with another.
        least, most = np.minimum.reduceat(low, edge[:-1]), np.maximum.reduceat(high, edge[:-1])
        part, rows, batch, size = pdf["part"].to_numpy(), [], [], 0
        for a, b, smallest in zip(*(x[least < most].tolist() for x in (edge[:-1], edge[1:], least))):
            if all(run == runs_[a] for run in runs_[a + 1 : b]):
                # One run in several documents: all its strings are the smallest one's.
                name, data = _name(bytes(runs_[a])), np.full(len(runs_[a]) - LENGTH + 1, smallest, np.int64).tobytes()
                rows += [(part[i], FIRSTS, name, both[a], data) for i in range(a, b) if smallest < high[i]]
                continue
            batch += range(a, b)
            size += sum(len(r) for r in runs_[a:b])
            if size > ORDERED:
                rows += _firsts(part, both, runs_, low, high, batch)
                batch, size = [], 0
        if batch:
            rows += _firsts(part, both, runs_, low, high, batch)
        return pd.DataFrame(rows, columns=["part", "kind", "name", "doc", "data"])

    firsts_side = sent.groupBy("group").applyInPandas(order_suffixes, SIDE)

    # 4. The cut.
    def cut_texts(key, pdf, side):
        known, told = _settled(side), side[side["kind"] == FIRSTS]
        answered = np.unique(told["doc"].to_numpy(np.int64))
        sizes = np.array([len(d) // 8 for d in told["data"]], np.int64)
        firsts = np.frombuffer(b"".join(told["data"]), np.int64)
        of_name = dict(zip(map(bytes, told["name"]), (np.cumsum(sizes) - sizes).tolist()))
        removed, spans, left = [], [], []
        for batch in batches(pdf["__id"], pdf["raw"]):
            raw = batch.text.raw
            repeated, unsettled = _open_ranges(batch, known)
            starts, ends, both = runs(batch.text, unsettled)
            there = np.flatnonzero(_among(both.astype(np.int64), answered))
            starts, ends = starts[there], ends[there]
            at = [of_name.get(_name(raw[a:b]), -1) for a, b in zip(starts.tolist(), (ends + LENGTH - 1).tolist())]
            at = np.array(at, np.int64)
            found = np.flatnonzero(at >= 0)
            low, high = _smaller(batch, starts[found], ends[found], at[found], firsts)
            a, b = np.array(repeated, np.int64).reshape(-1, 2).T
            for whole, some in zip((removed, spans, left), cuts(batch, np.concatenate([a, low]), np.concatenate([b, high]))):
                whole += some
        return pd.DataFrame({
            "doc_id": pdf["__id"].astype("Int64").mask(pdf["null_id"]).array, "n_bytes": [len(r) for r in pdf["raw"]], "n_removed": removed,
            "n_spans": spans, "kept": left,
        })

    return part_texts.cogroup(chunk_side.union(firsts_side).groupBy("part")).applyInPandas(
        cut_texts, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
