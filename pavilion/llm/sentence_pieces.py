"""Encoding and decoding with a sentence-piece BPE model by a table of prefixes.

The encoding of a prefix is the encoding of a shorter prefix plus one last token, and a row of tokens is an encoding exactly if
each two neighbours are one. So a table holds the unique last token of every prefix: the pieces that end at a place come from
an automaton over the vocabulary, and the one among them is taken that its predecessor, the last token of the prefix before it,
may stand beside. Ids are then read off the table backwards. The work is linear in the text, however long a run without
spaces is.

Two tokens may stand beside each other if merging their characters never joins a symbol of one to a symbol of the other. That is
found by running both tokens' own merges against each other, the best score first, the leftmost of equal ones.

A text is cut before each run of space marks (if no piece has a mark behind another character, as is tested on the model) and
between characters that no piece has side by side: no piece spans such a cut, so the parts are encoded apart, and a part that
comes again is remembered.

Defined cases: a null text counts as empty and has no ids, as an empty one; rows repeat as they come; other columns are not
read. Models that are not BPE with byte fallback, or normalise more than spaces, are refused.
"""

from __future__ import annotations

import codecs
import gc
import re
import struct
from array import array

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import Remembered, map_rows

MARK = "▁"  # stands for a space
UNKNOWN_SURFACE = " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2  # fixed values of the model format
NEVER = float("-inf")
# Parts, and pairs of tokens, that a task remembers; longer parts are encoded anew.
PARTS, PAIRS, LONGEST_PART = 250_000, 400_000, 48


def _fields(raw: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Model:
    """Pieces with scores, and the settings that matter, of a model file's bytes."""

    def __init__(self, raw: bytes):
        self.pieces, scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24) or not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback, without special kinds of pieces")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that leave a text as it is but for its spaces")
        self.prefix = MARK if normalizer.get(3, 1) else ""
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        self.scores = {self.pieces[i]: scores[i] for i in normal}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}


def cuts(longer: list[str]) -> re.Pattern:
    """The parts of a text that no piece of more than one character goes beyond.

    Characters that stand side by side in a piece are of one kind, and so are those that they lead to. A part is a run of
    characters of one kind with the marks before it; characters in no longer piece are parts of their own.
    """
    if any(MARK in p.lstrip(MARK) for p in longer):
        return re.compile("(?s).+")
    kind: dict[str, str] = {}

    def of(c):
        while kind.setdefault(c, c) != c:
            kind[c] = c = kind[kind[c]]
        return c

    for piece in longer:
        rest = piece.lstrip(MARK)
        for a, b in zip(rest, rest[1:]):
            kind[of(a)] = of(b)
    runs: dict[str, list] = {}
    for c in sorted(kind):
        runs.setdefault(of(c), []).append(re.escape(c))
    either = "|".join(f"[{''.join(run)}]+" for run in sorted(runs.values(), key=len, reverse=True))
    return re.compile(f"(?s){MARK}*(?:{either}|[^{MARK}])|{MARK}+" if either else f"(?s){MARK}*[^{MARK}]|{MARK}+")


class Fits(dict):
    """Whether a token may stand behind a given one, for each that was asked about."""

    def __init__(self, token: str, pairs: "Pairs"):
        super().__init__()
        self.token, self.pairs = token, pairs

    def __missing__(self, before: str) -> bool:
        fits = self.pairs.beside(before, self.token)
        self.pairs.remember(self)
        self[before] = fits
        return fits


class Pairs:
    """Which tokens may stand beside each other.

    Apart from the automaton, whose values lead here: garbage collection cannot see through it, so nothing may lead back.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.traces: dict[str, list | None] = {}
        self.asked: list[Fits] = []

    def trace(self, token: str):
        """The merges that make a token of its characters: (score, first symbol, last symbol after it), or None if they end elsewhere."""
        if token not in self.traces:
            scores, symbols, steps = self.scores, list(token), []
            while len(symbols) > 1:
                found = [scores.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
                best = max(found)
                if best == NEVER:
                    break
                at = found.index(best)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                steps.append((best, symbols[0], symbols[-1]))
            self.traces[token] = steps if len(symbols) <= 1 else None
        return self.traces[token]

    def beside(self, left: str, right: str) -> bool:
        """Whether merging left + right ends with these two tokens; with nothing on the left, whether right is a token at all."""
        a, b, scores = self.trace(left), self.trace(right), self.scores
        if a is None or b is None or not left:
            return a is not None and b is not None
        i = j = 0
        end, start = left[-1], right[0]
        while True:
            across = scores.get(end + start, NEVER)
            next_a = a[i][0] if i < len(a) else NEVER
            next_b = b[j][0] if j < len(b) else NEVER
            if across > next_a and across >= next_b:
                return False
            if next_a >= next_b:
                if next_a == NEVER:
                    return True
                end = a[i][2]
                i += 1
            else:
                start = b[j][1]
                j += 1

    def remember(self, fits: Fits) -> None:
        if len(self.asked) >= PAIRS:
            for known in self.asked:
                known.clear()
            self.asked.clear()
        self.asked.append(fits)


class Encoder:
    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        pairs = Pairs(model.scores)
        self.automaton = ahocorasick.Automaton()
        for piece in model.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece, (piece, len(piece) - 1, Fits(piece, pairs)))
        self.automaton.make_automaton()
        self.parts = Remembered(self.encode_part, PARTS)
        self.spelt = Remembered(self.spell, len(model.pieces))
        self.cut = cuts([p for p in model.ids if len(p) > 1])

    def prefix_table(self, text: str) -> list:
        """The last token of the encoding of text[:i], for every i from 1 on."""
        # One character, unless a longer piece ends there that fits.
        last = ["", *text]
        for stop, (token, before, fits) in self.automaton.iter(text):
            if fits[last[stop - before]]:
                last[stop + 1] = token
        return last

    def encode_part(self, text: str) -> bytes:
        """Ids of a part as the bytes of an int array."""
        last, at, spelt, ids = self.prefix_table(text), len(text), self.spelt, []
        while at:
            token = last[at]
            ids.append(spelt[token])
            at -= len(token)
        ids.reverse()
        return b"".join(ids)

    def spell(self, token: str) -> bytes:
        """A token's own id, or those of its bytes."""
        one = self.model.ids.get(token)
        return array("i", [self.model.bytes[b] for b in token.encode()] if one is None else [one]).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        known, own = self.parts, self.encode_part
        parts = self.cut.findall(self.model.prefix + text.replace(" ", MARK))
        return b"".join([known[p] if len(p) <= LONGEST_PART else own(p) for p in parts])


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


class Decoder:
    def __init__(self, model: Model):
        codecs.register_error("each-byte", _each_byte)
        self.leading = bool(model.prefix)
        self.silent = {i for i, kind in enumerate(model.kinds) if kind == CONTROL}
        self.marked = {i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL and p.startswith(MARK)}
        surface = {UNKNOWN: lambda p: UNKNOWN_SURFACE.encode(), CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)])}
        plain = lambda p: p.replace(MARK, " ").encode()
        self.raw = [surface.get(kind, plain)(p) for p, kind in zip(model.pieces, model.kinds)]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.raw[i] for i in ids])
        if self.leading:
            first = next((i for i in ids if i not in self.silent), None)
            raw = raw[1:] if first in self.marked else raw
        return raw.decode("utf-8", errors="each-byte")


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded, the text that the ids stand for, of every row of docs(doc_id, text)."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def factory():
        gc.collect()  # an encoder holds itself, and this worker may have one of an earlier task
        read = Model(model.value)
        encoder, decoder = Encoder(read), Decoder(read)

        def row(doc_id, text):
            ids = np.frombuffer(encoder.encode(text or ""), np.int32)
            return doc_id, len(ids), ids, decoder.decode(ids.tolist())

        return row

    return map_rows(docs.select("doc_id", "text"), factory, "doc_id long, n_tokens long, ids array<int>, decoded string")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give an empty text."""
    with open(model_path, "rb") as file:
        model = encoded.sparkSession.sparkContext.broadcast(file.read())

    def factory():
        decoder = Decoder(Model(model.value))
        return lambda doc_id, ids: (doc_id, decoder.decode(ids or []))

    return map_rows(encoded.select("doc_id", "ids"), factory, "doc_id long, text string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode(docs, model_path).select(
        "doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
