import collections
import random

import pytest
import xxhash
from pavilion.llm import line_dedup
from pyspark.sql import functions as F

LAST = (1 << 63) - 1


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :]


def brute(rows):
    """{(doc_id, text): positions of dropped lines}, all pairs of lines compared."""

    def key(doc, text):
        hashed = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
        return LAST if doc is None else doc, hashed - (1 << 64) if hashed >> 63 else hashed

    places = collections.defaultdict(set)
    for doc, text in rows:
        for position, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" "):
                places[line.strip(" ")].add((*key(doc, text), position))
    forms = sorted(places, key=len)
    parent = {f: f for f in forms}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(forms):
        for b in forms[i + 1 :] if len(a) >= line_dedup.MIN_CHARS else []:
            if len(b) > len(a) + 1:
                break
            if apart_by_one(a, b):
                parent[find(a)] = find(b)
    classes = collections.defaultdict(set)
    for form in forms:
        classes[find(form)] |= places[form]
    gone = collections.defaultdict(set)
    for members in classes.values():
        for place in members - {min(members)}:
            gone[place[:2]].add(place[2])
    return {(d, t): sorted(gone[key(d, t)]) for d, t in rows}


def made_rows():
    rng = random.Random(5)
    base = ["the quick brown fox jumps over it", "lorem ipsum dolor sit amet", "short line", "twenty characters ab", "a" * 31, "b" * 32, "é" * 64]

    def changed(line, n):
        line = list(line)
        for _ in range(n):
            at = rng.randrange(len(line))
            line[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "é"])
        return "".join(line)

    rows = [(i % 90 if i % 25 else None, "\n".join(changed(rng.choice(base), rng.choice([0, 0, 1, 1, 2])) + " " * (i % 2) for _ in range(rng.randrange(1, 4)))) for i in range(120)]
    rows += [(i + 500, f"counter value {i:03d} of the report") for i in range(60)]
    return rows + rows[:9] + [(7, None), (7, ""), (8, "\n\n"), (8, "x\n" * 9)]


@pytest.mark.parametrize("small", [16, 2])
def test_against_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rows = made_rows()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lid string").repartition(3)
    want = brute(rows)
    got = line_dedup.report(docs).collect()
    expected = [(d, len(t.split("\n")) if t is not None else 0, tuple(want[d, t])) for d, t in rows]
    assert collections.Counter((r.doc_id, r.n_lines, tuple(r.dropped)) for r in got) == collections.Counter(expected)
    assert all(r.n_dropped == len(r.dropped) == len(r.classes) for r in got)


def test_the_text_follows(spark):
    line, near = "one line that is long enough", "one line that is long enougH"
    rows = [(1, f"{line}\nmine", 33, "z"), (2, f"{near}\nother\n {line} ", 60, None), (3, line, 28, "z"), (4, None, None, "z"), (5, "", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, pos string")
    got = line_dedup.drop_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, f"{line}\nmine", 33, "z"), (2, "other", 5, None), (4, None, None, "z"), (5, "", 0, "z")]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(700):
        a = [rng.choice("abé") for _ in range(rng.randrange(14))]
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "b🙂"])
        rows.append(("".join(a), "".join(b)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    wrong = line_dedup.within(F.col("a"), F.col("b"), edits) != (F.levenshtein("a", "b") <= edits)
    assert pairs.filter(F.coalesce(wrong, F.lit(True))).count() == 0


def test_an_exact_copy_leaves_no_stub(spark):
    text = "A title\nLes.\nsome line that is long enough\n\n  x"
    rows = [(1, text), (2, text), (3, "Les.\nown words of this document\nx"), (4, "\n \n"), (5, "Les?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, line_dedup.drop_repeats(docs).collect()))
    # White space alone is no content, but nothing was taken from it.
    assert got == {1: text, 3: "own words of this document", 4: "\n \n", 5: "Les?"}
