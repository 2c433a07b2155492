import hashlib
import random

import numpy as np
import pytest
from pavilion.llm import suffix_dedup


def brute(rows):
    first, last = {}, 1 << 63
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            window = raw[i : i + 50]
            first[window] = min(first.get(window, last + 1), last if doc is None else doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), np.int8)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < (last if doc is None else doc):
                gone[i : i + 50] = 1
        spans = int((np.diff(np.r_[0, gone]) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[gone == 0])
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_groups():
    rng = random.Random(2)
    for _ in range(40):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(50, 80))) for _ in range(rng.randrange(1, 6))]
        texts += [b"ab" * rng.randrange(25, 40), texts[0][:55] + b"zz", b"q" + texts[0], b"\x00" * 60]
        text, place, group = suffix_dedup.suffix_groups(texts)
        assert len(text) == sum(len(t) - 49 for t in texts)
        seen = {}
        for t, p, g in zip(text, place, group):
            assert seen.setdefault(int(g), texts[t][p : p + 50]) == texts[t][p : p + 50]
        assert len(set(seen.values())) == len(seen)


@pytest.fixture(autouse=True)
def several_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 30_000)


def test_small_cases(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abc de") for _ in range(300))
    rows = []
    for i in range(120):
        text = "".join(rng.choice("abé de") for _ in range(rng.randrange(300)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(250)
            text = text[: rng.randrange(len(text) + 1)] + passage[at : at + rng.randrange(30, 300)] + text
        rows.append((i if i % 37 else None, text))
    rows += [(500, None), (501, ""), (3, rows[3][1]), (3, rows[3][1]), (502, rows[5][1]), (503, "ab" * 400), (504, "x" + "ab" * 300)]
    rows += [(505, "a" * 49), (506, "a" * 49), (507, "a" * 50), (508, "a" * 50), (509, "a" * 1000), (510, "Aich " * 300), (511, "Aich " * 200)]
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, part string").repartition(4)
    assert sorted(map(tuple, suffix_dedup.report(docs).collect()), key=str) == brute(rows)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, suffix_dedup.report(docs).collect()), key=str) == brute(rows)


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 70)
    rng = random.Random(4)
    raw = bytes(rng.choice(b"abcd") for _ in range(900))
    starts, ends, both = suffix_dedup.runs(suffix_dedup.Hashed(raw), [(0, 300), (310, 851)])
    first, second = suffix_dedup.minimizers(suffix_dedup.gram_hashes(np.frombuffer(raw, np.uint8)))
    whole = (first ^ (second * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(1)
    assert [v for s, e, f in zip(starts, ends, both) for v in [f] * (e - s)] == np.r_[whole[:300], whole[310:]].tolist()
    assert all(e <= 300 or s >= 310 for s, e in zip(starts, ends))


def test_ids_stay_in_their_part(spark):
    """What parts tell of pairs of minimizers has no ids: two parts never hold one document. Rows of one document are one."""
    rng = random.Random(6)
    passage, texts = "".join(rng.choice("abc de") for _ in range(200)), ["".join(rng.choice("fghij") for _ in range(400)) for _ in range(60)]
    rows = [(i, t[:200] + passage[i : i + 120] + t[200:]) for i, t in enumerate(texts)]
    rows += [(0, passage), (7, texts[0]), (None, texts[1]), (None, texts[1]), (90, texts[2][:150]), (90, texts[2][100:]), (90, "z" * 300)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert "codes#" in (plan := got._jdf.queryExecution().toString()) and "docs#" not in plan
    out = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()), key=str)
    assert out == brute(rows)


def test_a_round_orders_one_column(monkeypatch):
    """Each round takes the suffixes of its column only, not all that the rounds before inserted."""
    rng = random.Random(12)
    middle = bytes(rng.choice(b"abcdefgh") for _ in range(60))
    texts = [bytes(rng.choice(b"abcdefgh") for _ in range(rng.randrange(12))) + middle + bytes([i]) for i in range(200)]
    ordered, argsort = [], np.argsort
    monkeypatch.setattr(suffix_dedup.np, "argsort", lambda x, **how: ordered.append(len(x)) or argsort(x, **how))
    text, place, group = suffix_dedup.suffix_groups(texts)
    assert sum(ordered) < 5 * sum(map(len, texts))
    names = {}
    for t, p, g in zip(text, place, group):
        names.setdefault(texts[t][p : p + 50], set()).add(int(g))
    assert all(len(g) == 1 for g in names.values()) and len(set.union(*names.values())) == len(names)
    assert len(text) == sum(len(t) - 49 for t in texts)


def test_texts_around_do_not_matter(monkeypatch):
    """Runs and chunks of a text are the same alone and among others, also of one longer than a block."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2_000)
    rng = random.Random(13)
    raws = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 700, 49, 0, 50, 900, 5_000, 1, 300, 0)]
    raws.insert(3, raws[1])

    def found(batch):
        made = suffix_dedup.chunks(batch)
        columns = suffix_dedup.runs(batch.text, suffix_dedup.joined([(a, b) for _, a, b, _ in made]))
        out = [(int(batch.docs[i]), "chunk", a - int(batch.starts[i]), b - a, digest) for i, a, b, digest in made]
        for doc, a, b, both in zip(batch.doc_at(columns[0]).tolist(), *(c.tolist() for c in columns)):
            out.append((doc, "run", a - int(batch.starts[batch.docs == doc][0]), b - a, both))
        return out

    together = [x for batch in suffix_dedup.batches(range(len(raws)), raws) for x in found(batch)]
    alone = [x for i, raw in enumerate(raws) for batch in suffix_dedup.batches([i], [raw]) for x in found(batch)]
    assert sorted(together, key=str) == sorted(alone, key=str) and len(together) > 300
    assert [b.docs.tolist() for b in suffix_dedup.batches(range(len(raws)), raws)] == [[0, 1, 2, 3, 4, 5], [6], [7], [8, 9, 10]]


def test_large_ids(spark):
    """Neighbouring doc_ids that doubles cannot tell apart. Texts share whole chunks and shorter passages."""
    rng = random.Random(14)
    passages = ["".join(rng.choice("abc de") for _ in range(n)) for n in (1500, 1500, 90, 90)]
    rows = []
    for i in range(60):
        own = "".join(rng.choice("fghij") for _ in range(200))
        rows.append(((1 << 60) + i, own[:100] + passages[i % 4] + own[100:] + passages[i * 7 % 3]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.report(docs).collect()), key=str) == brute(rows)


def test_chunks_are_cut_once(spark):
    """Texts are chunked in one pass before they are shuffled, and what parts tell is answered once."""
    rng = random.Random(15)
    docs = spark.createDataFrame([(i, "".join(rng.choice("abc de") for _ in range(300))) for i in range(50)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("MapInArrow") == 1 and final.count("answer(") == 1


def test_cuts_of_a_batch(monkeypatch):
    """Spans of neighbouring texts stay two, touching ranges of a text are one, and a few runs at a time give the same."""
    monkeypatch.setattr(suffix_dedup, "SOME", 2)
    raws = [b"", b"a" * 120, b"b" * 100, b"", b"c" * 60, b"d" * 10, b"e" * 300]
    (batch,) = suffix_dedup.batches(range(10, 17), raws)
    # Strings of the last 60 bytes of text 1, the first 51 of text 2, none of the others but two ranges and a single string of the last.
    starts, ends = np.array([290, 120, 510, 60, 400]), np.array([301, 122, 511, 71, 402])
    removed, spans, left = suffix_dedup.cuts(batch, starts, ends)
    assert removed == [0, 60, 51, 0, 0, 0, 161] and spans == [0, 1, 1, 0, 0, 0, 3]
    assert left == [b"", b"a" * 60, b"b" * 49, b"", b"c" * 60, b"d" * 10, b"e" * 139]
    assert suffix_dedup.cuts(batch, starts[:0], ends[:0]) == ([0] * 7, [0] * 7, raws)
    firsts = np.array([9, 9, 11, 9, 12, 12, 3, 20, 3, 3, 3])
    low, high = suffix_dedup._smaller(batch, np.array([0, 3, 130, 300]), np.array([3, 5, 133, 303]), np.array([0, 3, 4, 8]), firsts)
    hit = [p for a, b in zip(low.tolist(), high.tolist()) for p in range(a, b)]
    assert hit == [0, 1, 3, 132, 300, 301, 302]
