"""The near-duplicate stage against exact Jaccard similarity of all pairs."""

import random

import corpus_pipeline
import pytest
from pavilion.llm import jaccard, simhash


def brute_kept(rows):
    """Positions of rows that stay: the least (doc_id, position of the text) of every group linked at similarity 0.8 or more."""

    def shingles(text):
        words = (text or "").encode().lower().split()
        return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(least.values())


def made_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=30)
    rows = []
    for size in (12, 40, 60, 200):
        for _ in range(6):
            base = rng.choices(words, k=size)
            rows.append(base)
            for _ in range(6):  # a few words replaced
                copy = list(base)
                for _ in range(rng.randrange(1, 2 + size // 40)):
                    copy[rng.randrange(size)] = rng.choice(words)
                rows.append(copy)
    rows += [passage + rng.choices(words, k=rng.randrange(1, 40)) for _ in range(60)]
    rng.shuffle(rows)
    texts = [" ".join(r) for r in rows] + [None, "", " \n", "One", "one", "a b c d e", "A b\nc d  e", "a b c d f"]
    return list(enumerate(texts))


@pytest.mark.parametrize(("small", "block"), [(16, 1024), (2, 20)])
def test_all_pairs(spark, small, block):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(3)
    got = jaccard.keep_one(docs, small, block)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows)


def test_stage_links_a_few_replaced_words(spark, sf_dir):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows)


def test_stage_judges_the_groups_of_simhash_first(spark, sf_dir, monkeypatch):
    """Two copies but for one word, and texts that repeat one passage: fingerprints count repeats, sets of shingles do not."""
    rng = random.Random(5)
    passage, words = " ".join(f"p{i}" for i in range(40)) + " ", [f"w{i}" for i in range(2000)]
    rows = [(i, passage * 40 + " ".join(f"own{rng.random()}" for _ in range(30))) for i in range(3)]
    rows += [(8, " ".join(words)), (9, " ".join([*words[:-1], "other"])), (10, "a text that is like none of the others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {r["__id"]: r["__component"] for r in simhash.grouped(docs).collect()}
    assert groups == {0: 0, 1: 0, 2: 0, 8: 8, 9: 8, 10: 10}
    judged, linked = [], jaccard._linked

    def watched(docs, rows, found):
        links = linked(docs, rows, found)
        judged.append((found.count(), links.count()))
        return links

    monkeypatch.setattr(jaccard, "_linked", watched)
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows) == [0, 1, 2, 8, 10]
    # Three pairs of two groups are judged, one of them is similar, and nothing is left of it for the join.
    assert judged[0] == (3, 1) and all(n == 0 for _, n in judged[1:])


def test_rows_that_share_a_doc_id(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "u v w x y z"), (None, "one two"), (2, "A B C D E F"), (None, None)]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a b c d e f"), (1, "u v w x y z"), (None, "one two"), (None, None)], key=str)


def test_no_step_without_pairs(spark, monkeypatch):
    """What has nothing to judge or to join is not run: no shingles without a pair, no components without a new link."""
    written, asked, write, join = [], [], jaccard.materialize, jaccard.components
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: written.append(name) or write(df, name))
    monkeypatch.setattr(jaccard, "components", lambda edges: asked.append({tuple(r) for r in edges.collect()}) or join(edges))
    apart = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(5)]
    docs = spark.createDataFrame(apart, "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard.keep_one(docs, known=simhash.grouped(docs)).collect()) == [0, 1, 2, 3, 4]
    assert "shingles" not in written and not asked and written.count("members") == 1

    # Near copies that the known groups link; the join finds one more, and follows it from the groups' roots.
    base = [f"w{j}" for j in range(60)]
    near = [(10, " ".join(base)), (11, " ".join(base[:59] + ["x"])), (12, " ".join(base[:58] + ["y", "z"]))]
    docs = spark.createDataFrame(apart + near, "doc_id long, text string")
    keyed = docs.select(jaccard.id_or_last().alias("__id"), jaccard.text_key().alias("__key"))
    known = keyed.filter("__id in (10, 11)").selectExpr("__id", "__key", "10L as __component")
    assert sorted(r.doc_id for r in jaccard.keep_one(docs, known=known).collect()) == [0, 1, 2, 3, 4, 10]
    assert len(asked) == 2 and len(asked[0]) == 1 and asked[0] < asked[1] | {(v, u) for u, v in asked[1]} and len(asked[1]) == 2


@pytest.mark.parametrize(("small", "block"), [(16, 1024), (2, 20)])
def test_known_groups_leave_no_pair_out(spark, small, block):
    """All texts in one known group, most of whose pairs are none of its least node, and texts dealt to groups that mean nothing."""
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = docs.select(jaccard.id_or_last().alias("__id"), jaccard.text_key().alias("__key"))
    for group in ("0L", "__id % 7"):
        known = keyed.selectExpr("__id", "__key", f"{group} as __component")
        assert sorted(r.doc_id for r in jaccard.keep_one(docs, small, block, known).collect()) == brute_kept(rows)
