"""Every stage of the pipeline against brute force on its own input, and cases at the edges for all stages and operators."""

import corpus_pipeline
import pytest
from pavilion.llm import bpe, decontaminate, html_text, importance, line_dedup, quality_fm, quality_rules, sentence_pieces, sharding, simhash, suffix_dedup, url_filter
from test_bpe import PATH, PATTERN, reference
from test_decontaminate import brute as brute_windows
from test_jaccard import brute_kept
from test_line_dedup import brute as brute_lines
from test_sentence_pieces import PATH as PIECES

COLUMNS = ["doc_id", "lang", "n_chars", "source", "text"]


def rows_of(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "near-duplicates", "benchmark decontamination", "tokens"]
    given, outputs = docs, []
    for name, stage in corpus_pipeline.STAGES:
        got = corpus_pipeline.materialize(stage(spark, given, sf_dir), "stage")
        outputs.append((given, got))
        if name != "tokens":
            assert got.columns == docs.columns
        given = got
    before, after = outputs[0]
    scores = {r.doc_id: r.predicted for r in quality_fm.classify(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert rows_of(after) == [r for r in rows_of(before) if scores[r[0]]] and 0 < after.count() < before.count()

    before, after = outputs[1]
    rows = before.collect()
    gone, want = brute_lines([(r.doc_id, r.text) for r in rows]), []
    for r in rows:
        dropped = set(gone[r.doc_id, r.text])
        text = "\n".join(line for i, line in enumerate(r.text.split("\n")) if i not in dropped)
        if text.strip() or not dropped:
            want.append((r.doc_id, r.lang, len(text) if dropped else r.n_chars, r.source, text))
    assert rows_of(after) == sorted(want, key=str) and any(gone.values())

    before, after = outputs[2]
    heads = set(brute_kept([(r.doc_id, r.text) for r in before.collect()]))
    assert rows_of(after) == [r for r in rows_of(before) if r[0] in heads]

    before, after = outputs[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {row[0] for row in brute_windows([(r.doc_id, r.text) for r in before.collect()], items) if row[-1]}
    assert rows_of(after) == [r for r in rows_of(before) if r[0] not in leaks]

    before, after = outputs[4]
    want = sorted((r.doc_id, *reference(r.text)) for r in before.collect())
    assert [(d, n, decoded) for d, n, _, decoded in want] == sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in after.collect())


EDGES = [
    (1, "One line of text that is long enough.\n" * 3 + "w " * 400, "en", "s", 900, "x"),
    (1, "One line of text that is long enough.\n" * 3 + "w " * 400, "en", "s", 900, "x"),
    (None, None, None, None, None, None), (None, None, None, None, None, None), (2, "", "en", "s", 0, "x"), (2, "other text", None, "s", None, "x"),
    (3, "é🙂\x00 " * 30000, "de", None, 120000, None), (4, "a" * 70000, "fr", "s", 70000, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, all at once.
CLASHING = (
    "fingerprint words entry entries part hash lid ids pos label node root u v lo hi n size prefix sketch hashes other leader component member line form "
    "stays place n_words score weight rank quality predicted kept key doc bucket shard value row item_id items grams left right middle"
).split()


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_edges_of_stages(spark, sf_dir, name):
    rows = [(*r[:5], *[r[5]] * len(CLASHING)) for r in EDGES]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in CLASHING))
    stage = dict(corpus_pipeline.STAGES)[name]
    for given in (docs, docs.limit(0)):
        got = stage(spark, given, sf_dir)
        if name != "tokens":
            assert got.columns == docs.columns
        n = got.count()
        assert n <= given.count() and (name != "tokens" or n == given.count())


def test_edges_of_operators(spark):
    docs = spark.createDataFrame([(*r[:5], *[r[5]] * len(CLASHING)) for r in EDGES], SCHEMA + "".join(f", `{c}` string" for c in CLASHING))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, None), (1, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, None), (1, ""), (None, "w w")], "item_id long, text string")
    over_docs = {
        "simhash": simhash.near_duplicates, "lines": line_dedup.report, "suffixes": suffix_dedup.report, "shards": sharding.shard,
        "tokens": lambda d: bpe.digests(d, PATH, PATTERN), "rules": lambda d: quality_rules.judge(d, labels),
        "windows": lambda d: decontaminate.judge(d, items), "classifier": lambda d: quality_fm.classify(d, labels),
        "pieces": lambda d: sentence_pieces.digests(d, PIECES), "draw": lambda d: importance.resample(d, items),
    }
    for name, operator in over_docs.items():
        assert len(operator(docs).collect()) == len(EDGES), name
        assert operator(docs.limit(0)).collect() == [], name
    pages = spark.createDataFrame([(None, None, None, 1), (None, None, None, 1)], "page_id long, url string, html string, host int")
    for operator in (url_filter.judge, html_text.extract):
        assert len(operator(pages).collect()) == 2 and operator(pages.limit(0)).collect() == []


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and got.count() > 0
