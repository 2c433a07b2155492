import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pavilion.llm import sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = sentence_pieces.Model(open(PATH, "rb").read())
ROWS = [
    (1, "Hello, world! It's 2024, isn't it?\n\n  x"), (2, None), (3, ""), (4, "  \n\n  'll" * 400), (4, "  \n\n  'll" * 400),
    (4, "same id, other text"), (None, "é" * 2500 + " ñ 日本語 🙂🙂 ▁ literal"), (5, " " * 3000 + "a" * 4000 + "\t\t"), (6, "\x00\x01 <s></s><unk> <0x41>"),
]


def reference(text):
    ids = LIBRARY.encode(text or "")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


def test_ids_and_round_trip(spark):
    docs = spark.createDataFrame([(*r, "x", 7) for r in ROWS], "doc_id long, text string, ids string, decoded int")
    got = sorted(map(tuple, sentence_pieces.digests(docs, PATH).collect()), key=str)
    assert got == sorted([(i, *reference(t)) for i, t in ROWS], key=str)
    assert sentence_pieces.digests(docs.limit(0), PATH).collect() == []


def mixed(rng, n):
    parts = ["a", "b", "the", " ", "  ", "▁", "\n", "é", "日", "🙂", "ing", "\x00", "<s>", "aaaa", "\t", "er", "12", "    ", "привет", "...", "—"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(n)))


@pytest.mark.parametrize("bound", [400_000, 3])
def test_mixed_texts(monkeypatch, bound):
    """Also with a memory that is full all the time."""
    monkeypatch.setattr(sentence_pieces, "PARTS", bound)
    monkeypatch.setattr(sentence_pieces, "PAIRS", bound)
    encoder, rng = sentence_pieces.Encoder(MODEL), random.Random(1)
    for _ in range(1500):
        text = mixed(rng, 30)
        assert list(memoryview(encoder.encode(text)).cast("i")) == LIBRARY.encode(text)


def test_uncut_text_gives_the_same():
    """The table over a whole text, without cuts before it."""
    encoder, rng = sentence_pieces.Encoder(MODEL), random.Random(2)
    for _ in range(300):
        text = mixed(rng, 30).strip() or "x"
        whole = encoder.encode_part("▁" + text.replace(" ", "▁"))
        assert list(memoryview(whole).cast("i")) == LIBRARY.encode(text)


def test_decodes_any_ids():
    decoder, rng = sentence_pieces.Decoder(MODEL), random.Random(3)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(263), rng.randrange(259, 32000), 28705]) for _ in range(rng.randrange(8))]
        assert decoder.decode(ids) == LIBRARY.decode(ids)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, sentence_pieces.digests(docs, PATH).collect()))
    assert got == sorted((r.doc_id, *reference(r.text)) for r in docs.collect())


def test_stored_ids_decode(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = sentence_pieces.decode(sentence_pieces.encode(docs, PATH), PATH).collect()
    assert sorted(r.text for r in rows) == sorted(LIBRARY.decode(LIBRARY.encode(t or "")) for _, t in ROWS)
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert sentence_pieces.decode(none, PATH).first().text == ""


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.Model(b"")
