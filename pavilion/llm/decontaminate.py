"""Benchmark decontamination by winnowing; DataFrame operations only.

Of every SPAN - GRAM + 1 consecutive hashes of word GRAM-grams the least is kept, in documents and items alike. Two texts
that share SPAN words share a kept hash within them, so the join of kept hashes misses no shared window. A hit is then
extended word by word to both sides: it counts where at least SPAN words agree. Items shorter than SPAN are
one window: their whole length is a gram of its own, looked for at every position.

Kept hashes of the items are grouped by the words around them, so that items which share a passage meet a document's
hash once. They are written first, so that their true size decides how they are joined.

Defined cases: a null or wordless document has no words and no hits; a null or wordless item has no window; items
with a null id are left out; repeated rows of either table count once as an item and repeat as documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import id_or_last, text_key, where_after
from pavilion.session import materialize

SPAN, GRAM = 10, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every character below 0x80 that is no letter or digit separates words.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text):
    """Lower-cased words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text; none of a null."""
    # One pass that maps letters to small ones and separators to a space.
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def gram_hashes(words_, gram):
    """Hash of the gram that starts at each position, in order."""
    last = F.size(words_) - gram
    hashed = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words_, i + k) for k in range(gram)])
    )
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<long>"))


def winnowed(rows: DataFrame, span=SPAN, gram=GRAM) -> DataFrame:
    """rows with __words and, in __kept, the (pos, hash) that are the least of some window of gram hashes."""
    window = span - gram + 1
    hashed = rows.withColumn("__grams", gram_hashes(F.col("__words"), gram))
    starts = F.size("__grams") - window
    least = F.transform(
        F.sequence(F.lit(0), starts), lambda i: F.least(*[F.get(F.col("__grams"), i + k) for k in range(window)])
    )
    windows = hashed.withColumn("__least", F.when(starts >= 0, least).otherwise(F.array().cast("array<long>")))
    # A position is kept if the greatest of the minima of the windows that hold it is its own hash.
    marked = F.transform(
        F.col("__grams"),
        lambda h, i: F.when(
            h == F.greatest(*[F.get(F.col("__least"), i - k) for k in range(window)]),
            F.struct(i.alias("pos"), h.alias("hash")),
        ),
    )
    return windows.withColumn("__kept", F.filter(marked, lambda k: k.isNotNull())).drop("__grams", "__least")


def item_index(items: DataFrame, span=SPAN, gram=GRAM) -> DataFrame:
    """(hash, grams, left, middle, right, item_ids): the kept grams of items with the words around them.

    left and right hold at most span - gram words; equal surroundings are one row with all their items.
    """
    rows = items.filter("item_id is not null").select(F.col("item_id").alias("__item"), words(F.col("text")).alias("__words"))
    rows = rows.filter(F.size("__words") > 0)
    reach = span - gram
    long = winnowed(rows.filter(F.size("__words") >= span), span, gram).select("__item", "__words", F.explode_outer("__kept").alias("__k"))
    pos = F.col("__k.pos")
    left_from = F.greatest(pos - reach, F.lit(0))
    long = long.select(
        "__item", F.col("__k.hash").alias("hash"), F.lit(gram).alias("grams"),
        F.slice("__words", left_from + 1, pos - left_from).alias("left"),
        F.slice("__words", pos + 1, F.lit(gram)).alias("middle"),
        F.slice("__words", pos + gram + 1, F.lit(reach)).alias("right"),
    )
    none = F.array().cast("array<string>")
    short = rows.filter(F.size("__words") < span).select(
        "__item", _whole_hash(F.col("__words")).alias("hash"), F.size("__words").alias("grams"),
        none.alias("left"), F.col("__words").alias("middle"), none.alias("right"),
    )
    grouped = long.union(short).groupBy("hash", "grams", "left", "middle", "right")
    return grouped.agg(F.collect_set("__item").alias("item_ids"))


def _whole_hash(words_):
    """Hash of all words of a short item; its length sets it apart from grams of other lengths."""
    return F.xxhash64(F.size(words_), words_)


def _shared(rows: DataFrame, index: DataFrame, span, gram) -> DataFrame:
    """(__id, __key, __pos, left, middle, right, grams, item_ids) wherever a document has a hash of the index."""
    # An inner explode would put a test of its whole input below, to be worked out twice and more.
    kept = winnowed(rows, span, gram).select("__id", "__key", F.explode_outer("__kept").alias("__k"))
    grams = kept.select("__id", "__key", F.col("__k.pos").alias("__pos"), F.col("__k.hash").alias("hash"))
    lengths = [r[0] for r in index.filter(F.size("middle") != gram).select(F.size("middle")).distinct().collect()]
    lengths += [gram] if index.filter((F.size("middle") == gram) & (F.size("left") + F.size("right") == 0)).limit(1).count() else []
    for n in sorted(set(lengths)):  # at most span - 1 of them
        last = F.size("__words") - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last))
        short = rows.select("__id", "__key", "__words", F.explode_outer(starts).alias("__pos")).select(
            "__id", "__key", "__pos", _whole_hash(F.slice("__words", F.col("__pos") + 1, F.lit(n))).alias("hash")
        )
        grams = grams.union(short)
    return grams.join(index, "hash").drop("hash")


def _agreeing(words_, pos, near, step):
    """How many words next to a gram agree with an item's, counted away from the gram until the first that differs."""
    size = F.size(near)
    at = F.sequence(F.lit(1), size)
    if step < 0:
        differs = lambda k: ~F.get(words_, pos - k).eqNullSafe(F.get(near, size - k)) | (pos - k < 0)
    else:
        differs = lambda k: ~F.get(words_, pos + k - 1).eqNullSafe(F.get(near, k - 1))
    first = F.array_min(F.filter(at, differs))
    return F.when(size == 0, 0).otherwise(F.coalesce(first - 1, size))


def _verified(rows: DataFrame, span) -> DataFrame:
    """From __words and __hits the __spans (first word, words) that hold a window, with their items; null without hits."""

    def extended(hit):
        grams = hit["grams"]
        left = _agreeing(F.col("__words"), hit["__pos"], hit["left"], -1)
        right = _agreeing(F.col("__words"), hit["__pos"] + grams, hit["right"], 1)
        same = F.slice(F.col("__words"), hit["__pos"] + 1, grams) == hit["middle"]
        return F.struct(
            (hit["__pos"] - left).alias("first"), (left + grams + right).alias("n"), same.alias("same"),
            F.when(F.size(hit["left"]) + F.size(hit["right"]) == 0, F.least(grams, F.lit(span))).otherwise(span).alias("needed"),
            hit["item_ids"].alias("item_ids"),
        )

    spans = F.filter(F.transform("__hits", extended), lambda s: s["same"] & (s["n"] >= s["needed"]))
    return rows.withColumn("__spans", F.when(F.col("__hits").isNotNull(), spans))


def find(docs: DataFrame, items: DataFrame, span=SPAN, gram=GRAM) -> DataFrame:
    """__id and __key of every document that may share a window, with __hits, the places to be verified."""
    index = materialize(item_index(items, span, gram), "item-grams")
    rows = docs.select(id_or_last().alias("__id"), text_key().alias("__key"), words(F.col("text")).alias("__words"))
    shared = _shared(rows, index, span, gram)
    # Equal rows of documents meet here; their equal hits count once.
    hits = shared.groupBy("__id", "__key").agg(
        F.collect_set(F.struct("__pos", "grams", "left", "middle", "right", "item_ids")).alias("__hits")
    )
    return materialize(hits, "hits").withColumnsRenamed({"__id": "__hit_id", "__key": "__hit_key"})


def _with_hits(docs: DataFrame, items: DataFrame, span, gram) -> DataFrame:
    keyed = docs.withColumns({"__id": id_or_last(), "__key": text_key()})
    hits = find(docs, items, span, gram)
    joined = keyed.join(hits, (F.col("__id") == F.col("__hit_id")) & (F.col("__key") == F.col("__hit_key")), "left")
    return joined


def judge(docs: DataFrame, items: DataFrame, span=SPAN, gram=GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document row."""
    joined = _with_hits(docs.select("doc_id", "text"), items, span, gram)
    rows = _verified(joined.withColumn("__words", words(F.col("text"))), span)
    covered = F.array_distinct(F.flatten(F.transform("__spans", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1))))
    ids = F.flatten(F.transform("__spans", lambda s: F.transform(s["item_ids"], lambda i: i.cast("string"))))
    counted = rows.select(
        "doc_id", F.size("__words").cast("long").alias("n_words"),
        F.when(F.col("__spans").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct(ids)), F.array().cast("array<string>")).alias("__items"),
    )
    return counted.select(
        "doc_id", "n_words", "n_hit",
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, span=SPAN, gram=GRAM) -> DataFrame:
    """The documents without any window of an item, with their own columns."""
    joined = _with_hits(docs, items, span, gram)
    rows = joined.withColumn("__words", F.when(F.col("__hits").isNotNull(), words(F.col("text"))))
    clean = where_after(_verified(rows, span), F.coalesce(F.size("__spans"), F.lit(0)) <= 0)
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
