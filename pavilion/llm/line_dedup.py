"""Line dedup over all documents: a segment-partition edit join; DataFrame operations only.

Two lines are linked if at most EDITS = 1 edit apart. A line is split into threshold-plus-one segments, here a prefix and a
suffix of the same length, which the line's length alone decides and which is the same for neighbouring lengths (a
line at a border is indexed under both). One edit spares one of the two, so linked lines share an entry of the index. A group of
an index entry that is small is compared pair by pair, by banded bit-parallel edit distance. A large one is
never: what is left of its lines beside the shared segment is split again, until groups are small or what is
left is a character, where neighbours are found by equality. So the work follows the rows, not the squares of groups.

Linked lines form classes (with everything reachable), and of a class only the first line stays: that of the least doc_id, then
position. Outer spaces do not count. Equal lines are one class whatever their length; edits link lines of MIN_CHARS characters or
more, as one edit makes another word of a short line. Lines without content stay.

Defined cases: a null text has no lines and stays null; a null doc_id comes after all others; rows equal in doc_id and text are one
document and lose the same lines; rows that share a doc_id only are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import NULL_ID, id_or_last, text_key, where_after
from pavilion.llm.components import components
from pavilion.session import materialize

EDITS = 1
MIN_CHARS = 20
# Lines in a group up to which they are compared pair by pair.
SMALL = 16
# Times that a pair's texts are cut by half before the distance of what is left is worked out.
HALVED = 5
BREAK = "\n"


def _lines(docs: DataFrame) -> DataFrame:
    """(__id, __key, __pos, __form) of the lines that are judged; the form is the line without outer white space."""
    rows = docs.select(id_or_last().alias("__id"), text_key().alias("__key"), F.posexplode_outer(F.split("text", BREAK)).alias("__pos", "__line"))
    formed = rows.select("__id", "__key", "__pos", F.trim("__line").alias("__form"))
    return formed.filter(F.length("__form") > 0)


def _line_id():
    return F.unhex(F.md5("__form")).alias("lid")


def _segment(n):
    """Characters of a line's segments: a quarter to half of its length, the same between powers of two."""
    return F.when(n < 2, 0).otherwise(F.pow(F.lit(2), F.length(F.bin(n)) - 2).cast("int"))


def _entries(text, key, rests=True):
    """The index entries of a text within a group: (entry, segment's length, what is left), or without rests the entry alone."""
    n = F.length(text)

    def made(entry, width, rest):
        return F.struct(entry.alias("entry"), width.alias("width"), rest.alias("rest")) if rests else entry

    def pair(width):
        prefix = F.xxhash64(key, F.lit("prefix"), width, F.substring(text, F.lit(1), width))
        suffix = F.xxhash64(key, F.lit("suffix"), width, F.substring(text, n - width + 1, width))
        return F.when(width > 0, F.array(
            made(prefix, width, F.substring(text, width + 1, n)), made(suffix, width, F.substring(text, F.lit(1), n - width))
        )).otherwise(F.array(made(F.xxhash64(key, F.lit("end")), width, text)))

    own, shorter = _segment(n), _segment(n - 1)
    # A text at a border meets the ones a character shorter under their entries too.
    return F.when(own == shorter, pair(own)).otherwise(F.concat(pair(own), pair(shorter)))


def _grouped(rows: DataFrame, name: str) -> DataFrame:
    """rows (entry, ...) of entries with two or more, with the number of them."""
    sizes = rows.groupBy("entry").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return materialize(rows.join(sizes, "entry"), name)


def _pairs(rows: DataFrame) -> DataFrame:
    """Pairs within groups of at most SMALL lines."""
    small = rows.filter(F.col("size") <= SMALL).select("entry", "lid")
    other = small.select("entry", F.col("lid").alias("other"))
    return small.join(other, "entry").filter("lid < other").select("lid", "other")


def _ends(rows: DataFrame) -> DataFrame:
    """Links of large groups whose lines differ in a last character or two at most.

    Rests of no or one character are all one edit apart: a star. A rest of two holds that of a line one edit away.
    """
    short = rows.filter(F.length("rest") <= 1)
    least = short.groupBy("entry").agg(F.min("lid").alias("least"))
    star = short.join(least, "entry").filter("lid <> least").select("lid", F.col("least").alias("other"))
    one = rows.filter(F.length("rest") == 1).select("entry", F.col("rest").alias("held"), F.col("lid").alias("other"))
    two = rows.filter(F.length("rest") == 2).select("entry", "lid", F.explode(F.split("rest", "")).alias("held"))
    holds = two.filter("held <> ''").join(one, ["entry", "held"]).filter("lid <> other").select("lid", "other")
    return star.union(holds)


def candidates(index: DataFrame, texts_of) -> tuple[DataFrame, DataFrame]:
    """(pairs (lid, other) that share all but a small part of an edit's room, texts (lid, form) of lines in groups).

    index has lid and its entries; texts_of gives the texts of given lids.
    """
    rows = _grouped(index.select("lid", F.explode("entries").alias("entry")), "entries")
    texts = materialize(texts_of(rows.select("lid").distinct()), "texts")
    # Written level by level, so that the plan of the pairs stays a scan however many levels there are.
    found = [materialize(_pairs(rows), "pairs")]
    hot = rows.filter(F.col("size") > SMALL).select("entry", "lid")
    rests = texts.select("lid", F.explode_outer(_entries(F.col("form"), F.lit(0).cast("long"))).alias("e")).select("lid", "e.*")
    rests = rests.join(hot, ["entry", "lid"])
    while True:
        level = materialize(rests, "rests")
        if level.isEmpty():
            break
        split = level.select("lid", F.explode_outer(_entries(F.col("rest"), F.col("entry"))).alias("e")).select("lid", "e.*")
        rows = _grouped(split.distinct(), "entries")
        large = rows.filter(F.col("size") > SMALL)
        found.append(materialize(_pairs(rows).union(_ends(large.filter("width = 0"))), "pairs"))
        rests = large.filter("width > 0").select("lid", "entry", "width", "rest")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.select(F.least("lid", "other").alias("lid"), F.greatest("lid", "other").alias("other")).distinct(), texts


def _let(value, use):
    """use of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def within(a, b, edits=EDITS):
    """Whether two texts are at most edits apart: bit-parallel within the band of 2 * edits + 1 diagonals.

    A bit is a row of the band, which moves down by one with each character of b. The distance is followed down the lowest
    diagonal, then along the last row.
    """
    band = 2 * edits + 1
    mask = F.lit((1 << band) - 1).cast("long")
    m, n = F.length(a), F.length(b)

    def bit_of(bits, at):
        return F.shiftrightunsigned(bits, at).bitwiseAND(F.lit(1).cast("long"))

    def negated(bits):
        return F.bitwise_not(bits).bitwiseAND(mask)

    def advance(state, j):
        vp, vn = state["vp"], state["vn"]
        equal = F.lit(0).cast("long")
        for bit in range(band):  # row j - edits + bit against character j, both from 1; no row, no match
            same = F.get(state["p"], j - (edits - bit + 1)).eqNullSafe(F.get(state["t"], j - 1))
            equal = equal.bitwiseOR(F.when(same, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))

        def after_zero(zero):
            return _let(vn.bitwiseOR(negated(zero.bitwiseOR(vp))), lambda hp: after_hp(zero, hp))

        def after_hp(zero, hp):
            hn, down = zero.bitwiseAND(vp), F.shiftrightunsigned(zero, 1)
            along = F.lit(0).cast("long")
            for bit in range(band):
                along = F.when(m - j + edits == bit, bit_of(hp, bit) - bit_of(hn, bit)).otherwise(along)
            return F.struct(
                state["p"].alias("p"), state["t"].alias("t"), hn.bitwiseOR(negated(down.bitwiseOR(hp))).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (state["score"] + F.when(j + edits <= m, 1 - bit_of(zero, band - 1)).otherwise(along)).alias("score"),
            )

        def after_equal(equal):
            carried = (equal.bitwiseAND(vp) + vp).bitwiseXOR(vp)
            return _let(carried.bitwiseOR(equal).bitwiseOR(vn).bitwiseAND(mask), after_zero)

        return _let(equal, after_equal)

    first = F.struct(
        F.split(a, "").alias("p"), F.split(b, "").alias("t"), F.lit(((1 << band) - 1) ^ ((1 << edits) - 1)).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"), F.lit(edits).cast("long").alias("score"),
    )
    run = F.aggregate(F.sequence(F.lit(1), n), first, advance, lambda s: s["score"])
    narrow = F.least(m, n) <= edits  # no room for the band
    return F.when(F.abs(m - n) > edits, False).when(narrow, F.levenshtein(a, b) <= edits).otherwise(run <= edits)


def _halved(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v, a, b) without the half that a and b agree on; a pair that agrees on neither is more than an edit apart."""
    size_a, size_b = F.length("a"), F.length("b")
    least = F.least(size_a, size_b)
    half = F.floor(least / 2).cast("int")
    rest = least - half
    same_first = F.substring("a", F.lit(1), half) == F.substring("b", F.lit(1), half)
    same_last = F.substring(F.col("a"), size_a - rest + 1, rest) == F.substring(F.col("b"), size_b - rest + 1, rest)

    def left(text, size):
        return F.when(F.col("__first"), F.substring(F.col(text), half + 1, size)).otherwise(F.substring(F.col(text), F.lit(1), size - rest))

    close = where_after(pairs, (F.abs(size_a - size_b) <= EDITS) & (same_first | same_last)).withColumn("__first", same_first)
    return close.select("u", "v", left("a", size_a).alias("a"), left("b", size_b).alias("b"))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v, both lids) of the pairs that are within the edits."""
    near = pairs.join(texts.withColumnRenamed("form", "a"), "lid")
    near = near.join(texts.select(F.col("lid").alias("other"), F.col("form").alias("b")), "other")
    near = near.select(F.col("lid").alias("u"), F.col("other").alias("v"), "a", "b")
    # What both begin or end with adds nothing to their distance: most pairs differ in both halves of what is left soon.
    for _ in range(HALVED):
        near = _halved(near)
    return where_after(near.withColumn("near", within(F.col("a"), F.col("b"), EDITS)), F.col("near")).select("u", "v")


def line_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per line, roots): lid with its first place and number of places; (node, root) of lids in links."""
    entries = F.when(F.length("__form") >= MIN_CHARS, _entries(F.col("__form"), F.lit(0).cast("long"), rests=False))
    lines = _lines(docs).select(_line_id(), F.struct("__id", "__key", "__pos").alias("place"), entries.alias("entries"))
    per_line = lines.groupBy("lid").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.max("entries").alias("entries"))
    per_line = materialize(per_line, "lines")

    def texts_of(lids):
        texts = _lines(docs).select(_line_id(), "__form").groupBy("lid").agg(F.max("__form").alias("form"))
        return texts.join(lids, "lid", "left_semi")

    pairs, texts = candidates(per_line, texts_of)
    return per_line, components(links(pairs, texts))


def dropped(docs: DataFrame) -> DataFrame:
    """(__id, __key, __dropped) of documents that lose lines: (position, id of the document whose line stays), in order."""
    per_line, roots = line_classes(docs)
    linked = per_line.join(roots, F.col("lid") == F.col("node"))
    of_class = linked.groupBy("root").agg(F.min("first").alias("stays"))
    near = linked.join(of_class, "root").select("lid", "stays")
    plain = per_line.filter("n > 1").join(near, "lid", "left_anti").select("lid", F.col("first").alias("stays"))
    lines = _lines(docs).select(_line_id(), "__id", "__key", "__pos")
    gone = lines.join(plain.union(near), "lid").filter(F.struct("__id", "__key", "__pos") != F.col("stays"))
    place = F.struct(F.col("__pos").alias("pos"), F.col("stays.__id").alias("id"))
    return gone.groupBy("__id", "__key").agg(F.array_sort(F.collect_set(place)).alias("__dropped"))


def _with(docs: DataFrame, found: DataFrame) -> DataFrame:
    at = found.withColumnsRenamed({"__id": "__at_id", "__key": "__at_key"})
    keyed = docs.withColumns({"__id": id_or_last(), "__key": text_key()})
    return keyed.join(at, (F.col("__id") == F.col("__at_id")) & (F.col("__key") == F.col("__at_key")), "left")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped (positions) and classes (per dropped line the doc_id that keeps one) of every row."""
    counts = docs.select(
        "doc_id", id_or_last().alias("__id"), text_key().alias("__key"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", BREAK))).cast("long").alias("n_lines"),
    )
    at = dropped(docs).withColumnsRenamed({"__id": "__at_id", "__key": "__at_key"})
    rows = counts.join(at, (F.col("__id") == F.col("__at_id")) & (F.col("__key") == F.col("__at_key")), "left")
    positions = F.coalesce(F.col("__dropped.pos"), F.array().cast("array<int>"))
    classes = F.transform("__dropped", lambda d: F.nullif(d["id"], F.lit(NULL_ID)))
    return rows.select(
        "doc_id", "n_lines", F.size(positions).cast("long").alias("n_dropped"), positions.alias("dropped"),
        F.coalesce(classes, F.array().cast("array<long>")).alias("classes"),
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the lines that repeat, with their own columns; n_chars, if there, follows the text.

    A document that loses its last line with content goes as well.
    """
    lines = F.split("text", BREAK)
    rows = _with(docs, dropped(docs))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dropped.pos"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), BREAK)
    cut = rows.withColumn("__left", F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(kept))
    cut = where_after(cut, F.col("__dropped").isNull() | F.col("__left").rlike(r"\S"))
    new = {"text": F.col("__left")}
    if "n_chars" in docs.columns:
        changed = F.length("__left").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__dropped").isNull(), F.col("n_chars")).otherwise(changed)
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
