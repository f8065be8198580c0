"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range is kept.

All sketches share one threshold, so they can be merged (the sketch of a union is the union of the sketches), and the
part of a short document that lies in a long one can be estimated, which sketches of fixed size cannot do. Of a text with
fewer than LEAST hashes below the threshold all hashes are kept: its sketch is whole. Two whole sketches are compared as
they are, which is exact; where one of the two is not whole, only hashes below the threshold count. A sketch tells which
it is: a whole one has fewer than LEAST hashes or one above the threshold. Only a text without words has an empty sketch.

Everything here is SQL expressions; a text of any length is split once and hashed by position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.frames import narrow
from tidewheel.operators.order import row_index
from tidewheel.session import stage

WIDTH = 5
#: One hash in so many is kept.
ONE_IN = 8
#: With fewer hashes below the threshold a sketch holds all of them.
LEAST = 8
_LOWEST = -(1 << 63)


def _last(one_in: int) -> Column:
    """The greatest hash below the threshold."""
    return F.lit(_LOWEST + (1 << 64) // one_in - 1)


def sketch(text: Column, width: int = WIDTH, one_in: int = ONE_IN) -> Column:
    """Sorted distinct hashes (array<long>) of the shingles of ``width`` words that lie below the threshold, or all of them
    if fewer than LEAST do.

    A text of fewer words is one shingle. Null counts as empty.
    """
    plain = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\x0b\f"))
    words = F.split(plain, r"\s+")

    def of(words: Column) -> Column:
        n = F.size(words)
        many = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))
        few = F.array(F.xxhash64(F.array_join(words, " ")))
        return F.when(n >= width, many).otherwise(few)

    def low(hashes: Column) -> Column:
        kept = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h <= _last(one_in))))
        return F.transform(F.array(kept), lambda k: F.when(F.size(k) >= LEAST, k).otherwise(F.array_sort(F.array_distinct(hashes))))[0]

    # one-element arrays bind a value to a name, so that it is worked out once
    hashes = F.transform(F.array(words), of)
    return F.when(F.length(plain) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(hashes, low)[0])


def text_of(sketch: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _together(a: Column, b: Column, one_in: int, of: Callable[[Column, Column], Column]) -> Column:
    """``of`` both sketches, cut to the threshold unless both are whole."""
    last = _last(one_in)

    def whole(s: Column) -> Column:
        return (F.size(s) < LEAST) | (F.get(s, F.size(s) - 1) > last)

    def low(s: Column) -> Column:
        return F.filter(s, lambda h: h <= last)

    return F.when(whole(a) & whole(b), of(a, b)).otherwise(of(low(a), low(b)))


def merge(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The sketch of two documents together. Two whole sketches give a whole one."""
    return _together(a, b, one_in, lambda x, y: F.array_sort(F.array_union(x, y)))


def containment(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Estimated part of a's shingles that b has; 1 for an empty a, null where a is whole and has no hash below the
    threshold while b is not whole, as nothing is known then."""

    def part(x: Column, y: Column) -> Column:
        return F.when(F.size(a) == 0, 1.0).when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x))

    return _together(a, b, one_in, part)


def likeness(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Estimated shingles in both over shingles in either; 1 for two empty sketches."""

    def share(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x, y))
        either = F.size(x) + F.size(y) - both
        return F.when(either == 0, 1.0).otherwise(both / either)

    return _together(a, b, one_in, share)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, key (a digest of the text) and sketch of every row."""
    rows = keyed(docs)
    return rows.select("doc_id", "key", F.char_length("text").cast("long").alias("n_chars"), sketch(F.col("text")).alias("sketch"))


def keyed(docs: DataFrame) -> DataFrame:
    return narrow(docs).withColumn("key", F.md5(F.col("text").cast("binary")))


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, in which the last half (rounded down, in code points) is
    replaced by as many first code points of the next document by descending doc_id, or by all of them; after the last
    document comes the first.

    Null texts count as empty. Null doc_ids come last; documents with one doc_id are ordered by a digest of their text;
    rows equal in both are one document, given once for each row. A single document is its own next. Other columns are
    ignored; an empty table gives no rows.

    Texts are shuffled once, by doc_id and digest, and the heads of texts once more; the order is found on ids alone.
    """
    # a document is a pair of id and digest, in which null ids are equal
    document = F.struct("doc_id", "key")
    own = fingerprints(docs).select(document.alias("d"), "n_chars", "sketch").groupBy("d").agg(F.first("n_chars").alias("n_chars"), F.first("sketch").alias("sketch"))
    own = stage(own, "sketches")
    order = row_index(own.select("d", "n_chars"), [F.col("d.doc_id").desc_nulls_last(), "d.key"], "place", spread_copies=False)
    nexts = order.select(F.col("d").alias("next"), F.col("place").alias("_place"))
    pairs = order.join(nexts, (F.col("place") + 1) % F.col("place_n") == F.col("_place"))
    pairs = stage(pairs.select("d", "next", F.floor(F.col("n_chars") / 2).cast("int").alias("half")), "nexts")

    # both joins read the one shuffle of texts
    texts = keyed(docs).select(document.alias("d"), "text")
    asked = pairs.select(F.col("next").alias("d"), F.col("d").alias("target"), "half")
    heads = texts.join(asked, "d").select("target", "half", F.left("text", F.col("half")).alias("head"))
    heads = heads.groupBy(F.col("target").alias("d")).agg(F.first("half").alias("half"), F.first("head").alias("head"))
    edited = texts.join(heads, "d").select("d", F.concat(F.left("text", F.char_length("text") - F.col("half")), F.col("head")).alias("edited"))
    edited = stage(edited.select("d", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch")), "edited")

    following = own.select(F.col("d").alias("next"), F.col("sketch").alias("next_sketch"))
    known = own.join(pairs.select("d", "next"), "d").join(following, "next").select("d", "n_chars", "sketch", likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
    return edited.join(known, "d").select(
        "d.doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        "near_next",
    )
