"""Grouping spelling variants: words one edit apart, joined by an even-partition pigeonhole.

A word of length l is cut into two halves. One inserted, deleted or replaced code point
leaves one of them as it was, so a word shares a half with each near word of its length at
the same place, and with each near word that is one longer at the same place (the front
half) or one place further on (the back half). Each half is a key of the index; each word
probes with its own halves and, as a word one longer than the indexed ones, with its front
and its shifted back half. Candidates are verified by their edit distance.

Keys that many words share ("and....", "....tion") are cut again: what lies outside the
equal half must hold the edit, so it is halved in turn and the half that stays equal is
added to the key, down to windows of one code point, where a key holds no more words than
there are letters. So no key emits many pairs and none is left out.

Defined cases: a null or empty text has no words; a null id is written as empty text
before the colon; very long texts and runs are read whole; repeated rows count each;
other columns are not looked at; an empty table gives no rows; among near words with equal
counts the smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

#: Latin-1 bytes: A-Z to a-z, a-z and U+00C0 to U+00FF as they are, all others to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Bytes of distinct words that a task counts before it hands its counts on.
_COUNTED_BYTES = 1 << 23


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _dropped(word: bytes, seed: int, every: int) -> bytes:
    h = zlib.crc32(_utf8(word), seed)
    return word if h % every else word[: h % len(word)] + word[h % len(word) + 1 :]


def count_words(docs: DataFrame, least: int = 7, drop_every: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): the runs of letters of at least `least` code points, lower-cased in A-Z, and how often each occurs.

    With drop_every, a run whose crc32 of `<id>:<run>` that number divides loses the code
    point at crc32 modulo its length before it is measured: typing errors to be found again.
    """
    long_enough = re.compile(rb"[^ ]{%d,}" % least)

    def run(batches):
        counts, held = {}, 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in blocks.sliced(batches, "text"):
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = long_enough.findall((t or "").encode("latin-1", "replace").translate(_FOLD))
                if drop_every and words:
                    seed = zlib.crc32(b"" if i is None else f"{i}".encode())
                    seed = zlib.crc32(b":", seed)
                    words = [w for w in (_dropped(w, seed, drop_every) for w in words) if len(w) >= least]
                for w in words:
                    if w in counts:
                        counts[w] += 1
                    else:
                        counts[w], held = 1, held + len(w) + 100
            if held > _COUNTED_BYTES:
                yield out()
                counts, held = {}, 0
        yield out()

    blocks.small_batches(docs)
    picked = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row (word, longer, a, b) with the window [a, b) of the indexed word cut in two, and the key of what lies outside each.

    A row with `longer` stands for the word as one longer than the indexed ones: what
    follows the window lies one place further on in it.
    """
    middle = F.expr("a + (b - a) div 2")
    windows = F.explode(F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b"))))
    cut = rows.withColumn("window", windows).select("word", "longer", "window.*")
    return cut.withColumn("key", F.expr("xxhash64(length(word) - longer, a, b, left(word, a), substring(word, b + longer + 1))"))


def near_pairs(words: DataFrame, most: int = 2000) -> DataFrame:
    """(x, y): each unordered pair of the distinct `word`s, of at least two code points, that are one edit apart, once.

    A key of more than `most` candidate pairs is cut again.
    """
    length = F.length("word")
    rows = words.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).where(length - F.col("longer") >= 2)
    rows, meeting = _halved(rows.select("word", "longer", F.lit(0).alias("a"), (length - F.col("longer")).alias("b"))), []
    while True:
        sizes = rows.groupBy("key").agg(F.sum(1 - F.col("longer")).alias("indexed"), F.count("*").alias("all"))
        sizes = blocks.cut(sizes.where("indexed > 0 AND all > 1"))
        sized = blocks.cut(blocks.spread_join(rows, sizes, "key", "all", ["word", "longer"]))
        many = (F.col("indexed") * F.col("all") > most) & (F.col("b") - F.col("a") > 1)
        meeting.append(sized.where(~many).select("key", "word", "longer"))
        rows = sized.where(many)
        if rows.limit(1).count() == 0:
            break
        rows = _halved(rows.select("word", "longer", "a", "b"))
    meeting = reduce(DataFrame.union, meeting)
    one, two = meeting.where("longer = 0").select("key", F.col("word").alias("x")), meeting.select("key", F.col("word").alias("y"), "longer")
    met = one.join(two, "key").where("(longer = 1 OR x < y) AND levenshtein(x, y, 1) = 1")
    return met.select("x", "y").distinct()


def group_variants(words: DataFrame, ratio: int = 10, most: int = 2000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of the distinct words with its count n.

    The form is the near word with the largest count, if that is at least ratio times the
    word's own; the root is where following forms ends.
    """
    words = blocks.cut(words.select("word", "n"))
    pairs = near_pairs(words, most)
    both = blocks.cut(pairs.select(F.col("x").alias("word"), F.col("y").alias("near")).union(pairs.select("y", "x")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("held", -F.col("best.less") >= ratio * F.col("n"))
    found = blocks.cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("held"), F.col("best.near")).alias("form"), F.when(F.col("held"), -F.col("best.less")).alias("form_n")))
    return found.join(_roots(found.where("form IS NOT NULL").select("word", "form")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms ends; each round doubles how far a word has come."""
    step = blocks.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = blocks.cut(step.join(further, "root", "left"))
        if ahead.where("next IS NOT NULL").limit(1).count() == 0:
            return step
        step = ahead.select("word", F.coalesce("next", "root").alias("root"))
