"""Hot keys are dealt to several tasks, and characters of all scripts are compared whole."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kerfline.llm import blocks, decontam, spandedup


def test_a_header_on_all_pages_is_dealt(spark):
    """100,000 rows of one key at one place: the largest of the salts has under a tenth."""
    rows = spark.range(100_000).selectExpr("id AS doc_id", "id AS copy", "0 AS at", "CAST(7 AS LONG) AS hash").union(spark.range(50).selectExpr("id", "id", "1", "id + 100"))
    kinds = blocks.cut(rows.groupBy("hash").agg(F.count("*").alias("c"), F.min("doc_id").alias("least")))
    salted, dealt = blocks.salted(rows, kinds, "hash", "c", ["doc_id", "copy", "at"], hot_rows=1000)
    sizes = [r["count"] for r in salted.where("hash = 7").groupBy("salt").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 10_000 and sum(sizes) == 100_000
    assert dealt.where("hash = 7").count() == 64 and dealt.where("hash <> 7").count() == 50
    joined = blocks.spread_join(rows, kinds, "hash", "c", ["doc_id", "copy", "at"], hot_rows=1000)
    assert joined.count() == 100_050 and joined.columns == ["hash", "doc_id", "copy", "at", "c", "least"]


def test_spans_with_a_hot_header(spark, monkeypatch):
    """The first page keeps a header that all have; the result does not hang on the dealing."""
    header = "This is the header that every single page of the site repeats. And here is its second sentence, just as long as the first one."
    docs = spark.createDataFrame([(i, f"{header} Page number {i} has words of its own, {i * 7919} of them. It ends with {i * 104729} more.") for i in range(300)], "doc_id long, text string")
    whole = spandedup.remove_repeats(docs).orderBy("doc_id").collect()
    join = blocks.spread_join
    monkeypatch.setattr(blocks, "spread_join", lambda *a: join(*a, hot_rows=5))
    assert spandedup.remove_repeats(docs).orderBy("doc_id").collect() == whole
    assert whole[0].n_removed == 0 and all(r.n_removed == 2 for r in whole[1:])


def folded(text):
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", low).strip(" ")


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


ALPHABETS = {"chinese": "一丁七万丈三上下不与丐丑专且世丘丙业", "cyrillic": "абвгдежзийклмнопрст", "emoji": "😀😁😂🙂🚀🌍🎉📦", "latin": "abcdefghijklmnop", "accents": "éèêàçùÿñöäüß", "mixed": "abé中б😀 ,"}


@pytest.mark.parametrize("name", ALPHABETS)
def test_edits_in_all_scripts(spark, name):
    rng = random.Random(name)
    word = lambda n: "".join(rng.choice(ALPHABETS[name]) for _ in range(n))
    items = [(k, word(rng.randint(20, 60))) for k in range(6)]
    docs = []
    for k in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], [rng.choice(ALPHABETS[name])], [text[at], rng.choice(ALPHABETS[name])]])
        docs.append((k, word(rng.randint(0, 30)) + "".join(text) + word(rng.randint(0, 30))))
    docs += [(100 + k, "".join(chr(ord(c) + 128) if ord(c) > 0x3FF else c for c in t)) for k, t in items]  # as far apart as bytes can't tell
    want = set()
    for i, t in docs:
        for k, item in items:
            m = len(folded(item))
            if m >= 8:
                budget, edits = min(int(0.1 * m), (m - 8) // 8), fewest_edits(folded(item), folded(t))
                if edits <= budget:
                    want.add((i, k, edits, budget, m))
    found = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in found.collect()} == want and len(want) >= 20
    left = decontam.drop_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {w[0] for w in want}
