"""Spelling variants against words compared one by one."""

import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from kerfline.llm import queries, variants

DATA = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows, least=7, every=31):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(counts, ratio=10):
    words, cuts = sorted(counts), {}
    for w in words:  # only words that share what one deletion leaves, or are it, can be near
        for cut in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            cuts.setdefault(cut, []).append(w)
    close = {w: set() for w in words}
    for same in cuts.values():
        for x in same:
            close[x].update(y for y in same if near(x, y))
    form = {}
    for w in words:
        best = min(close[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(close[w]), counts[form[w]] if form[w] else None))
    return out


def test_whole_table(spark):
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    counts = {w: n for w, n in counted(zip(docs["doc_id"], docs["text"])).items() if n >= 2}
    got = queries.op11_variants(spark, DATA)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == grouped(counts)


@pytest.mark.parametrize("most", [0, 3, 2000])
def test_hot_halves_are_cut_down_to_letters(spark, most):
    """All words share their front half, many their back half too; whatever the limit, the same pairs."""
    words = {f"andon{x}{y}{z}": 1 for x in "abcd" for y in "aéc" for z in "xyz"} | {f"andon{x}{x}{y}x": 30 for x in "abcd" for y in "aec"}
    words |= {"aaaaaaaa": 5, "aaaaaaa": 400, "aaaaaaab": 4, "ab": 3, "b": 50, "abandonaax": 2000, "ndonaax": 200}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in variants.group_variants(table, 10, most).collect()]
    want = grouped(words)
    alone = {w for w in words if len(w) == 1}  # a word of one letter has no half
    assert {r for r in got if r[0] not in alone | {"ab"}} == {r for r in want if r[0] not in alone | {"ab"}}


def test_edges(spark):
    long_run, long_text = "Ab" * 4000, "Straße straßen STRASSEN überall Überall " * 3000
    rows = [(1, None, 7), (2, "", 7), (None, "nullnull nullnull", 7), (3, long_run + " " + long_run, 7), (3, long_run + " " + long_run, 7), (4, long_text, 7), (5, "x×yabcdefg 中abcdefgh中 1234567 abcdefg", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    for every in (0, 3, 31):
        got = {r.word: r.n for r in variants.count_words(docs, drop_every=every).collect()}
        assert got == counted([(i, t) for i, t, _ in rows], every=every)
    assert variants.group_variants(variants.count_words(docs.where("doc_id = 1"))).count() == 0
    assert variants.group_variants(variants.count_words(docs.limit(0))).count() == 0
