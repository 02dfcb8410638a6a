"""Packed pieces against the tokenizer itself, and best-two-fit against a plain reading of its rule."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from kerfline.llm import packing, queries, twofit

DATA = "/root/testdata/sf0.001"


def plain_two_fit(sizes, capacity):
    """The contents of each bin, by looking at all sizes and all pairs each time."""
    rest, out = sorted(sizes, reverse=True), []
    while rest:
        gap, bin_ = capacity, []
        while any(s <= gap for s in rest):
            bin_.append(next(s for s in rest if s <= gap))
            rest.remove(bin_[-1])
            gap -= bin_[-1]
        pairs = [(rest[i] + rest[j], rest[i], rest[j]) for i in range(len(rest)) for j in range(i + 1, len(rest)) if bin_[-1] < rest[i] + rest[j] <= gap + bin_[-1]]
        if gap and len(bin_) > 1 and pairs:
            _, a, b = max(pairs)
            rest.append(bin_.pop())
            rest.sort(reverse=True)
            rest.remove(a)
            rest.remove(b)
            bin_ += [a, b]
        out.append(sorted(bin_))
    return out


def contents(sizes, bins):
    out = defaultdict(list)
    for s, b in zip(sizes, bins):
        out[b].append(s)
    return [sorted(out[b]) for b in sorted(out)]


@pytest.mark.parametrize("seed", range(40))
def test_best_two_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64, 100])
    sizes = sorted((rng.randint(1, max(1, capacity // rng.choice([1, 2, 3]))) for _ in range(rng.randint(0, 60))), reverse=True)
    assert contents(sizes, twofit.best_two_fit(sizes, capacity)) == plain_two_fit(sizes, capacity)


def checked(rows, documents, closing, path, most=2048):
    """Every id of every document in one piece, with its checksum; sequences gapless and none too long."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (closing,) for _, t in documents)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= most
    ids = {}
    for i, t in documents:
        ids.setdefault(i, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, closing], "<u4"))
    assert set(by_doc) == set(ids)
    for i, found in by_doc.items():
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in found)
        assert pieces == sorted((s, len(x[s : s + most]), zlib.crc32(x[s : s + most].tobytes())) for x in ids[i] for s in range(0, len(x), most))
    assert sum(len(x) for x in want) == sum(r["length"] for r in rows)
    return len(by_sequence), -(-sum(len(x) for x in want) // most)


@pytest.mark.parametrize("name", ["op4_packing", "op12_best_fit"])
def test_whole_table(spark, name):
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    got = queries.QUERIES[name](spark, DATA)
    rows = [r.asDict() for r in got.collect()]
    bins, least = checked(rows, list(zip(docs["doc_id"], docs["text"])), 1 if name == "op4_packing" else 0, queries.token_path())
    assert bins <= 1.01 * least + 1
    if name == "op4_packing":
        tokens = defaultdict(int)
        for r in rows:
            tokens[r["doc_id"]] += r["length"]
        assert all(r["doc_tokens"] == tokens[r["doc_id"]] for r in rows)
    else:
        assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and dict(got.dtypes)["piece"] == "int"
        assert all(r["piece"] * 2048 == r["start"] for r in rows)


@pytest.mark.parametrize("pack, closing", [(packing.pack, 1), (twofit.pack, 0)])
def test_edges(spark, pack, closing):
    """Nulls, an id beyond double precision, ties, repeated rows, clashing names, a text of many pieces in groups of few."""
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    documents = [(2**60 + 1, "one two"), (2**60 + 2, "one two"), (2**60 + 2, "one two"), (None, "none"), (5, None), (6, ""), (7, long), (8, "x" * 5000)]
    table = spark.createDataFrame([(i, t, "p", 1, 2) for i, t in documents], "doc_id long, text string, pack_group string, length int, sequence_id int")
    path = queries.token_path()
    got = pack(table, path, group_rows=4)
    rows = [r.asDict() for r in got.collect()]
    checked(rows, documents, closing, path)
    groups = defaultdict(int)
    for r in rows:
        groups[r["sequence_id"] >> 32] += 1
    assert len(groups) >= 4 and max(groups.values()) <= 20
    assert pack(table.limit(0), path).count() == 0
    named = table.selectExpr("concat('d', coalesce(doc_id, 0)) AS name", "text AS body")
    assert pack(named, path, text="body", doc_id="name").schema["doc_id"].dataType.simpleString() == "string"
