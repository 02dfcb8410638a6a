"""The transaction log against a plain replay of its records."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from kerfline.llm import queries, txlog

DATA = "/root/testdata/sf0.01"


def replay(log, every=16):
    """(kind, id, n, value) of (at, source, kind, key, value) records, one after the other."""
    out, store, open_, commits = [], {}, {}, 0

    def state():
        out.append(("state", -(-commits // every), len(store), sum(store.values())))

    order = sorted(log, key=lambda r: (r[0], r[1] is not None, r[1] or "", -1 if r[4] is None else r[4]))
    for at, source, kind, key, value in order:
        changes = open_.setdefault(source, [])
        if kind == txlog.CHANGE:
            changes.append((at, key, value))
        elif kind == txlog.SAVEPOINT:
            changes.append(None)
        elif kind == txlog.ROLLBACK:
            while changes and changes[-1] is not None:
                i, k, _ = changes.pop()
                out.append(("rollback", i, at, k))
        else:
            for i, k, v in filter(None, changes):
                if kind == txlog.ABORT:
                    out.append(("abort", i, at, k))
                elif v is None:
                    store.pop(k, None)
                else:
                    store[k] = v
            open_[source] = []
            if kind == txlog.COMMIT:
                commits += 1
                if commits % every == 0:
                    state()
    if commits % every:
        state()
    out += [("abort", i, None, k) for changes in open_.values() for i, k, _ in filter(None, changes)]
    return sorted(out, key=str)


def test_whole_table(spark):
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    labels = pq.read_table(f"{DATA}/labels.parquet").to_pylist()
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1}
    log = []
    for d in docs:
        h = zlib.crc32(str(d["doc_id"]).encode())
        m, key = h % 41, h // 100 % 3000
        kind = txlog.COMMIT if m <= 1 else txlog.ABORT if m == 2 else txlog.SAVEPOINT if m <= 4 else txlog.ROLLBACK if m <= 6 else txlog.CHANGE
        gone = d["text"] is None or d["doc_id"] in toxic
        log.append((d["doc_id"], d["source"], kind, key, None if gone else zlib.crc32(f"{key}:{d['text']}".encode())))
    got = queries.op13_transactions(spark, DATA)
    assert got.dtypes == [("kind", "string"), ("id", "bigint"), ("n", "bigint"), ("value", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == replay(log)


def made(seed, n, sources, weights, keys=5):
    rng = random.Random(seed)
    out = []
    for at in rng.sample(range(10 * n), n):
        kind = rng.choices(range(5), weights)[0]
        change = kind == txlog.CHANGE
        out.append((at, rng.choice(sources), kind, rng.randrange(keys) if change else None, rng.choice([None, 0, rng.randrange(1000)]) if change else None))
    return out


@pytest.mark.parametrize("seed, n, sources, weights, rows", [
    (1, 400, ["a", None, "b", ""], (80, 5, 5, 5, 2), 7),
    (2, 500, ["a"], (80, 10, 8, 0.5, 0.5), 4),  # transactions over very many blocks
    (3, 300, ["a", "b"], (60, 20, 20, 0, 0), 3),  # neither commit nor abort: the log's end undoes
    (4, 300, ["a", "b"], (10, 5, 5, 70, 10), 5),  # empty commits
    (5, 200, [None, "x", "y"], (90, 0, 0, 5, 5), 1),
])
def test_small_blocks(spark, seed, n, sources, weights, rows):
    log = made(seed, n, sources, weights)
    table = spark.createDataFrame([(s, a, k, key, v) for a, s, k, key, v in log], "source string, at long, kind int, key long, value long").repartition(5)
    assert sorted(map(tuple, txlog.reassemble(table, 3, rows).collect()), key=str) == replay(log, 3)


def test_first_lower():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 64):
        heights = rng.integers(0, 6, n)
        starts = np.arange(n)
        stops = np.minimum(n, starts + 1 + rng.integers(0, n + 1, n))
        want = [next((p for p in range(i + 1, e) if heights[p] < heights[i]), e) for i, e in zip(starts, stops)]
        assert txlog.first_lower(heights, starts, stops).tolist() == want


def test_edges(spark):
    """Nulls, equal ids and rows, extra columns, a very long text, and no rows at all."""
    change = next(i for i in range(99) if zlib.crc32(b"%d" % i) % 41 > 6)
    commit = next(i for i in range(change + 1, 999) if zlib.crc32(b"%d" % i) % 41 <= 1)
    key = zlib.crc32(b"%d" % change) // 100 % 3000
    long = "långt " * 100_000
    schema, wide = "doc_id long, source string, text string, toxic int", [(None, "a", "x", 1), (change, None, long, 1), (change, None, long, 1), (commit, None, None, 1)]
    labels = spark.createDataFrame([(change + 10_000, 1), (None, 1)], "doc_id long, toxic int")
    got = txlog.reassemble(txlog.records(spark.createDataFrame(wide, schema), labels)).collect()
    assert [tuple(r) for r in got] == [("state", 1, 1, zlib.crc32(f"{key}:{long}".encode()))]
    labels = spark.createDataFrame([(change, 1), (change, 1), (change, 0)], "doc_id long, toxic int")
    got = txlog.reassemble(txlog.records(spark.createDataFrame(wide, schema), labels)).collect()
    assert [tuple(r) for r in got] == [("state", 1, 0, 0)]
    assert txlog.reassemble(txlog.records(spark.createDataFrame([], schema), labels)).count() == 0
