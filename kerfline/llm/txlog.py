"""Reassembling a transaction log: what each transaction leaves, and what undid the rest.

Each source's records follow one another by id. A record has a height: a change stands one
above the savepoints before it, a rollback just under the changes since the latest
savepoint, an abort under all. So what undoes a change is the first later record of its
transaction that is lower than it. That is found by binary lifting over a sparse table of
range minima: inside blocks of a few thousand records in numpy, and from block to block by
joins over a table with one row a block. A change that nothing lower follows is kept if the
last marker of its transaction is a commit.

No source, transaction or key is gathered anywhere: records lie in slices of the order
(source, id), and only counts of the slices meet (see ordered.py).

Defined cases: rows without an id are no records; a null text deletes its key, an empty one
is stored; a null source is a source; equal ids are records of their own, ordered by source
and then by value, deletions first; very long texts are read whole, as a checksum; extra
columns are not looked at; an empty log gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks, ordered

CHANGE, SAVEPOINT, ROLLBACK, COMMIT, ABORT = range(5)
#: Heights that no record is below, and that none is above.
_LOWEST, _HIGHEST = -1, 1 << 60
_PARTS = "what string, block int, t long, height long, at long, key long, value long, how string, by long, first string, last string, ended boolean, savepoints long"


def records(docs: DataFrame, labels: DataFrame, keys: int = 3000) -> DataFrame:
    """(source, at, kind, key, value): documents as log records, by the crc32 of their ids; value is the checksum of `key:text`, or null for a deletion."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    m, key = F.col("h") % 41, F.floor(F.col("h") / 100) % keys
    kind = F.when(m <= 1, COMMIT).when(m == 2, ABORT).when(m <= 4, SAVEPOINT).when(m <= 6, ROLLBACK).otherwise(CHANGE)
    log = docs.select(docs["doc_id"], docs["source"], docs["text"]).where("doc_id IS NOT NULL").withColumn("h", h)
    log = log.select("doc_id", "source", kind.alias("kind"), key.cast("long").alias("key"), F.crc32(F.concat(key.cast("string"), F.lit(":"), F.col("text")).cast("binary")).alias("value"))
    toxic = labels.where(labels["toxic"] == 1).select(labels["doc_id"]).distinct().withColumn("toxic", F.lit(True))
    changed = F.col("kind") == CHANGE
    return log.join(toxic, "doc_id", "left").select("source", F.col("doc_id").alias("at"), "kind", F.when(changed, F.col("key")).alias("key"), F.when(changed & F.col("toxic").isNull(), F.col("value")).alias("value"))


def first_lower(heights: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each start the first place after it and before its stop that is lower than it, or the stop."""
    levels = [heights]
    while 1 << len(levels) <= len(heights):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    at, own = starts + 1, heights[starts]
    for j in range(len(levels) - 1, -1, -1):
        far = at + (1 << j)
        fits = far <= stops
        fits[fits] = levels[j][at[fits]] >= own[fits]
        at = np.where(fits, far, at)
    return at


def _solve(kind, at, key, value, t, s, begins, block: int, homes: tuple[str, str]) -> pa.RecordBatch:
    """One block: its changes with what became of them, as far as the block tells; its commits; what earlier blocks ask of it.

    t numbers transactions, s savepoints so far; begins is true where another source starts.
    """
    n = len(kind)
    height = np.select([kind == ROLLBACK, kind == ABORT, kind == COMMIT], [2 * s, _LOWEST, _HIGHEST], 2 * s + 1)
    last = np.flatnonzero(np.concatenate((t[1:] != t[:-1], [True])))  # last record of each transaction here
    stop = last[np.searchsorted(last, np.arange(n))] + 1
    change = np.flatnonzero(kind == CHANGE)
    low = first_lower(height, change, stop[change])
    lower, end = low < stop[change], stop[change] - 1
    open_ = ~lower & (stop[change] == n) & (kind[n - 1] != COMMIT)  # later blocks tell
    kept = ~lower & (kind[end] == COMMIT)
    by_at = np.where(lower, at[np.minimum(low, n - 1)], at[end])
    how = np.select([open_, kept, lower & (kind[np.minimum(low, n - 1)] == ROLLBACK)], ["", "kept", "rollback"], "abort")
    known = lower | kept
    commits = np.flatnonzero(kind == COMMIT)
    # of the transaction that the block begins in: each new minimum among what undoes
    head = np.flatnonzero((kind[: stop[0]] == ROLLBACK) | (kind[: stop[0]] == ABORT))
    minima = np.minimum.accumulate(height[head])
    head = head[np.concatenate(([True], minima[1:] < minima[:-1]))[: len(head)]]
    parts = [
        {"what": ["change"] * len(change), "t": t[change], "height": height[change], "at": at[change], "key": key.take(pa.array(change)), "value": value.take(pa.array(change)), "how": pa.array([x or None for x in how.tolist()], pa.string()), "by": pa.array(by_at, pa.int64(), mask=~known)},
        {"what": ["commit"] * len(commits), "t": t[commits], "at": at[commits]},
        {"what": ["low"] * len(head), "t": t[head], "height": height[head], "at": at[head], "how": pa.array(["rollback" if k == ROLLBACK else "abort" for k in kind[head]], pa.string())},
        {"what": ["head"], "t": t[:1], "height": [int(height[: stop[0]].min())], "first": [homes[0]], "last": [homes[1]], "ended": [bool(kind[-1] in (COMMIT, ABORT))], "savepoints": s[-1:], "by": t[-1:]},
    ]
    schema = pa.schema([("what", pa.string()), ("block", pa.int32()), ("t", pa.int64()), ("height", pa.int64()), ("at", pa.int64()), ("key", pa.int64()), ("value", pa.int64()), ("how", pa.string()), ("by", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("ended", pa.bool_()), ("savepoints", pa.int64())])
    out = []
    for part in parts:
        m = len(part["what"])
        columns = [pa.array(np.full(m, block), f.type) if f.name == "block" else pa.array(part[f.name], f.type) if f.name in part else pa.nulls(m, f.type) for f in schema]
        out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _blocks(batches, rows: int):
    """The stream of a slice as record batches of `rows` rows, the last one shorter."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _located(log: DataFrame, rows: int) -> DataFrame:
    """The parts of all blocks, with transactions, blocks and heights numbered through all slices."""

    def run(batches):
        t = s = 0
        home, ended = None, False
        for k, batch in enumerate(_blocks(batches, rows)):
            homes = batch.column(0)
            kind, at = batch.column(2).to_numpy(), batch.column(1).to_numpy()
            other = pc.not_equal(homes, pa.concat_arrays([pa.array([homes[0].as_py() if home is None else home]), homes.slice(0, len(homes) - 1)])).to_numpy(zero_copy_only=False)
            after_end = np.concatenate(([ended], np.isin(kind[:-1], (COMMIT, ABORT))))
            ts, ss = t + np.cumsum(other | after_end), s + np.cumsum(kind == SAVEPOINT)
            yield _solve(kind, at, batch.column(3), batch.column(4), ts, ss, other, k, (homes[0].as_py(), homes[-1].as_py()))
            t, s, home, ended = int(ts[-1]), int(ss[-1]), homes[-1].as_py(), bool(kind[-1] in (COMMIT, ABORT))

    named = log.select(F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("home"), F.col("at").cast("long").alias("at"), F.col("kind").cast("int").alias("kind"), F.col("key").cast("long").alias("key"), F.col("value").cast("long").alias("value"))
    parts = blocks.cut(ordered.slices(named, "home", "at", "value").mapInArrow(run, _PARTS).withColumn("slice", F.spark_partition_id()))
    heads = parts.where("what = 'head'")
    each = heads.groupBy("slice").agg((F.max("block") + 1).alias("n_blocks"), F.max("by").alias("last_t"), F.max("savepoints").alias("n_savepoints"), F.min_by("first", "block").alias("first"), F.max_by(F.struct("last", "ended"), "block").alias("end"))
    above = Window.orderBy("slice")
    joined = F.when(F.lag("end.ended").over(above) | (F.lag("end.last").over(above) != F.col("first")), 1).otherwise(0)
    each = each.withColumn("t_up", F.coalesce(F.lag("last_t").over(above), F.lit(0)) + joined)
    upto = above.rowsBetween(Window.unboundedPreceding, 0)
    offsets = each.select("slice", F.sum("t_up").over(upto).alias("t_up")).join(ordered.before(each, "n_blocks", "n_savepoints"), "slice")
    height = F.when(F.col("height").between(0, _HIGHEST - 1), F.col("height") + 2 * F.col("n_savepoints")).otherwise(F.col("height"))
    return parts.join(F.broadcast(offsets), "slice").select("what", (F.col("block") + F.col("n_blocks")).cast("long").alias("block"), (F.col("t") + F.col("t_up")).alias("t"), height.alias("height"), "at", "key", "value", "how", "by")


def _later(parts: DataFrame) -> DataFrame:
    """(block, height, later_how, later_by) for the changes that their own block leaves open: lifting over the blocks' minima."""
    asked = blocks.cut(parts.where("what = 'change' AND how IS NULL").select("block", "t", "height").distinct().withColumn("b", F.col("block") + 1))
    level = parts.where("what = 'head'").select("t", F.col("block").alias("b"), F.col("height").alias("least"))
    longest = level.groupBy("t").count().agg(F.max("count")).first()[0] or 0
    levels = [blocks.cut(level)]
    while 1 << len(levels) <= longest:
        half = 1 << (len(levels) - 1)
        right = levels[-1].select("t", (F.col("b") - half).alias("b"), F.col("least").alias("right"))
        levels.append(blocks.cut(levels[-1].join(right, ["t", "b"]).select("t", "b", F.least("least", "right").alias("least"))))
    for j, level in reversed(list(enumerate(levels))):
        stepped = asked.join(level, ["t", "b"], "left")
        asked = blocks.cut(stepped.select("block", "t", "height", F.when(F.col("least") >= F.col("height"), F.col("b") + (1 << j)).otherwise(F.col("b")).alias("b")))
    lows = parts.where("what = 'low'").select("t", F.col("block").alias("b"), F.col("height").alias("low"), F.struct("at", "how").alias("undoer"))
    under = F.min(F.when(F.col("low") < F.col("height"), F.col("undoer")))
    found = asked.join(lows, ["t", "b"], "left").groupBy("block", "t", "height").agg(under.alias("undoer"))
    last = parts.where("what = 'commit'").select("t", F.col("at").alias("commit_at"))
    told = found.join(last, "t", "left")
    how = F.coalesce(F.col("undoer.how"), F.when(F.col("commit_at").isNotNull(), "kept"), F.lit("abort"))
    return told.select("block", "height", how.alias("later_how"), F.coalesce("undoer.at", "commit_at").alias("later_by"))


def changes(log: DataFrame, block_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """What became of each change, and the commits.

    (t, at, key, value, how, by): how is kept, rollback or abort, by the id of the commit,
    rollback or abort (null: the log ended); t numbers the transactions. (t, at): the commits.
    """
    parts = _located(log, block_rows)
    changed = parts.where("what = 'change'")
    open_ = changed.where("how IS NULL").drop("how", "by").join(_later(parts), ["block", "height"]).select("t", "at", "key", "value", F.col("later_how").alias("how"), F.col("later_by").alias("by"))
    done = changed.where("how IS NOT NULL").select("t", "at", "key", "value", "how", "by").union(open_)
    return blocks.cut(done), parts.where("what = 'commit'").select("t", "at")


def states(done: DataFrame, commits: DataFrame, every: int = 16) -> DataFrame:
    """(epoch, n, value): stored keys and the sum of their values after each `every` commits, by the commits' ids; the last epoch has the rest.

    Only the last write of a key in a transaction and in an epoch counts, so writes are
    reduced before they travel; each is then held against the key's write before it, and
    the differences are summed up over the epochs.
    """
    numbered = ordered.running(commits.withColumn("one", F.lit(1).cast("long")), ["at", "t"], {"c": "one"})
    numbered = blocks.cut(numbered.select("t", "c", F.expr(f"(c - 1) div {int(every)} + 1").alias("epoch")))
    epochs = numbered.agg(F.max("epoch")).first()[0] or 0
    in_order = F.struct("at", F.coalesce("value", F.lit(-1)))
    written = done.where("how = 'kept'").groupBy("t", "key").agg(F.max_by(F.struct("value"), in_order).alias("w")).join(numbered, "t")
    written = written.groupBy("key", "epoch").agg(F.max_by("w", "c").alias("w")).select("key", "epoch", "w.value")
    held = ordered.previous(written, "key", "epoch", "value")
    more = F.col("value").isNotNull().cast("long") - F.col("earlier").isNotNull().cast("long")
    deltas = held.groupBy("epoch").agg(F.sum(more).alias("more"), F.sum(F.coalesce("value", F.lit(0)) - F.coalesce("earlier", F.lit(0))).alias("add"))
    every_epoch = done.sparkSession.range(1, epochs + 1).withColumnRenamed("id", "epoch").join(deltas, "epoch", "left")
    return ordered.running(every_epoch, ["epoch"], {"n": "more", "value": "add"}).select("epoch", "n", "value")


def reassemble(log: DataFrame, every: int = 16, block_rows: int = 4096) -> DataFrame:
    """(kind, id, n, value): a `state` for each epoch, and an `abort` or `rollback` for each undone change with what undid it and its key."""
    done, commits = changes(log, block_rows)
    undone = done.where("how <> 'kept'").select(F.col("how").alias("kind"), F.col("at").alias("id"), F.col("by").alias("n"), F.col("key").alias("value"))
    return states(done, commits, every).select(F.lit("state").alias("kind"), F.col("epoch").alias("id"), "n", "value").union(undone)
