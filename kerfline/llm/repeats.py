"""Repeated substrings by a run-length index of the Burrows-Wheeler transform.

Every byte covered by a string of `length` bytes that also starts somewhere else is
removed. Equal strings choose the same key, their least hashed k-gram, so the windows of
a text fall into segments by key, and only segments whose key occurs again are compared.
Equal segments travel once, with their number as a weight. A bucket's segments get a
run-compressed Burrows-Wheeler transform: of each run only the two ends are kept, with
their place and the length they share with the neighbour outside. Matching statistics are
then streamed over the places from these samples alone, and windows whose longest match
elsewhere reaches `length` are marked.

A key with more than hot_bytes of different segments (a short string that very many texts
share) would make a bucket that grows with the input. Its segments are split into single
windows, dealt and counted by the hash of each; equal windows then meet without an index.
Keys of very many rows are dealt to several tasks before they are joined.

Defined cases: null is empty; texts shorter than `length` lose nothing; matches never
cross rows; overlapping copies inside one text count; identical rows are copies of each
other, and all copies of a string go, so that there are no ties to break; rows are told
apart by id (null among them) and a hash of the text; a very long text is a block of its
own and may have any number of segments; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

SEPARATOR = 255  # never a byte of UTF-8


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(column, length: int, k: int):
    """(text, first window, windows, key, hash) of each run of windows that share their key."""
    data, starts, ends = blocks.separated(column, SEPARATOR)
    n = len(data) - length + 1
    room = np.maximum(ends - starts - length + 1, 0)  # windows in each text
    if n <= 0 or not room.any():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums = blocks.prefix_sums(blocks.BYTE_VALUES[data])
    grams = (sums[k:] - sums[:-k]) * blocks.powers(len(sums), inverse=True)[:-k]
    grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    key = sliding_minimum(grams, length - k + 1)
    # whether a window lies inside one text: by turns so many that do and that do not
    turns = np.column_stack((room, ends - starts + 1 - room)).ravel()
    valid = np.repeat(np.tile([True, False], len(room)), turns)[:n]
    # a segment ends where its k-gram leaves the window, even if an equal one is the next least
    new = valid.copy()
    new[1:] &= (key[1:] != key[:-1]) | (grams[: n - 1] == key[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    doc = np.searchsorted(starts, first, side="right") - 1
    last = np.minimum(np.append(first[1:], n), starts[doc] + room[doc])
    return doc, first - starts[doc], last - first, key[first].view(np.int64), blocks.range_hashes(sums, first, last - 1 + length).view(np.int64)


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of weighted parts, with sampled run ends.

    Its rows are the places where a window of `length` bytes starts in a part, in the order
    of what follows them there. Kept are, for the first and the last row of each run, the
    place and the length shared with the row outside the run; 4 values a run, whatever the
    size of the parts. A part of weight w stands for w copies, whose rows would lie next to
    each other in the same runs.

    Places in a part's last length - 1 bytes have no row. A match that only such a place
    would give is shorter than length, so that whether a statistic reaches it is exact.
    """

    def __init__(self, parts: list[bytes], weights: np.ndarray, length: int):
        sizes = np.array([len(p) for p in parts], np.int64)
        rooms = np.maximum(sizes - length + 1, 0)
        self.size, self.part = int(rooms.sum()), np.repeat(np.arange(len(parts)), rooms)
        n, first_place = self.size, np.cumsum(rooms) - rooms
        self.at = np.arange(n) - first_place[self.part]
        self.left = sizes[self.part] - self.at  # bytes from each place to the end of its part
        self.copied = np.asarray(weights)[self.part] > 1
        self.runs = 0
        if not n:
            return
        follow = [p[i:] for p, room in zip(parts, rooms.tolist()) for i in range(room)]
        order = np.array(sorted(range(n), key=follow.__getitem__), np.int64)
        del follow
        text = np.frombuffer(b"".join(parts), np.uint8)
        where = (np.cumsum(sizes) - sizes)[self.part] + self.at
        before = np.where(self.at > 0, text[where - 1].astype(np.int64), -1)[order]
        # nothing precedes a part's first place: its row is a run of its own
        head = np.ones(n, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0)
        first = np.flatnonzero(head)
        last = np.append(first[1:] - 1, n - 1)
        self.runs = len(first)
        up, down = order[first[1:] - 1], order[first[1:]]
        shared = common(text, where[up], where[down], np.minimum(self.left[up], self.left[down]))
        by = np.argsort(order[first])
        self.start_place, self.start_shared = order[first][by], np.append(0, shared)[by]
        by = np.argsort(order[last])
        self.end_place, self.end_shared = order[last][by], np.append(shared, 0)[by]

    def matching_statistics(self) -> np.ndarray:
        """For each place, streamed in text order, the longest match that starts elsewhere.

        Inside a run a place and its neighbour follow the same byte, so one place further
        on their shared length is one less; only run ends need a sample.
        """
        out = np.where(self.copied, self.left, 0)
        if self.runs:
            for place, shared in ((self.start_place, self.start_shared), (self.end_place, self.end_shared)):
                k = np.diff(np.append(place, self.size))
                out = np.maximum(out, np.repeat(place + shared, k) - np.arange(self.size))
        return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix, up to `most`, of what follows a and b, by galloping over range hashes."""
    sums = blocks.prefix_sums(blocks.BYTE_VALUES[text])
    got = np.zeros(len(a), np.int64)
    top = 1 << min(max(int(most.max(initial=1)).bit_length() - 1, 0), 12)
    # lengths over 4096 are rare: on as long as blocks of 4096 agree
    todo = np.arange(len(a))
    while len(todo):
        todo = todo[got[todo] + top <= most[todo]]
        x, y = a[todo] + got[todo], b[todo] + got[todo]
        todo = todo[blocks.range_hashes(sums, x, x + top) == blocks.range_hashes(sums, y, y + top)]
        got[todo] += top
    size = top // 2
    while size:
        fits = np.flatnonzero(got + size <= most)
        x, y = a[fits] + got[fits], b[fits] + got[fits]
        fits = fits[blocks.range_hashes(sums, x, x + size) == blocks.range_hashes(sums, y, y + size)]
        got[fits] += size
        size //= 2
    return got


def mark_windows(parts: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, last) of the runs of windows that start elsewhere too."""
    index = RunLengthIndex(parts, weights, length)
    hit = index.matching_statistics() >= length
    turn = hit.copy()
    turn[1:] &= ~hit[:-1] | (index.at[1:] == 0)
    lo = np.flatnonzero(turn)
    stop = hit.copy()
    stop[:-1] &= ~hit[1:] | (index.at[1:] == 0)
    return index.part[lo], index.at[lo], index.at[np.flatnonzero(stop)]


def find_repeats(docs: DataFrame, length: int = 200, k: int = 48, text: str = "text", doc_id: str = "doc_id", bucket_bytes: int = 1 << 19, hot_bytes: int = 1 << 20, hot_rows: int = 20_000, broadcast_keys: int = 100_000) -> DataFrame:
    """(doc_id, copy, spans): the byte ranges of each text that repeated strings cover, as [first, last window] places."""
    picked = _keyed(docs, text, doc_id)
    kind = picked.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in blocks.sliced(batches, "text"):
            doc, at, n, key, seg = segments(batch.column(2), length, k)
            own = pa.array(doc)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key), pa.array(seg)], names=["doc_id", "copy", "at", "n", "key", "seg"])

    rows = picked.mapInArrow(cut, f"doc_id {kind}, copy long, at int, n int, key long, seg long")
    again = blocks.cut(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    rows, dealt_keys = blocks.salted(rows, again, "key", "c", ["doc_id", "copy", "at"], hot_rows)
    rows = blocks.cut(rows.join(dealt_keys, ["key", "salt"]).drop("c"))
    each = ["doc_id", "copy", "at", "n"]
    kinds = blocks.cut(rows.groupBy("key", "seg").agg(F.count("*").alias("weight"), *[F.first(c).alias(c) for c in each]))
    total = kinds.agg(F.sum(F.col("n") + (length - 1))).first()[0] or 0
    buckets = max(1, int(total // bucket_bytes))
    wide = kinds.groupBy("key").agg(F.sum(F.col("n") + (length - 1)).alias("bytes")).where(F.col("bytes") > hot_bytes).select(F.col("key").alias("wide"))
    n_wide = wide.count()
    kinds = kinds.join(F.broadcast(wide) if n_wide <= broadcast_keys else wide, kinds["key"] == wide["wide"], "left").withColumn("hot", F.col("wide").isNotNull())
    wanted = kinds.groupBy(F.col("doc_id").alias("id_"), F.col("copy").alias("copy_")).agg(F.collect_list(F.struct("key", "seg", "weight", "at", "n", "hot")).alias("reps"))
    held = picked.join(wanted, picked["doc_id"].eqNullSafe(wanted["id_"]) & (picked["copy"] == wanted["copy_"])).select("text", "reps")  # identical rows come twice: their segments do repeat

    def fetch(batches):
        for batch in blocks.sliced(batches, "text"):
            data, starts, ends = blocks.separated(batch.column(0), SEPARATOR)
            reps = batch.column(1)
            count, flat = reps.value_lengths().to_numpy(), reps.flatten()
            key, seg, weight, at, n, hot = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(6)]
            at = at + np.repeat(starts, count)
            raw, one = data.tobytes(), np.flatnonzero(~hot)
            yield _parts(key[one], seg[one], np.zeros(len(one), np.int32), weight[one], key[one], False, pa.array([raw[a:b] for a, b in zip(at[one].tolist(), (at + n - 1 + length)[one].tolist())], pa.binary()))
            if hot.any():
                sums = blocks.prefix_sums(blocks.BYTE_VALUES[data])
                for some in np.array_split(np.flatnonzero(hot), -(-int(n[hot].sum()) // (1 << 16))):
                    off = np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
                    of = np.repeat(some, n[some])
                    w = at[of] + off
                    yield _parts(key[of], seg[of], off.astype(np.int32), weight[of], blocks.range_hashes(sums, w, w + length).view(np.int64), True, pa.nulls(len(of), pa.binary()))

    parts = held.mapInArrow(fetch, "key long, seg long, off int, weight long, route long, hot boolean, bytes binary")
    if n_wide:
        parts = blocks.cut(parts)

    def scan(pdf):
        pdf = pdf.drop_duplicates(["key", "seg"], ignore_index=True)  # rows fetched twice, from identical texts
        part, lo, hi = mark_windows(pdf["bytes"].tolist(), pdf["weight"].to_numpy(), length)
        return pdf[["key", "seg"]].iloc[part].assign(lo=lo, hi=hi)

    dealt = parts.where("not hot").select("key", "seg", "weight", "bytes", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    marks = dealt.groupBy("bucket").applyInPandas(scan, "key long, seg long, lo long, hi long")
    if n_wide:
        windows = parts.where("hot").dropDuplicates(["key", "seg", "off"])
        # windows of hot keys: counted by hash, only those met again are repeats
        often = windows.groupBy("route").agg(F.sum("weight").alias("total")).where("total > 1").select("route")
        marks = marks.unionByName(windows.join(often, "route").select("key", "seg", F.col("off").cast("long").alias("lo"), F.col("off").cast("long").alias("hi")))
    # the texts fetched for the index are done with before all texts travel once more
    marks = blocks.cut(marks)
    blocks.free(docs.sparkSession)
    # marks of hot keys go to each of the keys' salts, their rows to one
    placed = rows.drop("n").join(marks.join(dealt_keys.select("key", "salt"), "key"), ["key", "seg", "salt"]).select("doc_id", "copy", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
    return placed.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _parts(key, seg, off, weight, route, hot: bool, raw) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(seg), pa.array(off), pa.array(weight), pa.array(route), pa.array(np.full(len(key), hot)), raw], names=["key", "seg", "off", "weight", "route", "hot", "bytes"])


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, copy, text): copy is a hash of the text."""
    return docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("copy"), docs[text].alias("text"))


def remove_repeats(docs: DataFrame, length: int = 200, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True, **limits) -> DataFrame:
    """For every row (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): kept is the bytes that stay."""
    keyed = _keyed(docs, text, doc_id)
    spans = find_repeats(docs, length, text=text, doc_id=doc_id, **limits).withColumnRenamed("doc_id", "id_").withColumnRenamed("copy", "copy_")
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(spans["id_"]) & (keyed["copy"] == spans["copy_"]), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            data, starts, ends = blocks.separated(batch.column(1), SEPARATOR)
            found = batch.column(2)
            base = np.repeat(starts, np.nan_to_num(found.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            flat = found.flatten()
            lo, hi = [flat.field(i).to_numpy() + base for i in range(2)]
            step = np.bincount(lo, minlength=len(data) + 1) - np.bincount(hi + length, minlength=len(data) + 1)
            gone = np.cumsum(step)[: len(data)] > 0  # never a separator, as windows end before it
            first, last = blocks.runs(gone)
            doc = np.searchsorted(starts, first, side="right") - 1
            n = len(starts)
            removed, times = np.bincount(doc, last - first, n).astype(np.int64), np.bincount(doc, minlength=n)
            stay = ~gone
            left = [data[s:e][stay[s:e]].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - starts), pa.array(removed), pa.array(times.astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()), pa.array(left if keep_text else [None] * n, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
