"""Substring dedup over sliding spans of consecutive sentences.

Texts are split into sentences, every run of consecutive sentences is hashed, and equal
runs are joined over the whole table. A run has `span` sentences, and as many more as it
takes to hold least_bytes, so that a few short words do not make a run that others have by
chance. The first run, by (doc_id, place), stays; the sentences that any later run covers
are removed.

Defined cases: null texts have no sentences; a text too short for any run is one run as a
whole, equal only to texts of the same sentences; runs may overlap inside one text, and
repeat there; rows with one doc_id are told apart by a hash of the text, and identical rows
(same id, same text) count once and are all cut alike; of equal runs the least (doc_id,
hash of the text, place) is the first, null ids before others; a very long text is handled
whole, as a block of its own; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

LEAST_BYTES = 80
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def sentences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each sentence: cut behind . ! or ? before white space, and at line ends; blank ones are left out.

    A sentence runs up to where the next begins, so that its trailing white space goes with it.
    """
    space = _SPACE[data]
    after = np.concatenate((space[1:], [True]))
    cut = (_STOP[data] & after) | (data == 10)
    # a sentence begins at the first character that is not white space behind a cut
    fresh = np.zeros(len(data), np.int64)
    fresh[1:] = cut[:-1]
    fresh[starts[starts < len(data)]] = 1
    section = np.cumsum(fresh)
    solid = np.flatnonzero(~space)
    begin = solid[np.concatenate(([True], np.diff(section[solid]) > 0))] if len(solid) else solid
    doc = np.searchsorted(starts, begin, side="right") - 1
    end = np.concatenate((begin[1:], [len(data)]))
    return begin, np.minimum(end, ends[doc]), doc


def _runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int, least_bytes: int):
    """(begin, end, text) of the sentences; (stop, hash) of the run that begins at each, stop being -1 where none does; first sentence of each text."""
    begin, end, doc = sentences(data, starts, ends)
    n = len(begin)
    first = np.searchsorted(doc, np.arange(len(starts) + 1))
    if not n:
        return begin, end, doc, begin, np.zeros(0, np.uint64), first
    sums = blocks.prefix_sums(blocks.BYTE_VALUES[data])
    # trailing white space does not count
    last = np.maximum.accumulate(np.where(_SPACE[data], -1, np.arange(len(data))))[end - 1] + 1
    each = blocks.range_hashes(sums, begin, last)
    size = np.append(0, np.cumsum(last - begin))
    stop = np.maximum(np.arange(n) + span, np.searchsorted(size, size[:-1] + least_bytes))
    whole = first[doc + 1]
    # a run that its text has no room for is none, but for a text that is too short for any
    stop = np.where(stop <= whole, stop, np.where(np.arange(n) == first[doc], whole, -1))
    return begin, end, doc, stop, blocks.range_hashes(blocks.prefix_sums(each), np.arange(n), np.maximum(stop, np.arange(n))), first


def spans(docs: DataFrame, span: int = 2, least_bytes: int = LEAST_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, copy, at, hash) of every run; copy is a hash of the text, at its first sentence."""

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            data, starts, ends = blocks.separated(batch.column(2))
            _, _, doc, stop, hashes, first = _runs(data, starts, ends, span, least_bytes)
            k = np.flatnonzero(stop >= 0)
            own = pa.array(doc[k])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array((k - first[doc[k]]).astype(np.int32)), pa.array(hashes[k].view(np.int64))], names=["doc_id", "copy", "at", "hash"])

    picked = _keyed(docs, text, doc_id)
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, copy long, at int, hash long")


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, copy, text): copy is a hash of the text."""
    return docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("copy"), docs[text].alias("text"))


def repeated(docs: DataFrame, span: int = 2, least_bytes: int = LEAST_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, copy, runs): for each text the first sentences of its runs that are not the first of their kind."""
    every = spans(docs, span, least_bytes, text, doc_id)
    # struct order puts nulls first; min and max differ where a run has a second place
    place = F.struct("doc_id", "copy", "at")
    kinds = every.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("c")).where(~F.col("first").eqNullSafe(F.col("last"))).select("hash", "first", "c")
    met = blocks.spread_join(every, blocks.cut(kinds), "hash", "c", ["doc_id", "copy", "at"])
    later = met.where(~F.struct("doc_id", "copy", "at").eqNullSafe(F.col("first"))).select("doc_id", "copy", "at")
    return later.groupBy("doc_id", "copy").agg(F.collect_set("at").alias("runs"))


def remove_repeats(docs: DataFrame, span: int = 2, least_bytes: int = LEAST_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For every row (doc_id, n_bytes, n_sentences, n_removed, removed_bytes, kept_text)."""
    found = repeated(docs, span, least_bytes, text, doc_id).withColumnRenamed("doc_id", "id_").withColumnRenamed("copy", "copy_")
    keyed = _keyed(docs, text, doc_id)
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found["id_"]) & (keyed["copy"] == found["copy_"]), "left").select("doc_id", "text", "runs")

    def cut(batches):
        for batch in blocks.sliced(batches, "text"):
            data, starts, ends = blocks.separated(batch.column(1))
            begin, end, doc, stop, _, first = _runs(data, starts, ends, span, least_bytes)
            hits, n = batch.column(2), len(starts)
            owner = np.repeat(np.arange(n), np.nan_to_num(hits.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            at = first[owner] + hits.flatten().to_numpy()
            step = np.bincount(at, minlength=len(begin) + 1) - np.bincount(stop[at], minlength=len(begin) + 1)
            gone = np.cumsum(step)[: len(begin)] > 0
            step = np.bincount(begin[gone], minlength=len(data) + 1) - np.bincount(end[gone], minlength=len(data) + 1)
            keep = np.cumsum(step)[: len(data)] == 0
            left = [data[s:e][keep[s:e]].tobytes() for s, e in zip(starts, ends)]
            lost = np.bincount(doc[gone], (end - begin)[gone], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - starts), pa.array(np.diff(first)), pa.array(np.bincount(doc[gone], minlength=n).astype(np.int64)), pa.array(lost), pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "n_bytes", "n_sentences", "n_removed", "removed_bytes", "kept_text"])

    return joined.mapInArrow(cut, f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_sentences long, n_removed long, removed_bytes long, kept_text string")
