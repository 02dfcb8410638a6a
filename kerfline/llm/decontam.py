"""Benchmark decontamination: q-gram lemma filtering, then banded alignment.

An item of m characters that occurs in a text with at most k edits shares with it at
least m - q + 1 - k*q of its q-grams, on at most k + 1 neighbouring diagonals. Shared
q-grams are therefore counted in overlapping bands of diagonals, regions that reach the
bound are kept, and a banded alignment decides.

Both sides are folded first: ASCII letters to lower case, each run of ASCII characters
that are neither letters nor digits to one space, and each character outside ASCII is one
too, so that edits are counted in characters. q-grams have one byte for each character:
those up to U+00FF have one of their own, others share 128, which can only let more regions
through; the alignment compares whole code points.

Defined cases: null and empty texts and items match nothing, nor do items of fewer than
q folded characters; items too short for the lemma at the given rate get the largest edit
budget for which it still holds; repeated items match each on its own; of several places
of an item in a text the one with the fewest edits counts; repeated rows are judged alike;
a very long text is searched whole, in steps of bounded memory even where it repeats one
q-gram over and over; empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks

Q = 8  # characters of a q-gram: one byte each, one 64-bit word
#: Shared q-grams, and cells of alignment rows, that are held at once.
STEP = 1 << 20
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:192] = 0  # the second and later bytes of a character
_FOLD[192:] = 255


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The characters of two to four bytes that begin at these places."""
    lead, out = data[at].astype(np.uint32), np.zeros(len(at), np.uint32)
    for size, bits in ((2, 31), (3, 15), (4, 7)):
        of = np.flatnonzero((lead >= (0, 0, 192, 224, 240)[size]) & (lead < (0, 0, 224, 240, 256)[size]))
        code = lead[of] & bits
        for k in range(1, size):
            code = code << 6 | (data[at[of] + k] & 63)
        out[of] = code
    return out


def fold(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a byte for each folded character, starts, ends, the characters themselves) of the texts laid end to end; bytes and characters are one where none is beyond U+00FF."""
    data, starts, ends = blocks.separated(column, 32)
    low = _FOLD[data]
    space = low == 32
    keep = low != 0
    keep[1:] &= ~(space[1:] & space[:-1])
    if len(starts):
        keep[starts] &= ~space[starts]
    lead = np.flatnonzero(low == 255)
    if len(lead):
        # the last six bits and one more tell the characters up to U+00FF apart
        size = 1 + (data[lead] >= 224).astype(np.int64) + (data[lead] >= 240)
        low[lead] = 128 | (data[lead + size - 1] << 6 & 64) | (data[lead + size] & 63)
        low[low == 255] = 127  # 255 stands for no text
    codes, beyond = None, lead[data[lead] >= 0xC4]
    if len(beyond):
        codes = low.astype(np.uint32)
        codes[beyond] = _code_points(data, beyond)
    at = np.concatenate(([0], np.cumsum(keep)))
    lo, hi = at[starts], at[ends]
    # no trailing space
    out = low[keep]
    tail = hi > lo
    hi = np.where(tail & (out[np.maximum(hi - 1, 0)] == 32), hi - 1, hi) if len(out) else hi
    return out, lo, hi, out if codes is None else codes[keep]


def qgrams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one integer."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    g = data.astype(np.uint64)
    g = g[:-1] | g[1:] << np.uint64(8)
    g = g[:-2] | g[2:] << np.uint64(16)
    return g[:-4] | g[4:] << np.uint64(32)


class BenchmarkIndex:
    """q-grams of a bounded set of items."""

    def __init__(self, ids: list, texts: list, rate: float):
        self.ids, self.items, self.budget, self.need = [], [], [], []
        grams, item, place = [], [], []
        for i, t in zip(ids, texts):
            data, lo, hi, codes = fold(pa.array([t], pa.string()))
            body, codes = data[lo[0] : hi[0]], codes[lo[0] : hi[0]]
            if len(body) < Q:
                continue
            m = len(body)
            k = min(int(rate * m), (m - Q) // Q)
            g = qgrams(body)
            grams.append(g)
            item.append(np.full(len(g), len(self.items), np.int64))
            place.append(np.arange(len(g)))
            self.ids.append(i)
            self.items.append(codes)
            self.budget.append(k)
            self.need.append(m - Q + 1 - k * Q)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        grams, item, place = join(grams, np.uint64), join(item, np.int64), join(place, np.int64)
        order = np.argsort(grams, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.budget, self.need = np.array(self.budget, np.int64), np.array(self.need, np.int64)
        self.longest = max((len(x) for x in self.items), default=0)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self._cell(self.grams)] = True

    @staticmethod
    def _cell(g: np.ndarray) -> np.ndarray:
        return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def _shared(self, column) -> tuple:
        """Characters of the folded texts, their starts and ends, and (place, q-gram, text) of each of their q-grams that an item has too."""
        none = np.zeros(0, np.int64)
        data, lo, hi, codes = fold(column)
        if not len(self.grams):
            return codes, lo, hi, none, none, none
        g = qgrams(data)
        at = np.flatnonzero(self.maybe[self._cell(g)])
        g = g[at]
        k = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        same = self.grams[k] == g
        at, k = at[same], k[same]
        doc = np.searchsorted(lo, at, side="right") - 1
        inside = at + Q <= hi[doc]
        return codes, lo, hi, at[inside], k[inside], doc[inside]

    def _expanded(self, at: np.ndarray, k: np.ndarray, doc: np.ndarray):
        """Yields (item, diagonal, text) of the shared q-grams, STEP or so at a time."""
        n = self.count[k]
        cuts = np.unique(np.append(np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), STEP)), len(k)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            size = n[a:b]
            which = np.repeat(self.first[k[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield self.item[which], np.repeat(at[a:b], size) - self.place[which], np.repeat(doc[a:b], size)

    def search(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, edits) of every item found in every text, with the fewest edits."""
        none = np.zeros(0, np.int64)
        data, lo, hi, at, k, doc = self._shared(column)
        if not len(at):
            return none, none, none
        kinds = len(self.items)
        # pairs of a text and an item that share enough q-grams on any diagonals
        pair, count = _counted((owner * kinds + item for item, _, owner in self._expanded(at, k, doc)), kinds * len(lo))
        pair = pair[count >= self.need[pair % kinds]]
        if not len(pair):
            return none, none, none
        # and then in one band of two steps; bands overlap by one step
        bands = (len(data) + self.longest) // (int(self.budget.min()) + 1) + 3

        def banded_pairs():
            for item, diagonal, owner in self._expanded(at, k, doc):
                of = np.searchsorted(pair, owner * kinds + item)
                own = np.flatnonzero(pair[np.minimum(of, len(pair) - 1)] == owner * kinds + item)
                band = (diagonal[own] + self.longest) // (self.budget[item[own]] + 1)
                yield np.append(of[own] * bands + band, of[own] * bands + band + 1)  # band b begins a step before b

        key, count = _counted(banded_pairs(), bands * len(pair))
        item, owner = pair[key // bands] % kinds, pair[key // bands] // kinds
        good = count >= self.need[item]
        item, owner = item[good], owner[good]
        budget = self.budget[item]
        low = (key[good] % bands - 1) * (budget + 1) - self.longest  # the first diagonal of the band
        edits = self._aligned(item, data, low - budget, lo[owner], hi[owner], 2 * (budget + 1) + 2 * budget)
        ok = edits <= budget
        item, owner, edits = item[ok], owner[ok], edits[ok]
        order = np.lexsort((edits, item, owner))
        item, owner, edits = item[order], owner[order], edits[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (owner[1:] != owner[:-1])
        return owner[new], item[new], edits[new]

    def _aligned(self, item, data, low, start, end, width) -> np.ndarray:
        """Fewest edits between each item and any part of data[start:end] on its diagonals low .. low + width."""
        size = np.array([len(self.items[i]) for i in item], np.int64)
        out, order, done = np.zeros(len(item), np.int64), np.argsort(-size, kind="stable"), 0
        while done < len(order):
            longest = int(size[order[done]])
            of = order[done : done + max(1, STEP // (longest + int(width[order[done:]].max())))]
            out[of] = banded([self.items[i] for i in item[of]], data, low[of], start[of], end[of], int(width[of].max()))
            done += len(of)
        return out


def _counted(parts, space: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, rising, of arrays of keys under `space`, and how often each occurs."""
    if space <= STEP:
        total = np.zeros(space, np.int64)
        for keys in parts:
            total += np.bincount(keys, minlength=space)
        at = np.flatnonzero(total)
        return at, total[at]
    keys, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in parts:
        new, n = np.unique(part, return_counts=True)
        keys, of = np.unique(np.append(keys, new), return_inverse=True)
        count = np.bincount(of, np.append(count, n), len(keys)).astype(np.int64)
    return keys, count


def banded(items: list[np.ndarray], data: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Fewest edits between each item and any part of data[start:end] on the diagonals low .. low + width; longest items first."""
    size = np.array([len(x) for x in items])
    wanted = np.zeros((len(items), size[0]), np.uint32)
    for i, x in enumerate(items):
        wanted[i, : len(x)] = x
    place = low[:, None] + np.arange(size[0] + width + 1)
    inside = (place >= start[:, None]) & (place < end[:, None])
    text = np.where(inside, data[np.minimum(np.maximum(place, 0), len(data) - 1)], data.dtype.type(255))  # 255 is in no text
    row = -np.broadcast_to(np.arange(width + 1, dtype=np.int32), (len(items), width + 1))  # less the place in the band; an occurrence may begin anywhere
    out = np.zeros(len(items), np.int64)
    active = len(items)
    for i in range(size[0]):
        still = int(np.searchsorted(-size, -i))  # items that have a character i
        if still < active:
            out[still:active] = (row[still:] + np.arange(width + 1)).min(axis=1)
            row, active = row[:still], still
        nxt = row + (text[:active, i : i + width + 1] != wanted[:active, i : i + 1])
        np.minimum(nxt[:, :-1], row[:, 1:] + 2, out=nxt[:, :-1])
        row = np.minimum.accumulate(nxt, axis=1)
    out[:active] = (row + np.arange(width + 1)).min(axis=1)
    return out


def indexes(benchmark: DataFrame, rate: float = 0.1, text: str = "text", item_id: str = "item_id", block_mb: float = 8.0):
    """Yields (index, whether it is the only one) of the items in blocks of about block_mb of text each; one block is in the driver at a time."""
    picked = benchmark.select(benchmark[item_id].alias("id"), benchmark[text].alias("text"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, int(-(-size // (block_mb * 1e6))))
    for b in range(n):
        rows = picked.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect() if n > 1 else picked.collect()
        rows = sorted(rows, key=lambda r: (r["id"] is not None, r["id"] if r["id"] is not None else 0, r["text"] or ""))
        yield BenchmarkIndex([r["id"] for r in rows], [r["text"] for r in rows], rate), n == 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", block_mb: float = 8.0) -> DataFrame:
    """(doc_id, item_id, edits, budget, item_characters) for every item found in a row's whole text."""
    blocks.small_batches(docs)
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kinds, id_type = (picked.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()), to_arrow_type(benchmark.schema[item_id].dataType)
    parts = []
    for index, only in indexes(benchmark, rate, item_text, item_id, block_mb):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own = shared.value
            for batch in blocks.sliced(batches, "text"):
                doc, item, edits = own.search(batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), pa.array([own.ids[i] for i in item], id_type), pa.array(edits, pa.int64()), pa.array(own.budget[item] if len(item) else [], pa.int64()), pa.array([len(own.items[i]) for i in item], pa.int64())], names=["doc_id", "item_id", "edits", "budget", "item_characters"])

        part = picked.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, edits long, budget long, item_characters long")
        parts.append(part if only else _written(part, shared))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _written(df: DataFrame, shared) -> DataFrame:
    """The rows cut, and the block that they needed let go before the next one comes."""
    out = blocks.cut(df)
    shared.destroy()
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, text: str = "text", item_text: str = "text", item_id: str = "item_id", block_mb: float = 8.0) -> DataFrame:
    """The rows, with all their columns, in which no item is found."""
    for index, only in indexes(benchmark, rate, item_text, item_id, block_mb):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in blocks.sliced(batches, text):
                doc, _, _ = shared.value.search(batch.column(batch.schema.get_field_index(text)))
                keep = np.ones(batch.num_rows, bool)
                keep[doc] = False
                yield batch.filter(pa.array(keep, pa.bool_()))

        kept = docs.mapInArrow(run, docs.schema)
        docs = kept if only else _written(kept, shared)
    return docs
