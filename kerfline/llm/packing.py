"""Packing token pieces into sequences: first-fit decreasing over a tournament tree.

Texts become token ids by a public tokenizer, closed by the id 1, and are cut into
pieces of at most `length` ids. Pieces are dealt to groups by a hash, and each group is
packed on its own: the longest piece first, into the first bin with room, found by
walking down a tree whose nodes hold the largest free capacity below them.

Defined cases: a null or empty text is the single id 1; equal pieces are ordered by id,
start and checksum; repeated rows are packed each on its own; a null id is kept; a very
long text is read whole, and its pieces are dealt to as many groups as their number asks
for; other columns are not looked at; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

CLOSING = 1
#: White space as the tokenizer's own patterns define it: it always parts words and is never a token.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters that stay one letter in lower case and in composed form.
_LETTER = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u017f\\u0410-\\u044f"
#: A chunk: a run of letters before white space or an ASCII mark, else all up to white space.
_CHUNK = re.compile(f"[{_LETTER}]++(?![^{_SPACE}!-/:-@\\[-`{{-~])|[^{_SPACE}]+")
_WORD = re.compile(f"[{_LETTER}]+")
_tokenizers: dict[str, "CachedTokenizer"] = {}


class CachedTokenizer:
    """Ids of whole texts, encoding each distinct chunk once.

    Valid for tokenizers that drop white space, never join across it, and make one word
    of a run of letters. Only chunks that are new are encoded; once more than
    `limit` are remembered, they are forgotten. Where ids tell where a word ends, chunks
    of letters are encoded many at a time and told apart by that.
    """

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.cache = Tokenizer.from_file(path), limit, {}
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [_CHUNK.findall(t) for t in texts]
        if len(self.cache) > self.limit:
            self.cache = {}
        ids = [list(map(self.cache.get, p)) for p in parts]
        holes = [[k for k, v in enumerate(found) if v is None] for found in ids]
        fresh = {p[k] for p, hole in zip(parts, holes) for k in hole}
        words = [w for w in fresh if _WORD.fullmatch(w)] if self.ends.any() else []
        self.cache.update(zip(words, self._joined(words)))
        others = list(fresh.difference(words))
        self.cache.update(zip(others, (np.array(e.ids, "<u4").tobytes() for e in self._encodings(others))))
        for p, found, hole in zip(parts, ids, holes):
            for k in hole:
                found[k] = self.cache[p[k]]
        return [np.frombuffer(b"".join(found), "<u4") for found in ids]

    def _encodings(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _joined(self, words: list[str], at_once: int = 64) -> list[bytes]:
        """Ids of each word, from texts of at_once words."""
        out = []
        for e in self._encodings([" ".join(words[k : k + at_once]) for k in range(0, len(words), at_once)]):
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)]
        if len(out) != len(words):
            raise ValueError("the tokenizer does not make one word of a run of letters")
        return out


def tokenizer(path: str) -> CachedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    blocks.KEPT["packing"] = _tokenizers.clear
    return _tokenizers[path]


def pieces(docs: DataFrame, path: str, length: int = 2048, text: str = "text", doc_id: str = "doc_id", closing: int = CLOSING) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every id of every row, the closing one included, in one piece."""

    def run(batches):
        for batch in blocks.sliced(batches, "text", keep="packing"):
            rows = []
            for k, ids in enumerate(tokenizer(path).encode([t or "" for t in batch.column(1).to_pylist()])):
                raw = ids.tobytes() + closing.to_bytes(4, "little")
                n = len(raw) // 4
                rows += [(k, s, min(length, n - s), zlib.crc32(raw[4 * s : 4 * (s + length)]), n) for s in range(0, n, length)]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    blocks.small_batches(docs)
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long")


class Bins:
    """A tournament tree over bins: each node holds the largest free capacity below it."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1
        while self.leaves < max(most, 1):
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Puts a piece into the first bin that holds it."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bin_ = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            top = max(room[2 * at], room[2 * at + 1])
            if room[at] == top:
                break
            room[at] = top
        return bin_


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each piece, for pieces given from the longest on."""
    bins = Bins(len(sizes), capacity)
    return [bins.place(s) for s in sizes]


def dealt(cut: DataFrame, group_rows: int) -> DataFrame:
    """pieces() with pack_group: dealt at random to groups of about group_rows pieces, equal pieces apart."""
    cut = blocks.cut(cut)  # the places of the rows stay as they are
    groups = max(1, -(-cut.count() // group_rows))
    return cut.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))


def filled(grouped: DataFrame, assign: Callable[[list[int], int], list[int]], length: int) -> DataFrame:
    """dealt() with sequence_id and offset: each group's pieces go into the bins that `assign` names for their sizes, from the longest on."""

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sizes = table.column("length").to_numpy()
        bins = np.array(assign(sizes.tolist(), length), np.int64)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        new = np.concatenate(([True], np.diff(bins[order]) != 0))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(new, before, 0))
        sequence = table.column("pack_group").to_numpy() * (1 << 32) + bins
        return table.drop_columns("pack_group").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grouped.schema if f.name != "pack_group")
    return grouped.groupBy("pack_group").applyInArrow(fill, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, length: int = 2048, group_rows: int = 4096, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """pieces() with sequence_id and offset. Groups hold about group_rows pieces each, however long a document is."""
    return filled(dealt(pieces(docs, path, length, text, doc_id), group_rows), first_fit_decreasing, length)
