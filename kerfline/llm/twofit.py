"""Packing whole documents into few sequences: best-two-fit.

A bin is filled greedily, each time by the largest unpacked document that fits. Then its
smallest document is taken out again if two unpacked ones together fit the gap that this
leaves more tightly; of all such pairs the largest sum is taken. Sizes are small whole
numbers, so what is unpacked is a count for each size and one bit for each size that is
left: the largest that fits and the best pair are found by shifts of those bits.

Only documents longer than a sequence are cut, into full pieces and a rest. Pieces are
dealt at random to groups of bounded size, and each group is packed on its own.

Defined cases: a null or empty text is the closing id alone; pieces of equal size are taken
by id, start and checksum; repeated rows are packed each on its own; a null id is kept; a
very long text is read whole; other columns are not looked at; an empty table gives no
pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packing

CLOSING = 0


def _best_pair(left: int, mirrored: int, counts: list[int], least: int, most: int) -> tuple[int, int] | None:
    """The sizes a >= b left with the largest sum above least and at most `most`."""
    top = len(counts) - 1
    for total in range(most, least, -1):
        both = left & (mirrored >> (top - total))  # bit a where sizes a and total - a are left
        if both:
            a = both.bit_length() - 1
            if 2 * a > total or counts[a] > 1:
                return a, total - a
    return None


def best_two_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each piece, for pieces given from the longest on and none longer than the capacity."""
    counts, places = [0] * (capacity + 1), {}
    for k, size in enumerate(sizes):
        counts[size] += 1
        places.setdefault(size, []).append(k)
    for same in places.values():
        same.reverse()  # the first is taken first
    left = sum(1 << s for s in places)
    mirrored = sum(1 << (capacity - s) for s in places)
    out, packed, number = [0] * len(sizes), 0, 0

    def take(size: int, by: int) -> None:
        nonlocal left, mirrored
        counts[size] -= by
        if counts[size] == (0 if by > 0 else 1):
            left ^= 1 << size
            mirrored ^= 1 << (capacity - size)

    while packed < len(sizes):
        gap, content = capacity, []
        while fitting := left & ((2 << gap) - 1):
            size = fitting.bit_length() - 1
            take(size, 1)
            content.append(size)
            gap -= size
        if gap and len(content) > 1 and left:
            pair = _best_pair(left, mirrored, counts, content[-1], gap + content[-1])
            if pair:
                take(content.pop(), -1)
                for size in pair:
                    take(size, 1)
                content += pair
        for size in content:
            out[places[size].pop()] = number
        packed, number = packed + len(content), number + 1
    return out


def pack(docs: DataFrame, path: str, length: int = 2048, group_rows: int = 16384, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece; groups hold about group_rows pieces each."""
    cut = packing.pieces(docs, path, length, text, doc_id, CLOSING)
    packed = packing.filled(packing.dealt(cut, group_rows), best_two_fit, length)
    return packed.withColumn("piece", F.expr(f"int(start div {length})"))
