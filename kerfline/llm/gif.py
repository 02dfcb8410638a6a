"""GIF media columns: encode samples, decode LZW streams, compose timed frames.

A payload becomes a 64-pixel wide GIF of 256 colours whose frames of up to FRAME_ROWS
rows follow each other in time, each staying until the next one overwrites it. The decoder
handles any GIF: global and local palettes, interlacing, transparency and the disposal
methods. Timed frames and their colour histograms are columns made from the pictures that
the decoder composes.

Defined cases: null and empty texts are stored as 64 zero bytes; equal texts give equal
media; a very long text gives many frames, of which one picture is held at a time; repeated
rows are stored alike; a null medium has no frames and no payload, one that is no GIF raises
an error; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks

WIDTH, FRAME_ROWS, DELAY = 64, 1024, 4  # DELAY in hundredths of a second
CLEAR, END = 256, 257

def _colours() -> bytes:
    """256 different colours: three bits of red, three of green, two of blue."""
    i = np.arange(256)
    return np.column_stack([(i >> 5) * 255 // 7, (i >> 2 & 7) * 255 // 7, (i & 3) * 85]).astype(np.uint8).tobytes()


PALETTE = _colours()


def lzw_codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """LZW codes of 8-bit samples, beginning with a clear code, and the width of each."""
    out = [CLEAR]
    add, samples = out.append, iter(data)
    table: dict[int, int] = {}
    find = table.get
    size, current = END + 1, next(samples, -1)
    for b in samples:
        key = current << 8 | b
        code = find(key)
        if code is not None:
            current = code
            continue
        add(current)
        current = b
        if size < 4096:
            table[key] = size
            size += 1
        else:
            add(CLEAR)
            table.clear()
            size = END + 1
    if current >= 0:
        add(current)
    add(END)
    codes = np.array(out, np.int64)
    clear = np.flatnonzero(codes == CLEAR)
    at = np.arange(len(codes))
    since = at - clear[np.searchsorted(clear, at, side="right") - 1]
    since[clear[1:]] = np.diff(clear)  # a clear code is as wide as the code that it stands for
    return codes, _widths(8, 4097)[since]


@lru_cache(maxsize=64)
def _widths(bits: int, n: int) -> np.ndarray:
    """Width of the k-th code after a clear code, for k from 0 to n - 1.

    Each code but the first adds an entry to the reader's table, and codes widen as soon
    as the next free entry needs one bit more, up to 12.
    """
    free = (1 << bits) + 2 + np.maximum(0, np.arange(n) - 2)
    return np.minimum(12, np.floor(np.log2(free)).astype(np.int64) + 1)


def pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes of the given widths, least significant bit first."""
    start = np.cumsum(widths) - widths
    bit = ((codes[:, None] >> np.arange(12)) & 1).astype(np.uint8)
    used = np.arange(12) < widths[:, None]
    flat = np.zeros(int(widths.sum()), np.uint8)
    flat[(start[:, None] + np.arange(12))[used]] = bit[used]
    return np.packbits(flat, bitorder="little").tobytes()


def unpack(stream: bytes, bits: int) -> np.ndarray:
    """Codes of an LZW stream up to its end code."""
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.int64)
    total, at, out = 8 * len(stream), 0, []
    clear, end = 1 << bits, (1 << bits) + 1
    while True:  # a round for each clear code
        n = 4096
        while True:  # more codes than fill the table, where the writer clears late
            width = _widths(bits, n + 1)[1:]
            here = at + np.cumsum(width) - width
            here = here[: np.searchsorted(here + width, total, side="right")]
            byte = here >> 3
            codes = ((raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (here & 7)) & ((1 << width[: len(here)]) - 1)
            stop = np.flatnonzero((codes == clear) | (codes == end))
            if len(stop) or len(here) < n:
                break
            n *= 4
        if not len(stop):
            return np.concatenate([*out, codes])
        k = int(stop[0])
        if codes[k] == end:
            return np.concatenate([*out, codes[:k]])
        out.append(codes[: k + 1])
        at = int(here[k] + width[k])


def lzw_decode(stream: bytes, bits: int) -> bytes:
    """The samples of an LZW stream with the given minimum code size."""
    clear = 1 << bits
    base: list[bytes] = [bytes([i]) for i in range(clear)] + [b"", b""]
    codes, out = unpack(stream, bits), []
    add = out.append
    for part in np.split(codes, np.flatnonzero(codes == clear)):
        part = part[1:] if len(part) and part[0] == clear else part
        if not len(part):
            continue
        if part[0] > clear:
            raise ValueError("LZW code beyond its table")
        table, rest = base.copy(), part.tolist()
        last = table[rest[0]]
        add(last)
        grow, full = table.append, 4097 - len(base)  # codes up to which the table grows
        for code in rest[1:full]:
            try:
                word = table[code]
            except IndexError:
                if code != len(table):
                    raise ValueError("LZW code beyond its table") from None
                word = last + last[:1]
            grow(last + word[:1])
            add(word)
            last = word
        for code in rest[full:]:
            add(table[code])
    return b"".join(out)


def _blocks(data: bytes) -> bytes:
    """Data in sub-blocks of up to 255 bytes."""
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode(payload: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay: int = DELAY) -> bytes:
    """A GIF with one sample per payload byte; the payload is a positive multiple of width."""
    if not payload or len(payload) % width:
        raise ValueError("payload must be a positive multiple of the width")
    rows = len(payload) // width
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, frame_rows), 0xF7, 0, 0), PALETTE]
    for first in range(0, rows, frame_rows):
        part = payload[first * width : (first + frame_rows) * width]
        # disposal 1: the frame stays until the next one overwrites it
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0), b"\x08", _blocks(pack(*lzw_codes(part)))]
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    samples: np.ndarray  # palette indices of the frame's own rectangle
    left: int
    top: int
    at: int  # hundredths of a second from the start
    delay: int
    disposal: int
    transparent: int | None
    palette: np.ndarray
    canvas: np.ndarray  # the whole picture while the frame shows: red, green, blue and alpha in the bytes of a 32-bit word; only until the next frame is asked for

    def rgba(self) -> np.ndarray:
        return self.canvas.view(np.uint8).reshape(*self.canvas.shape, 4)


def _packed(colours: np.ndarray) -> np.ndarray:
    """Opaque 32-bit colours of a palette's bytes."""
    rgb = colours.reshape(-1, 3).astype("<u4")
    return rgb[:, 0] | rgb[:, 1] << 8 | rgb[:, 2] << 16 | np.uint32(0xFF000000)


def _sub_blocks(media: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := media[at]:
        parts.append(media[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def decode(media: bytes, most_pixels: int = 1 << 26) -> Iterator[Frame]:
    """The timed frames, with the whole picture at each after palettes, transparency and disposal; a picture of more pixels than that is an error."""
    if media[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", media, 6)
    if width * height > most_pixels:
        raise ValueError(f"a picture of {width} by {height} is too large")
    at, own, clock = 13, None, 0
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        own, at = np.frombuffer(media, np.uint8, n, at), at + n
    delay, disposal, transparent = 0, 0, None
    canvas = np.zeros((height, width), "<u4")  # transparent before anything is drawn
    while at < len(media) and (kind := media[at]) != 0x3B:
        if kind == 0x21:
            label = media[at + 1]
            data, at = _sub_blocks(media, at + 2)
            if label == 0xF9:
                bits, delay, index = struct.unpack("<BHB", data[:4])
                disposal, transparent = bits >> 2 & 7, index if bits & 1 else None
        elif kind == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", media, at + 1)
            at, palette = at + 10, own
            if bits & 0x80:
                n = 3 << ((bits & 7) + 1)
                palette, at = np.frombuffer(media, np.uint8, n, at), at + n
            size = media[at]
            data, at = _sub_blocks(media, at + 1)
            samples = np.frombuffer(lzw_decode(data, size)[: w * h], np.uint8)
            if len(samples) < w * h:
                raise ValueError("a frame ends early")
            samples = samples.reshape(h, w)
            if bits & 0x40:  # interlaced: rows 0, 8, ..; 4, 12, ..; 2, 6, ..; 1, 3, ..
                order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
                samples = samples[np.argsort(order)]
            area = canvas[top : top + h, left : left + w]
            before = area.copy() if disposal == 3 else None
            inside = samples[: area.shape[0], : area.shape[1]]
            drawn = _packed(palette)[inside]
            area[:] = drawn if transparent is None else np.where(inside == transparent, area, drawn)
            yield Frame(samples, left, top, clock, delay, disposal, transparent, palette.reshape(-1, 3), canvas)
            if disposal == 2:
                area[:] = 0
            elif disposal == 3:
                area[:] = before
            clock += delay
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError("unknown block")


def histogram(canvas: np.ndarray) -> np.ndarray:
    """How many of a picture's visible pixels have each colour, told by two bits of red, of green and of blue (the highest first)."""
    seen = canvas[canvas >= np.uint32(0x80000000)]
    return np.bincount((seen >> 6 & 3) << 4 | (seen >> 14 & 3) << 2 | (seen >> 22 & 3), minlength=64)


def store(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", frame_rows: int = FRAME_ROWS) -> DataFrame:
    """(doc_id, n_bytes, media) for every row."""

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            data, off = blocks.utf8(batch.column(1))
            raw, media, seen = data.tobytes(), [], {}
            for s, e in zip(off[:-1], off[1:]):
                body = raw[s:e]
                if body not in seen:
                    seen[body] = encode(body + b"\0" * ((-len(body)) % WIDTH if body else WIDTH), frame_rows=frame_rows)
                media.append(seen[body])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


FRAMES = "array<struct<index:int,at_ms:long,width:int,height:int,disposal:int,colours:array<struct<colour:int,pixels:long>>>>"


def read_back(media: bytes) -> tuple[bytes, list[dict]]:
    """The payload that a stored medium holds, its frames' samples, and the timed frames with the colours of the picture that each shows."""
    payload, frames = [], []
    for i, f in enumerate(decode(media)):
        payload.append(f.samples.tobytes())
        counts = histogram(f.canvas)
        at = np.flatnonzero(counts)
        frames.append({"index": i, "at_ms": 10 * f.at, "width": f.samples.shape[1], "height": f.samples.shape[0], "disposal": f.disposal, "colours": [{"colour": c, "pixels": n} for c, n in zip(at.tolist(), counts[at].tolist())]})
    return b"".join(payload), frames


def digests(stored: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, frames) from what a decoder reads out of the stored media.

    The feature is the number of frames, and a hash of all that their pictures show: times,
    sizes and colour histograms.
    """
    kind = pa.list_(pa.struct([("index", pa.int32()), ("at_ms", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("disposal", pa.int32()), ("colours", pa.list_(pa.struct([("colour", pa.int32()), ("pixels", pa.int64())])))]))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), kind]

    def run(batches):
        for batch in blocks.sliced(batches, "media"):
            rows = []
            for media in batch.column(1).to_pylist():
                if media is None:
                    rows.append((None,) * 7)
                    continue
                payload, frames = read_back(media)
                shown = ";".join(f"{f['at_ms']},{f['width']},{f['height']}:" + ",".join(f"{c['colour']}={c['pixels']}" for c in f["colours"]) for f in frames)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"frames={len(frames)};shown={zlib.crc32(shown.encode()):08x}", frames))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames"])

    picked = stored.select("doc_id", "media", "n_bytes")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames {FRAMES}")
