"""Vectorised helpers that the text operators share.

Texts reach Python as Arrow columns. They are cut into blocks of bounded size, laid
end to end as UTF-8 bytes with one separator byte after each, and handled by
numpy, so that a worker's memory depends on the block size and the longest single
text, not on the number of rows.
"""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once; a longer single text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Rows that travel to a worker at once, where the session names no other number than Spark's own.
BATCH_ROWS = 1000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the rolling base (or of its inverse) modulo 2**64."""
    if len(_powers[inverse]) < n:
        p = np.full(max(n, BLOCK_BYTES + 4096), _INVERSE if inverse else _BASE, np.uint64)
        p[0] = 1
        _powers[inverse] = np.cumprod(p, dtype=np.uint64)
    return _powers[inverse][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit value for each byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums S with S[j] - S[i] identifying values[i:j] up to its place."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:], dtype=np.uint64)
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end], equal for equal content anywhere."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def separated(column, separator: int = 10) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends): the texts with one separator byte after each."""
    data, off = utf8(column)
    n = len(off) - 1
    out = np.full(len(data) + n, separator, np.uint8)
    starts = off[:-1] + np.arange(n)
    ends = off[1:] + np.arange(n)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = data
    return out, starts, ends


#: What operators keep in a worker from task to task: a function for each that lets go of it.
KEPT: dict[str, Callable[[], None]] = {}


def sliced(batches, column: str, limit: int | None = None, keep: str = ""):
    """Yields record batches of about `limit` bytes of the named text column; what other operators than `keep` left in the worker goes first."""
    limit = limit or BLOCK_BYTES
    for name in [n for n in KEPT if n != keep]:
        KEPT.pop(name)()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        done = np.cumsum(sizes + 1)
        at = 0
        while at < len(sizes):
            before = done[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(done, before + limit, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    release()


def _libc(name: str, *arguments: int) -> None:
    if sys.platform == "linux":
        call = getattr(ctypes.CDLL(None), name, None)
        if call is not None:
            call(*arguments)


# Arrays of a block's size are taken from the heap again and again, not mapped anew each
# time (M_MMAP_THRESHOLD and M_TRIM_THRESHOLD); release() gives all of it back.
_libc("mallopt", -3, 1 << 23)
_libc("mallopt", -1, 1 << 24)


def release() -> None:
    """Gives freed memory back, as a worker stays on for later tasks of other stages."""
    pa.default_memory_pool().release_unused()
    _libc("malloc_trim", 0)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def small_batches(df: DataFrame) -> None:
    """Lets fewer rows travel at once, as a batch of texts is held by the JVM and by the worker."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(BATCH_ROWS))


def only(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever else there is."""
    return docs.select(*[docs[c] for c in columns])


def bucket_of(column, parts: int):
    """crc32 of the value as text, modulo parts (the folds of the labelled rows)."""
    return F.crc32(column.cast("string").cast("binary")) % parts


def _shared(spark: SparkSession) -> str:
    """The folder that the session names; one of this machine only where the session has no other machines."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{tempfile.gettempdir()}/checkpoints/kerfline"


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{_shared(spark)}/kerfline-{uuid.uuid4().hex}"


def free(spark: SparkSession) -> None:
    """Lets go of the shuffle files of plans that nothing refers to any more.

    Spark removes them when the driver's memory is looked through, which may else be late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that lost executors cost no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared(df.sparkSession))
    free(df.sparkSession)
    return df.checkpoint(eager=True)


def salted(rows: DataFrame, kinds: DataFrame, key: str, count: str, by: list[str], hot_rows: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """rows and kinds with a column salt: rows of a hot key are dealt to several salts, and kinds has one row for each.

    kinds, which must be cut, has each key once with its number of rows. A key of more than
    hot_rows rows and more than a ten-thousandth of all (so at most ten thousand keys, which
    are broadcast) gets a salt for each such number of rows, at most 64. Rows are dealt by a
    hash of the columns `by`, which have to tell the rows of a key apart.
    """
    most = max(hot_rows, (kinds.agg(F.sum(count)).first()[0] or 0) // 10_000)
    n = F.least(F.ceil(F.col(count) / most), F.lit(64)).cast("int")
    hot = F.broadcast(kinds.where(F.col(count) > most).select(key, n.alias("salts_")))
    dealt = kinds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col(count) > most, n - 1).otherwise(0))))
    salt = F.coalesce(F.pmod(F.xxhash64(*by), F.col("salts_")), F.lit(0)).cast("int")
    return rows.join(hot, key, "left").withColumn("salt", salt).drop("salts_"), dealt


def spread_join(rows: DataFrame, kinds: DataFrame, key: str, count: str, by: list[str], hot_rows: int = 20_000) -> DataFrame:
    """rows joined to kinds by a key, so that no task gets all rows of a hot key; see salted()."""
    rows, dealt = salted(rows, kinds, key, count, by, hot_rows)
    return rows.join(dealt, [key, "salt"]).drop("salt")
