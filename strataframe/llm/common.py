"""Helpers shared by the text operators: shared scratch tables and byte-level text views."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataframe.session import checkpoint_dir

#: Bytes of text that one vectorised step looks at (a longer text is a step of its own).
CHUNK_BYTES = 2 << 20


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``, which every executor
    and the driver share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: What the open ``noted`` blocks have noted so far.
_NOTED: list[list[str]] = []


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` writes inside the block, in order."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED.pop()


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``written`` wrote and that nothing will read again, in whatever store they are."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a shared table and read back: cuts the lineage, survives the loss of
    executors, and gives the planner the true size of the table."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    for paths in _NOTED:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, padded by eight zero bytes, and the
    n + 1 offsets of its rows. A null is an empty text."""
    raw, offsets = _bytes(column)
    return np.concatenate([raw, np.zeros(8, np.uint8)]), offsets


def text_steps(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, padded bytes, offsets) of steps of about ``size`` bytes: what
    ``flat_text`` gives for these rows, without a copy of the whole column."""
    raw, offsets = _bytes(column)
    for a, b in chunks(offsets, size):
        yield a, b, np.concatenate([raw[offsets[a]:offsets[b]], np.zeros(8, np.uint8)]), offsets[a:b + 1] - offsets[a]
    give_back()


def give_back() -> None:
    """Return freed memory to the system. Python workers live on between tasks, beside their
    executor's heap, and would keep the most that any batch has needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, each of at least one row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(stop, n)
        row = stop


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def words_at(raw: np.ndarray) -> np.ndarray:
    """View of the eight bytes that begin at each place, little-endian."""
    return np.ndarray((max(len(raw) - 7, 0),), np.dtype("<u8"), raw, 0, (1,))


def token_runs(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
    """Maximal runs of bytes of one class above 0 inside each row.

    Returns (start, end, row, class) of the runs in order; ``raw`` is padded, ``offsets``
    count from 0.
    """
    n = int(offsets[-1])
    kind = classes[raw[:n]]
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    use = kind[start] > 0
    start, end = start[use], end[use]
    return start, end, np.searchsorted(offsets, start, "right") - 1, kind[start]


def run_hashes(raw: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte run raw[start : start + length]."""
    view = words_at(raw)
    h = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    left, at = length.astype(np.int64), start.astype(np.int64)
    which = np.arange(len(start))
    while len(which):
        word = view[at]
        short = left < 8
        keep = (np.uint64(1) << (np.where(short, left, 0).astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        word = np.where(short, word & keep, word)
        h[which] = mix64((h[which] ^ word) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(0x2545F4914F6CDD1D))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (doubling: log2(width) passes)."""
    out, span = x, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_min(~x, width)
