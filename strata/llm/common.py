"""Helpers shared by the training-data operators: scratch tables, Arrow text buffers, hashing.

Text enters Python as Arrow buffers and is handled as numpy byte arrays, a few megabytes at a
time (``pieces``), so no task holds a Python object per word.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

U64 = np.uint64
#: Bytes of text handled at once in a task.
PIECE = 1 << 20
ALL64 = 0xFFFFFFFFFFFFFFFF
#: Odd multiplier of the polynomial hashes (5 mod 8, so that its powers spread).
BASE = 0x9E3779B97F4A7C15 * 8 + 5 & ALL64
BASE_INV = pow(BASE, -1, 1 << 64)
_WORD_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None
_MAPPED = False
_POWERS: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so extra columns cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. A local session without one gets its own."""
    default = tempfile.mkdtemp(prefix="strata-llm-") if spark.sparkContext.master.startswith(("local[", "local")) \
        and not spark.sparkContext.master.startswith("local-cluster") \
        and not spark.conf.get("spark.checkpoint.dir", None) else None
    return ensure_checkpoint_dir(spark, default)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, gives exact sizes to the planner."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory of this Python worker to the system; executors count it against their limit.

    From the first call on, arrays over 256 KB are mapped one by one, so that freeing them is enough."""
    global _MAPPED
    if _LIBC is None:
        return
    if not _MAPPED:
        _MAPPED = True
        _LIBC.mallopt(-3, 256 << 10)  # M_MMAP_THRESHOLD
        pa.set_memory_pool(pa.system_memory_pool())
    pa.default_memory_pool().release_unused()
    _LIBC.malloc_trim(0)


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null counts as empty."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(off):
        off = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def pieces(data: np.ndarray, off: np.ndarray, limit: int = PIECE):
    """Row ranges of at most ``limit`` bytes (at least one row): (first row, bytes, offsets)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = max(n, PIECE + 1)
        got = np.full(size, base, U64)
        got[0] = 1
        got = _POWERS[base] = np.cumprod(got, dtype=U64)
    return got[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] a polynomial in the bytes i..j; multiply by BASE_INV**i to make it position-free."""
    c = np.zeros(len(data) + 1, U64)
    np.cumsum(_WORD_TABLE[data] * powers(BASE, len(data)), out=c[1:])
    return c


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix64((c[ends] - c[starts]) * powers(BASE_INV, len(c))[starts] + (ends - starts).astype(U64))


# Bytes that part words: space and 0x09-0x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Bytes that part words where punctuation does not count: all ASCII but letters and digits.
PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACES):
    """(start, end, row) of each word; words never cross rows."""
    word = ~breaks[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = off[1:] > off[:-1]
    a, b = off[:-1][full], off[1:][full] - 1
    first[a] = word[a]
    last[b] = word[b]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
