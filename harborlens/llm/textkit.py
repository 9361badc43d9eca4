"""Shared helpers: column selection, shared-folder tables, and numpy kernels that
work on whole Arrow batches of UTF-8 text (words, shingles, hashes).

Memory of a task stays bounded by ``CHUNK_BYTES`` of text or one document,
whichever is larger: kernels never see more than that at once.
"""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.session import scratch_path

CHUNK_BYTES = 2 << 20
SHINGLE = 5


def text_view(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so other columns can carry any name; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (Spark does not tell case apart)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write to a table in the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- Arrow batches

def text_chunks(batches, text_col: str = "text", max_bytes: int = CHUNK_BYTES):
    """Slices of the incoming batches with at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(text_col))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi
        give_back()
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a worker process between tasks, and with it all it holds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                         # a C library without it
        pass


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary array and each row's offsets into them."""
    wide = str(arr.type).startswith("large")
    n = len(arr)
    if n == 0 or arr.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(arr.buffers()[1], kind, n + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = arr.buffers()[2]
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


# ------------------------------------------------------------------ hash kernels

_RNG = np.random.default_rng(20240229)
BYTE_KEYS = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
WORD_KEYS = BYTE_KEYS[LOWER]
POWER_BASE = np.uint64(0x9E3779B97F4A7C15)
SLOT_KEYS = _RNG.integers(0, 2 ** 64, 16, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, off: np.ndarray):
    """Start and end byte of each word ``[^\\x20\\x09-\\x0D]+``, and each row's first word [n+1]."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = off[:-1]
    cut = cut[cut < len(data)]
    first[cut] = solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tail = off[1:] - 1
    tail = tail[tail >= 0]
    last[tail] = solid[tail]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, *keys: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the byte spans, one for each table of byte keys; they depend on the bytes only."""
    if not len(start):
        return [np.zeros(0, np.uint64) for _ in keys]
    size = end - start
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(size.max()) - 1, POWER_BASE)]))
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    local = np.arange(int(size.sum())) - np.repeat(first, size)
    text = data[local + np.repeat(start, size)]
    power = power[local]
    return [mix64(np.add.reduceat(k[text] * power, first) + size.astype(np.uint64) * SLOT_KEYS[15]) for k in keys]


def words(data: np.ndarray, off: np.ndarray):
    """Words of each row, A-Z lower-cased, as 64-bit hashes.

    Returns (hash per word, first word of each row [n+1], start byte per word,
    end byte per word)."""
    start, end, row = word_spans(data, off)
    return span_hashes(data, start, end, WORD_KEYS)[0], row, start, end


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive items (len(h) - k + 1 of them, rows not respected)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s += mix64(h[j:j + n] ^ SLOT_KEYS[j]) * SLOT_KEYS[j]
    return mix64(s)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = SHINGLE):
    """Sorted distinct k-word shingle hashes of each row: a list of uint64 arrays.

    A row with fewer than k words has its whole word sequence as its one shingle;
    a row without words has none."""
    h, row, _, _ = words(data, off)
    g = grams(h, k)
    out = []
    for i in range(len(off) - 1):
        a, b = int(row[i]), int(row[i + 1])
        if b - a >= k:
            s = np.sort(g[a:b - k + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            out.append(s[keep])
        elif b > a:
            out.append(grams(h[a:b], b - a) ^ SLOT_KEYS[b - a])
        else:
            out.append(g[:0])
    return out
