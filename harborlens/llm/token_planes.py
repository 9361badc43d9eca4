"""Token-id output in plane-shuffled binary chunks.

Token ids of the documents, in ascending doc_id order, are cut into chunks of
``chunk_ids`` ids.  A chunk is transposed into planes (byte planes or bit
planes: the first plane holds every id's lowest byte or bit, and so on, up to
the highest plane the chunk needs), each plane is compressed with zstandard on
its own, and the compressed planes are laid end to end in the chunk's payload.
The chunk index beside it says how many ids and planes there are, how long each
plane is and which documents lie in the chunk.

Chunks are rows of a table in the shared folder, written through Spark's commit
protocol: a task that is lost with its executor is simply run again.

Defined results: null text is empty and yields the end id alone; null doc_ids
come first; equal doc_ids are ordered by text; an empty table gives no chunk.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.textkit import BYTE_KEYS, POWER_BASE, SLOT_KEYS, WORD_KEYS, mix64, new_path, span_hashes, stored, text_chunks, text_view, utf8, word_spans

CHUNK_IDS = 1 << 16
END_ID = 0
MAX_UNITS = 2_500_000
ENCODE_BYTES = 1 << 20
CHUNK_SCHEMA = ("block int, chunk long, n_ids int, planes array<int>, payload binary, "
                "ordinals array<long>, doc_ids array<long>, lengths array<int>")


class Encoder:
    """Whole texts to ids with a byte-level BPE tokenizer file.

    Such a tokenizer splits a text into pre-tokens before it merges.  Where single
    spaces or line ends stand between words, a pre-token begins at each of them, so
    a word with its space, a word after a line end, and the line end are encoded
    alone.  Each such unit is encoded once and its ids are kept under 128 bits of
    its hash; rows are then put together by array lookups.  A row with any other
    white space is encoded whole."""

    def __init__(self, path: str, max_units: int = MAX_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.line_end = self._encode(["\n"])[0]
        self.max_units = max_units
        self._forget()

    @staticmethod
    def for_worker(path: str) -> Encoder:
        """One encoder, with the units it knows, for all tasks that a Python worker process runs."""
        kept = sys.modules.setdefault("_harborlens_worker", types.ModuleType("_harborlens_worker")).__dict__
        if path not in kept:
            kept[path] = Encoder(path)
        return kept[path]

    def _forget(self):
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]   # (sorted keys, unit numbers): all, recent
        self.check, self.whole = np.zeros(0, np.uint64), np.zeros(0, bool)                  # second hash; cannot stand alone
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        """Many units in one call, divided by line ends, each of which is a token of its own there."""
        out = []
        for lo in range(0, len(units), 2000):
            some = units[lo:lo + 2000]
            ids = self._encode(["\n".join(some)])[0]
            cut = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) == 1 and len(cut) == len(some) - 1:
                ends = [0, *(cut + 1).tolist(), len(ids) + 1]
                out += [ids[a:b - 1] for a, b in zip(ends, ends[1:])]
            else:
                out += self._encode(some)
        return out

    def _find(self, keys: np.ndarray) -> np.ndarray:
        unit = np.full(len(keys), -1, np.int64)
        for known, number in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                unit = np.where(known[at] == keys, number[at], unit)
        return unit

    def _learn(self, keys, check, units: list[str]) -> np.ndarray:
        # A unit with white space of another kind at an edge might join a neighbour's: its rows are encoded whole.
        odd = np.array([u[0 if u[0] != " " else 1].isspace() or u[-1].isspace() for u in units], bool)
        got = self._encode_units(units)
        size = np.array([len(g) for g in got], np.int64)
        number = len(self.size) + np.arange(len(units))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *got])
        self.check, self.whole = np.concatenate([self.check, check]), np.concatenate([self.whole, odd])
        to = 0 if len(self.tables[1][0]) > self.max_units // 16 else 1
        merged = [np.concatenate(x) for x in zip(*self.tables[to:], (keys, number))]
        order = np.argsort(merged[0])
        self.tables[to] = (merged[0][order], merged[1][order])
        if to == 0:
            self.tables[1] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return number

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of UTF-8 text (``data`` between the offsets)."""
        n = len(off) - 1
        start, end, row = word_spans(data, off)
        key, check = span_hashes(data, start, end, BYTE_KEYS, WORD_KEYS * POWER_BASE + BYTE_KEYS[::-1])
        head = np.zeros(len(start) + 1, bool)
        head[row[:-1]] = True
        head = head[:-1]
        of = np.repeat(np.arange(n), np.diff(row))
        before = np.where(head, off[of], np.append(-1, end[:-1])) if len(start) else start
        prior = data[np.maximum(start - 1, 0)] if len(start) else data[:0]
        plain = np.where(head, start == before, (start - before == 1) & ((prior == 32) | (prior == 10)))
        ends = np.ones(n, bool)
        full = row[1:] > row[:-1]
        ends[full] = end[row[1:][full] - 1] == off[1:][full]
        ends[~full] = off[1:][~full] == off[:-1][~full]
        whole = ~ends
        np.logical_or.at(whole, of[~plain], True)
        spaced, lined = ~head & (prior == 32), ~head & (prior == 10)
        key = np.where(spaced, mix64(key + SLOT_KEYS[7]), key)
        if len(self.size) > self.max_units:
            self._forget()
        u, at, inv = np.unique(key, return_index=True, return_inverse=True)
        unit = self._find(u)
        new = np.flatnonzero(unit < 0)
        if len(new):
            raw = data.tobytes()
            unit[new] = self._learn(u[new], check[at[new]], [(" " if spaced[i] else "") + raw[start[i]:end[i]].decode() for i in at[new].tolist()])
        unit = unit[inv]
        np.logical_or.at(whole, of[self.whole[unit] | (self.check[unit] != check)], True)
        # Each word gives its unit's ids, after the line end's where one stands before it.
        size = self.size[unit]
        lead = np.where(lined, len(self.line_end), 0)
        total = np.cumsum(size + lead)
        ids = np.empty(int(total[-1]) if len(total) else 0, np.uint32)
        to = total - size
        for j, x in enumerate(self.line_end):
            ids[(to - lead)[lined] + j] = x
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids[np.repeat(to, size) + within] = self.ids[np.repeat(self.begin[unit], size) + within]
        cut = np.append(0, total)[row]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        again = np.flatnonzero(whole)
        texts = [data[off[i]:off[i + 1]].tobytes().decode() for i in again]
        for i, x in zip(again, self._encode(texts)):
            out[i] = x
        return out


def to_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """Uncompressed planes of uint32 ids, lowest first, as many as the largest id needs."""
    top = int(ids.max()) if len(ids) else 0
    if unit == "byte":
        n = max(1, (top.bit_length() + 7) // 8)
        return [p.tobytes() for p in np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :n].T)]
    n = max(1, top.bit_length())
    return [np.packbits(((ids >> np.uint32(b)) & np.uint32(1)).astype(np.uint8), bitorder="little").tobytes() for b in range(n)]


def from_planes(planes: list[bytes], n_ids: int, unit: str = "byte") -> np.ndarray:
    """Inverse of :func:`to_planes`."""
    ids = np.zeros(n_ids, np.uint32)
    for b, p in enumerate(planes):
        if unit == "byte":
            ids |= np.frombuffer(p, np.uint8).astype(np.uint32) << np.uint32(8 * b)
        else:
            bits = np.unpackbits(np.frombuffer(p, np.uint8), count=n_ids, bitorder="little")
            ids |= bits.astype(np.uint32) << np.uint32(b)
    return ids


def write_token_files(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      chunk_ids: int = CHUNK_IDS, unit: str = "byte", level: int = 1, end_id: int = END_ID) -> None:
    """Encode every text and write the chunks to ``path``, one ordered block per range of doc_ids.

    One shuffle (range by doc_id); each task streams over its sorted documents and
    holds the ids of one megabyte of text (or one document) and one open chunk."""
    docs = text_view(df, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = Encoder.for_worker(tokenizer)
        zip_ = zstandard.ZstdCompressor(level=level)
        held, waiting, chunk, block, ordinal = [], 0, 0, 0, 0
        parts: deque[tuple[int, int | None, int]] = deque()  # ordinal, doc_id, ids waiting

        def cut(last: bool):
            nonlocal held, waiting, chunk
            raw = memoryview(b"".join(held))
            at = 0
            while waiting >= chunk_ids or (last and waiting):
                n = min(chunk_ids, waiting)
                mine, left = [], n
                while left:
                    o, d, k = parts.popleft()
                    here = min(k, left)
                    mine.append((o, d, here))
                    left -= here
                    if k > here:
                        parts.appendleft((o, d, k - here))
                planes = [zip_.compress(p) for p in to_planes(np.frombuffer(raw[4 * at:4 * (at + n)], "<u4"), unit)]
                row = {"block": block, "chunk": chunk, "n_ids": n, "planes": [len(p) for p in planes],
                       "payload": b"".join(planes), "ordinals": [x[0] for x in mine], "doc_ids": [x[1] for x in mine],
                       "lengths": [x[2] for x in mine]}
                at, waiting, chunk = at + n, waiting - n, chunk + 1
                yield pa.RecordBatch.from_pylist([row], schema=schema)
            held = [bytes(raw[4 * at:])]

        for batch in text_chunks(batches, max_bytes=ENCODE_BYTES):
            block = batch.column("part")[0].as_py()
            for d, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(*utf8(batch.column("text")))):
                held += [ids.astype("<u4").tobytes(), end]
                parts.append((ordinal, d, len(ids) + 1))
                waiting += len(ids) + 1
                ordinal += 1
            if waiting >= chunk_ids:
                yield from cut(False)
        yield from cut(True)

    schema = pa.schema([("block", pa.int32()), ("chunk", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.int32())),
                        ("payload", pa.binary()), ("ordinals", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int32()))])
    (docs.withColumn("part", F.spark_partition_id()).mapInArrow(run, CHUNK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(path))


def crc_join(a: int, b: int, length: int) -> int:
    """crc32 of two byte strings laid end to end, from their crc32s and the second one's length.

    Appending a zero bit to a message is a linear map over GF(2); its powers are built by squaring."""
    def times(m, v):
        r, i = 0, 0
        while v:
            if v & 1:
                r ^= m[i]
            v >>= 1
            i += 1
        return r

    m = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    bits = 8 * length
    while bits:
        if bits & 1:
            a = times(m, a)
        m = [times(m, x) for x in m]
        bits >>= 1
    return a ^ b


def read_token_files(spark: SparkSession, path: str, unit: str = "byte") -> DataFrame:
    """Documents as the files hold them: (doc_id, start, n_tokens, ids_crc32).

    Chunks are decoded one by one, wherever they lie; a document cut by a chunk's
    end is put together from its parts' lengths and checksums."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)

    def decode(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                raw, at, planes = r["payload"], 0, []
                for size in r["planes"]:
                    planes.append(unzip.decompress(raw[at:at + size]))
                    at += size
                ids = memoryview(from_planes(planes, r["n_ids"], unit).astype("<u4").tobytes())
                n = len(r["lengths"])
                ends = np.cumsum(r["lengths"])
                crc = [zlib.crc32(ids[4 * (int(e) - k):4 * int(e)]) for e, k in zip(ends, r["lengths"])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["block"]] * n, pa.int32()), pa.array([r["chunk"]] * n, pa.int64()),
                    pa.array(ends - np.array(r["lengths"]), pa.int64()), pa.array(r["ordinals"], pa.int64()),
                    pa.array(r["doc_ids"], pa.int64()), pa.array(r["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["block", "chunk", "at", "ordinal", "doc_id", "length", "crc"])

    @F.pandas_udf("long")
    def whole_crc(parts):
        def one(p):
            p = sorted(p, key=lambda x: x["chunk"])
            crc = p[0]["crc"]
            for x in p[1:]:
                crc = crc_join(crc, x["crc"], 4 * x["length"])
            return crc
        return parts.map(one)

    parts = chunks.select("block", "chunk", "n_ids", "planes", "payload", "ordinals", "doc_ids", "lengths").mapInArrow(
        decode, "block int, chunk long, at long, ordinal long, doc_id long, length long, crc long")
    # A row per block: where its ids begin among all ids.
    sizes = chunks.groupBy("block").agg(F.sum("n_ids").alias("n"), F.max("n_ids").alias("chunk_ids"))
    begins = sizes.select(F.col("block").alias("b"), "chunk_ids",
                          (F.sum("n").over(W.orderBy("block")) - F.col("n")).alias("begin"))
    docs = stored(parts, "token-parts").groupBy("block", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.sum("length").alias("n_tokens"), F.min("chunk").alias("chunk"),
        F.min_by("at", "chunk").alias("at"), F.count("*").alias("n_parts"), F.first("crc").alias("crc"),
        F.collect_list(F.struct("chunk", "length", "crc")).alias("parts"))
    one = docs.where("n_parts = 1").withColumn("ids_crc32", F.col("crc"))
    more = docs.where("n_parts > 1").withColumn("ids_crc32", whole_crc("parts"))
    # Every chunk of a block but its last holds the block's largest number of ids.
    return (one.unionByName(more).join(begins, F.col("block") == F.col("b"))
            .select("doc_id", (F.col("begin") + F.col("chunk") * F.col("chunk_ids") + F.col("at")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_files(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the files into the shared folder and read every document back from them."""
    path = new_path(df.sparkSession, "token-planes")
    write_token_files(df, path, tokenizer, id_col, text_col, **options)
    return read_token_files(df.sparkSession, path, options.get("unit", "byte"))
