"""Substring deduplication by bucket-pointer refinement over sampled suffixes.

A byte is removed if it is covered by a string of ``length`` bytes that also
starts earlier: in a document of smaller id, or earlier in the same document.

Suffixes are put into buckets and buckets are refined by the identifiers of the
buckets that their later offsets are in.  A bucket's identifier is a hash of the
string that its suffixes begin with, built by doubling: the identifier at depth
2k is made of those at depth k of offset 0 and of offset k, and shorter and later
identifiers are used again for every deeper one.  Equal strings therefore have
equal identifiers in every document and task, and refining needs no global sort.

1. Sampling.  Among the q-grams of each window of ``length`` bytes the one of
   least identifier is the window's pointer.  Consecutive windows share theirs, so
   there is one pointer for about 35 bytes, and equal windows have equal pointers
   at equal offsets.  The initial buckets hold the pointers by q-gram.
2. First refinement, by the identifiers at depth ``length`` of the first and the
   last window of the pointer's run: pointers of one refined bucket stand for the
   same windows.  In a refined bucket all but the first are later copies; a q-gram
   bucket with one pointer is done, and so is one whose pointers all fall into one
   refined bucket.
3. Only where a q-gram bucket falls apart, each refined bucket's first run is cut
   into blocks of ``BLOCK`` windows at fixed distances from the pointer.  Blocks are
   put into buckets by the string that all their windows share and refined in the
   same way; where such a bucket falls apart the windows differ within ``BLOCK``
   bytes of an edge, and only these blocks are refined into single windows.  Equal
   windows with an earlier start are later copies.

Every window is thus compared, through identifiers of 128 bits, with all earlier
windows.  Refined buckets are combined where the text lies before they are
shuffled; a bucket that holds a third of all rows sends one row for each
``combine_rows`` pointers.  Sorted rows are streamed, no bucket is held in memory.

Defined results: null text is empty; texts are UTF-8 bytes; a null doc_id comes
before all others; rows that share a doc_id are ordered by a hash of their text,
and exact repeats of a row are the same document; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.llm.source_mix import ranked
from harborlens.llm.textkit import BYTE_KEYS, mix64, stored, text_chunks, text_view, utf8

LENGTH = 100
GRAM = 32
COMBINE_ROWS = 400_000
PIECE = 1 << 18
BLOCK = 8
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def identifiers(data: np.ndarray, depth: int, lane: int) -> np.ndarray:
    """Bucket identifier at ``depth`` of every offset that has so many bytes after it.

    Depths double; the binary digits of ``depth`` join the levels kept on the way."""
    base = _BASES[lane]
    level, have = (BYTE_KEYS ^ np.uint64(base))[data], 1
    out, done = None, 0
    while True:
        if depth & have:   # this level's bytes, then those joined so far
            if out is None:
                out = level
            else:
                n = max(0, len(out) - have)
                out = level[:n] * np.uint64(pow(base, done, 1 << 64)) + out[have:have + n]
            done += have
        if 2 * have > depth:
            return mix64(out)
        n = max(0, len(level) - have)
        level = level[:n] * np.uint64(pow(base, have, 1 << 64)) + level[have:have + n]
        have *= 2


def pointer_runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows that share a pointer: (row, first window, windows - 1, pointer - first window, q-gram id, refined id).

    Windows lie within one row.  Window numbers count from the row's start."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = identifiers(data, gram, 0)
    whole = identifiers(data, length, 1)
    size = np.diff(off)
    start = np.repeat(off[:-1], size)
    at = np.arange(n - length + 1)
    inside = at + length <= np.repeat(off[1:], size)[:n - length + 1]
    bits = np.uint64(max(1, int(n).bit_length()))
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    span, have = length - gram + 1, 1
    while 2 * have <= span:
        least = np.minimum(least[:len(least) - have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
    w = at[inside]
    if not len(w):
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    pointer = (least[w] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], pointer[1:] != pointer[:-1]]))
    lo, hi = w[head], w[np.append(head[1:], len(w)) - 1]
    refined = mix64(whole[lo] * np.uint64(_BASES[0]) + mix64(whole[hi] + (hi - lo).astype(np.uint64) * np.uint64(_BASES[1])))
    return np.searchsorted(off, lo, "right") - 1, lo - start[lo], hi - lo, pointer[head] - lo, grams[pointer[head]], refined


def _pieces(batch, length: int):
    """(row numbers, first byte of each piece, bytes, offsets): rows longer than PIECE are cut into overlapping pieces."""
    data, off = utf8(batch.column("text"))
    if len(off) == 2 and off[1] > PIECE + length:
        for a in range(0, int(off[1]) - length + 1, PIECE):
            part = data[a:min(a + PIECE + length - 1, int(off[1]))]
            yield np.zeros(1, np.int64), np.array([a]), part, np.array([0, len(part)])
    else:
        yield np.arange(len(off) - 1), np.zeros(len(off) - 1, np.int64), data, off


def _pack(first, more, off, done):
    """One number for a run: first window, distance of the pointer from it and number of further windows
    (each under 1024), and whether the run is already a known copy."""
    return (first.astype(np.int64) << 21) | (off.astype(np.int64) << 11) | (more.astype(np.int64) << 1) | done


def _unpack(w: np.ndarray):
    return w >> 21, (w >> 1) & 1023, (w >> 11) & 1023


def sampled_pointers(docs: DataFrame, length: int, gram: int, combine_rows: int) -> DataFrame:
    """(q, c, d, w): q-gram bucket, refined bucket, document, packed run; combined per task."""
    def run(batches):
        held, n = [], 0

        def combined():
            nonlocal held, n
            if not held:
                return
            q, c, d, s, m, o = (np.concatenate(x) for x in zip(*held))
            held, n = [], 0
            order = np.lexsort((s, d, c, q))
            q, c, d, s, m, o = q[order], c[order], d[order], s[order], m[order], o[order]
            done = np.zeros(len(q), bool)
            done[1:] = (q[1:] == q[:-1]) & (c[1:] == c[:-1])
            # A known copy needs no bucket any more: it travels under a scattered key.
            q = np.where(done, mix64(d.view(np.uint64) + s.astype(np.uint64) * np.uint64(_BASES[0])), q)
            yield pa.RecordBatch.from_arrays([pa.array(q.view(np.int64)), pa.array(np.where(done, np.int64(0), c.view(np.int64))), pa.array(d),
                                              pa.array(_pack(s, m, o, done))], names=["q", "c", "d", "w"])

        for batch in text_chunks(batches, max_bytes=PIECE):
            ids = batch.column("d").to_numpy()
            for rows, begin, data, off in _pieces(batch, length):
                r, s, m, o, q, c = pointer_runs(data, off, length, gram)
                if len(r):
                    held.append((q, c, ids[rows[r]], s + begin[r], m, o))
                    n += len(r)
            if n >= combine_rows:
                yield from combined()
        yield from combined()

    return docs.mapInArrow(run, "q long, c long, d long, w long")


def refine(pointers: DataFrame) -> DataFrame:
    """kind 1: (d, w) runs that are later copies; kind 2: (d, w) first runs of a q bucket that falls apart, to be refined."""
    def run(batches):
        held, apart = None, False    # the last first-of-its-refined-bucket row; whether its q-gram bucket is known to fall apart
        last = None                  # key of the last row
        for b in batches:
            if not b.num_rows:
                continue
            q, c, d, w = (b.column(x).to_numpy() for x in ("q", "c", "d", "w"))
            known = (w & 1).astype(bool)
            copy_d, copy_w = [d[known]], [w[known]]
            q, c, d, w = q[~known], c[~known], d[~known], w[~known]
            ask_d, ask_w = [], []
            if len(q):
                fresh = np.ones(len(q), bool)
                fresh[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
                if last is not None:
                    fresh[0] = (q[0], c[0]) != last
                last = (q[-1], c[-1])
                copy_d.append(d[~fresh])
                copy_w.append(w[~fresh])
                q, d, w = q[fresh], d[fresh], w[fresh]
                if held is not None:
                    q, d, w = np.append(held[0], q), np.append(held[1], d), np.append(held[2], w)
                if len(q):
                    same = np.zeros(len(q) + 1, bool)
                    same[0] = apart if held is not None else False
                    same[1:-1] = q[1:] == q[:-1]
                    ask = same[:-1] | same[1:]
                    apart = bool(same[len(q) - 1])
                    held = (q[-1:], d[-1:], w[-1:])
                    ask_d, ask_w = [d[:-1][ask[:-1]]], [w[:-1][ask[:-1]]]
            yield _rows(np.concatenate(copy_d), np.concatenate(copy_w), 1)
            if ask_d:
                yield _rows(ask_d[0], ask_w[0], 2)
        if held is not None and apart:
            yield _rows(held[1], held[2], 2)

    return pointers.repartition("q").sortWithinPartitions("q", "c", "d", "w").mapInArrow(run, "kind int, d long, w long")


def _rows(d, w, kind):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(d), kind, np.int32)), pa.array(d, pa.int64()), pa.array(w, pa.int64())], names=["kind", "d", "w"])


def _by_document(runs: DataFrame) -> DataFrame:
    """One array of packed runs for each document (no longer than the document)."""
    return runs.groupBy("d").agg(F.collect_list("w").alias("runs"))


def _asked_windows(w: np.ndarray):
    """(window, pointer) of every window of the packed runs."""
    first, more, off = _unpack(w)
    n = more + 1
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at, np.repeat(first + off, n)


def _at(text: np.ndarray, depth: int, lane: int, at: np.ndarray) -> np.ndarray:
    """Identifiers at sorted offsets ``at``, piece by piece."""
    out = np.empty(len(at), np.uint64)
    for a in range(0, len(text), PIECE):
        lo, hi = np.searchsorted(at, [a, a + PIECE])
        if hi > lo:
            out[lo:hi] = identifiers(text[a:a + PIECE + depth - 1], depth, lane)[at[lo:hi] - a]
    return out


def window_blocks(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(q, c, d, w): blocks of the asked runs, by the string their windows share and by their first and last window."""
    core = length - BLOCK + 1

    def run(batches):
        for batch in text_chunks(batches, max_bytes=PIECE):
            data, off = utf8(batch.column("text"))
            ids, runs = batch.column("d").to_numpy(), batch.column("runs")
            for i in range(batch.num_rows):
                at, pointer = _asked_windows(np.sort(runs[i].values.to_numpy()))
                block = (pointer - at) // BLOCK
                head = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (pointer[1:] != pointer[:-1])]))
                lo, hi = at[head], at[np.append(head[1:], len(at)) - 1]
                text = data[off[i]:off[i + 1]]
                shared = pointer[head] - block[head] * BLOCK     # where the string that the block's windows share begins
                order = np.argsort(shared, kind="stable")
                q = np.empty(len(shared), np.uint64)
                q[order] = _at(text, core, 0, shared[order])
                c = mix64(_at(text, length, 1, lo) * np.uint64(_BASES[0]) + mix64(
                    _at(text, length, 1, hi) + ((pointer[head] - lo) << 10 | (hi - lo)).astype(np.uint64) * np.uint64(_BASES[1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.view(np.int64)), pa.array(c.view(np.int64)), pa.array(np.full(len(q), ids[i])),
                     pa.array(_pack(lo, hi - lo, pointer[head] - lo, 0))], names=["q", "c", "d", "w"])

    return docs.join(_by_document(asked), "d").select("d", "text", "runs").mapInArrow(run, "q long, c long, d long, w long")


def single_windows(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(x, y, d, s): identifiers of every window of the asked blocks."""
    def run(batches):
        for batch in text_chunks(batches, max_bytes=PIECE):
            data, off = utf8(batch.column("text"))
            ids, runs = batch.column("d").to_numpy(), batch.column("runs")
            for i in range(batch.num_rows):
                at = np.unique(_asked_windows(runs[i].values.to_numpy())[0])
                text = data[off[i]:off[i + 1]]
                x, y = _at(text, length, 0, at), _at(text, length, 1, at)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)),
                                                  pa.array(np.full(len(at), ids[i])), pa.array(at)], names=["x", "y", "d", "s"])

    return docs.join(_by_document(asked), "d").select("d", "text", "runs").mapInArrow(run, "x long, y long, d long, s long")


def later_windows(windows: DataFrame) -> DataFrame:
    """(d, w) of windows that an earlier one equals."""
    def run(batches):
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            x, y, d, s = (b.column(k).to_numpy() for k in ("x", "y", "d", "s"))
            copy = np.zeros(len(x), bool)
            copy[1:] = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
            copy[0] = (x[0], y[0]) == last
            last = (x[-1], y[-1])
            yield pa.RecordBatch.from_arrays([pa.array(d[copy]), pa.array(s[copy] << 21)], names=["d", "w"])

    return windows.repartition("x").sortWithinPartitions("x", "y", "d", "s").mapInArrow(run, "d long, w long")


def removed_spans(w: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Maximal removed spans [begin, end) from packed runs of covered windows."""
    first, more, _ = _unpack(w)
    end = first + more + length
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
    return np.stack([first[head], end[np.append(head[1:], len(first)) - 1]], axis=1)


def keyed_documents(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, d, text) of all rows and, once a document, (d, text): d orders documents.

    d is doc_id itself; only where several rows share an id are rows numbered by
    (doc_id, text hash) instead, and exact repeats then share d."""
    docs = text_view(df, id_col, text_col)
    d = F.coalesce("doc_id", F.lit(-(1 << 63)))
    if not docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        once = docs.select(d.alias("d"), "text")
        # doc_id is read off d, so that every join below shuffles the same (d, text) and Spark reuses one shuffle.
        return once.select(F.when(F.col("d") != -(1 << 63), F.col("d")).alias("doc_id"), "d", "text"), once
    t = F.xxhash64("text")
    names = ranked(docs.select(d.alias("k"), t.alias("t")).distinct(), F.col("k"), F.col("t"))
    rows = docs.withColumns({"k": d, "t": t}).join(names, ["k", "t"]).select("doc_id", F.col("rank").cast("long").alias("d"), "text")
    return rows, rows.select("d", "text").dropDuplicates(["d"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   combine_rows: int = COMBINE_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``df``."""
    def run(batches):
        for batch in text_chunks(batches):
            data, off = utf8(batch.column("text"))
            runs, out = batch.column("runs"), []
            for i in range(batch.num_rows):
                text = data[off[i]:off[i + 1]]
                spans = removed_spans(runs[i].values.to_numpy(), length) if runs[i].is_valid else np.zeros((0, 2), np.int64)
                sha, at = hashlib.sha256(), 0
                for a, b in spans:
                    sha.update(text[at:a])
                    at = b
                sha.update(text[at:])
                out.append((len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in zip(*out))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _joined(df, id_col, text_col, length, gram, combine_rows).mapInArrow(run, _RESULT)


def _joined(df, id_col, text_col, length, gram, combine_rows) -> DataFrame:
    """(doc_id, text, runs): every document beside its later-copy runs (null: none)."""
    docs, once = keyed_documents(df, id_col, text_col)
    refined = stored(refine(sampled_pointers(once, length, gram, combine_rows)), "suffix-runs")
    blocks = refine(window_blocks(once, refined.where("kind = 2").select("d", "w"), length))
    windows = later_windows(single_windows(once, blocks.where("kind = 2").select("d", "w"), length))
    copies = refined.where("kind = 1").select("d", "w").unionAll(blocks.where("kind = 1").select("d", "w")).unionAll(windows)
    return docs.join(_by_document(copies), "d", "left").select("doc_id", "text", "runs")


def kept_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
               combine_rows: int = COMBINE_ROWS) -> DataFrame:
    """(doc_id, kept, spans): what is left of each text, as bytes, and the removed byte spans."""
    def run(batches):
        for batch in text_chunks(batches):
            data, off = utf8(batch.column("text"))
            runs, kept, cut = batch.column("runs"), [], []
            for i in range(batch.num_rows):
                text = data[off[i]:off[i + 1]]
                spans = removed_spans(runs[i].values.to_numpy(), length) if runs[i].is_valid else np.zeros((0, 2), np.int64)
                stay = np.ones(len(text), bool)
                for a, b in spans:
                    stay[a:b] = False
                kept.append(text[stay].tobytes())
                cut.append([{"begin": int(a), "end": int(b)} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()),
                                              pa.array(cut, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                                             names=["doc_id", "kept", "spans"])

    return _joined(df, id_col, text_col, length, gram, combine_rows).mapInArrow(
        run, "doc_id long, kept binary, spans array<struct<begin:long,end:long>>")
