"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is the query set: it is taken in blocks of bounded size, and each
block goes to all tasks (``block_items`` items and ``block_bytes`` of text are the
broadcast bound).  For a block, two passes over the documents are made, neither
of which shuffles text.  The first counts in how many documents each word n-gram
of the block occurs.  Each item then keeps as seeds its n-grams that are rare beside
its others: those in at most COMMON times as many documents as its median n-gram,
plus ``slack``.  So an item that many documents hold keeps its seeds, an edit
removes only the few that it touches, and what is common in any text is no seed.
The second pass finds
seeds in documents; a seed places an item on a diagonal, and the stretch of words
around that diagonal is aligned with the whole item by Smith-Waterman over words
(match 2, mismatch -1, gap -1).  The best score over 2 * item words says how much
of the item a document holds, edited or not.

Defined results: null texts are empty; empty texts and items without words match
nothing; an item shorter than the n-gram is its own single seed; repeated rows of
a doc_id count together (best score); null doc_ids are kept as a row of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.llm.textkit import fresh, grams, text_chunks, text_view, utf8, words

SEED_WORDS = 4
THRESHOLD = 0.6
COMMON = 4
SLACK = 16
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
_RESULT = "doc_id long, item_id long, score double, matched_words long, word_at long"


@dataclass
class Block:
    ids: list
    words: list[np.ndarray]       # word hashes of each item
    lengths: list[int]            # n-gram lengths in use
    grams: np.ndarray             # sorted distinct n-gram hashes
    filter: np.ndarray            # which of 2**20 hash prefixes occur among them
    of_gram: np.ndarray           # (gram, item, offset) rows, sorted by gram
    first: np.ndarray             # first row of each gram in of_gram


def make_block(ids: list, texts: list[str], n: int = SEED_WORDS, keep: np.ndarray | None = None) -> Block:
    """Index of the items' n-grams; ``keep`` (item, hash) pairs limit it to seeds."""
    raw = [(t or "").encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    h, row, _, _ = words(np.frombuffer(b"".join(raw), np.uint8), off)
    per = [h[row[i]:row[i + 1]] for i in range(len(ids))]
    rows, lengths = [], set()
    for i, w in enumerate(per):
        if len(w):
            k = min(n, len(w))
            lengths.add(k)
            g = grams(w, k)
            rows.append(np.stack([g, np.full(len(g), i, np.uint64), np.arange(len(g), dtype=np.uint64)], axis=1))
    r = np.concatenate(rows) if rows else np.zeros((0, 3), np.uint64)
    if keep is not None and len(r):
        r = r[np.isin(r[:, 0] ^ (r[:, 1] << np.uint64(40)), keep)]
    r = r[np.lexsort((r[:, 2], r[:, 1], r[:, 0]))]
    g, first = np.unique(r[:, 0], return_index=True)
    prefix = np.zeros(1 << 20, bool)
    prefix[(g >> np.uint64(44)).astype(np.int64)] = True
    return Block(ids, per, sorted(lengths), g, prefix, r, np.append(first, len(r)))


def find_grams(block: Block, h: np.ndarray, row: np.ndarray):
    """(gram index, word position) of every n-gram of the block in the rows' words."""
    found = []
    for k in block.lengths:
        g = grams(h, k)
        at = np.flatnonzero(block.filter[(g >> np.uint64(44)).astype(np.int64)])
        if not len(at):
            continue
        i = np.minimum(np.searchsorted(block.grams, g[at]), len(block.grams) - 1)
        same = block.grams[i] == g[at]
        at, i = at[same], i[same]
        of = np.searchsorted(row, at, "right") - 1
        inside = at + k <= row[of + 1]
        found.append(np.stack([i[inside], at[inside]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def align(item: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of the item against each row of ``stretch`` (0: no word), and where it ends."""
    n, m = stretch.shape
    slide = np.arange(m, dtype=np.int32) * -GAP
    h = np.zeros((n, m + 1), np.int32)
    best, where = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for word in item:
        step = np.where(stretch == word, np.int32(MATCH), np.int32(MISMATCH))
        new = np.maximum(np.maximum(h[:, :-1] + step, h[:, 1:] + GAP), 0)
        # A gap in the item costs the same a word: carry the best start to the right.
        new = np.maximum(new, np.maximum.accumulate(new + slide, axis=1) - slide)
        h[:, 1:] = new
        at = new.argmax(axis=1)
        top = new[np.arange(n), at]
        where = np.where(top > best, at, where)
        best = np.maximum(best, top)
    return best, where


def align_rows(block: Block, h: np.ndarray, row: np.ndarray, threshold: float):
    """(row, item index, score, matched words, end word) of aligned pairs at or above the threshold."""
    hits = find_grams(block, h, row)
    if not len(hits):
        return []
    size = np.diff(block.first)[hits[:, 0]]
    pick = np.repeat(block.first[hits[:, 0]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    item = block.of_gram[pick, 1].astype(np.int64)
    pos = np.repeat(hits[:, 1], size)
    length = np.array([len(w) for w in block.words])[item]
    slack = length // 4 + 2
    of = np.searchsorted(row, pos, "right") - 1
    diagonal = pos - block.of_gram[pick, 2].astype(np.int64) - row[of] + length  # never negative
    key = np.unique(np.stack([item, of, diagonal // slack], axis=1), axis=0)
    out = []
    for lo, hi in _runs(key[:, 0]):
        i = int(key[lo, 0])
        w = block.words[i]
        s = len(w) // 4 + 2
        # A diagonal anywhere in its bin, shifted by up to the slack either way, stays inside the stretch.
        begin = key[lo:hi, 2] * s - len(w) - s
        for a in range(0, hi - lo, 2048):
            r, b = key[lo + a:min(hi, lo + a + 2048), 1], begin[a:a + 2048]
            at = b[:, None] + np.arange(len(w) + 3 * s)
            ok = (at >= 0) & (at < (row[r + 1] - row[r])[:, None])
            stretch = np.where(ok, h[np.where(ok, row[r][:, None] + at, 0)], np.uint64(0))
            score, end = align(w, stretch)
            for j in np.flatnonzero(score >= threshold * MATCH * len(w)):
                out.append((int(r[j]), i, float(score[j]) / (MATCH * len(w)), len(w), int(b[j] + end[j])))
    return out


def _runs(x: np.ndarray):
    cut = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return zip(cut.tolist(), np.append(cut[1:], len(x)).tolist())


def item_blocks(items: DataFrame, max_items: int, max_bytes: int):
    """The query set in blocks: lists of (id, text) within the bounds, one block on the driver at a time."""
    ids, texts, used = [], [], 0
    for r in items.toLocalIterator():
        if ids and (len(ids) == max_items or used + len(r["text"]) > max_bytes):
            yield ids, texts
            ids, texts, used = [], [], 0
        ids.append(r["doc_id"])
        texts.append(r["text"])
        used += len(r["text"])
    if ids:
        yield ids, texts


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", seed_words: int = SEED_WORDS, slack: int = SLACK,
                  threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Contaminated pairs: (doc_id, item_id, score, matched_words, word_at), the best alignment of each.

    ``score`` is between threshold and 1; ``word_at`` is the document's word at
    which the alignment ends."""
    spark = df.sparkSession
    docs = text_view(df, id_col, text_col).select("doc_id", "text")
    found = spark.createDataFrame([], _RESULT)
    for ids, texts in item_blocks(text_view(benchmark, item_col, item_text_col), block_items, block_bytes):
        every = make_block(ids, texts, seed_words)
        if not len(every.grams):
            continue
        freq = _frequencies(docs, every)
        block = make_block(ids, texts, seed_words, keep=_rare(every, freq, slack))
        found = found.unionByName(_aligned(docs, block, threshold))
    best = F.max_by(F.struct("score", "matched_words", "word_at"), F.struct("score", -F.col("word_at")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _frequencies(docs: DataFrame, block: Block) -> np.ndarray:
    """Documents that hold each n-gram of the block, counted over the whole corpus (one number a gram)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(block))

    def run(batches):
        b = Block(**shared.value)
        total = np.zeros(len(b.grams), np.int64)
        for batch in text_chunks(batches):
            h, row, _, _ = words(*utf8(batch.column("text")))
            hits = find_grams(b, h, row)
            of = np.searchsorted(row, hits[:, 1], "right") - 1
            total += np.bincount(np.unique(hits[:, 0] + of * len(b.grams)) % len(b.grams), minlength=len(b.grams))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    freq = np.zeros(len(block.grams), np.int64)
    for r in docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        freq[r["gram"]] = r["n"]
    return freq


def _rare(block: Block, freq: np.ndarray, slack: int) -> np.ndarray:
    """(item, gram) pairs to keep: n-grams rare beside their item's others."""
    r = block.of_gram
    n = freq[np.searchsorted(block.grams, r[:, 0])]
    order = np.lexsort((n, r[:, 1]))
    keep = []
    for lo, hi in _runs(r[order, 1]):
        f = n[order[lo:hi]]
        keep.append(order[lo:hi][f <= COMMON * f[(len(f) - 1) // 2] + slack])
    at = np.concatenate(keep)
    return np.unique(r[at, 0] ^ (r[at, 1] << np.uint64(40)))


def _aligned(docs: DataFrame, block: Block, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vars(block))

    def run(batches):
        b = Block(**shared.value)
        for batch in text_chunks(batches):
            h, row, _, _ = words(*utf8(batch.column("text")))
            got = align_rows(b, h, row, threshold)
            if got:
                ids = batch.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[g[0]] for g in got], pa.int64()), pa.array([b.ids[g[1]] for g in got], pa.int64()),
                     pa.array([g[2] for g in got], pa.float64()), pa.array([g[3] for g in got], pa.int64()),
                     pa.array([g[4] for g in got], pa.int64())],
                    names=["doc_id", "item_id", "score", "matched_words", "word_at"])

    return docs.mapInArrow(run, _RESULT)


def clean_documents(df: DataFrame, pairs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in no contaminated pair (null-safe), with df's columns, whatever their names."""
    (name,) = fresh(df, "_bad_id")
    bad = pairs.select(F.col("doc_id").alias(name)).distinct()
    return df.join(bad, df[id_col].cast("long").eqNullSafe(F.col(name)), "left_anti")
