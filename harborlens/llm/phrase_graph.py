"""Phrase collocations from a weighted de Bruijn graph of word grams.

Texts are cut into pieces at punctuation and line ends, pieces into words.  In the
graph of a language, a node is a gram of ``MAX_WORDS`` - 1 words, and an edge, the
longest gram, joins the two nodes that overlap in it; its weight is how often it
occurs.

1. *Edges and piece ends.*  Each word position of a piece gives the longest gram that
   starts there: an edge, or near the end of its piece a shorter one.  Tasks combine
   equal ones, and Spark sorts them by range, so that a hot gram, or a hot word that
   begins a third of all grams, is spread over as many tasks as it needs.
2. *Shorter counts from node flow.*  How often a gram of k words occurs is the weight
   that flows out of it, the sum over the longer grams that begin with it, plus the
   pieces that end with it.  Sorted grams with a common beginning lie together, so one
   scan of a sorted range gives all orders at once; a gram that a range's border cuts
   is added up afterwards.
3. *Unary paths.*  Two edges whose common node has the same weight as both of them
   always follow each other.  Pointers along such edges are doubled until they reach
   the end of their path, which is then one passage (``unary_paths``).

Phrases below ``min_count`` are of no interest, and no phrase of that count holds a
pair of neighbours below it.  A table of counters of fixed size, indexed by the hash
of the pair, bounds each pair's count from above; pieces are cut where the bound is
below ``min_count``.  Counters that several pairs share let too much through, never too
little: on a corpus so large that all are full, nothing is cut and the results
are the same.

Defined results: null text is empty, null language ``und``; repeated rows and ids
count as often as they stand there; other columns are not read, so they can have any
name; a table without phrases gives no row.  Words and texts of any length are taken
whole; a task holds ``textkit.CHUNK_BYTES`` of text or one document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.textkit import BYTE_KEYS, CHUNK_BYTES, SLOT_KEYS, mix64, span_hashes, stored, text_chunks, utf8

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
CELL_BITS = 25               # counters of pairs: one byte each in a task, one bit each in the broadcast (4 MB)
BLOCK_BITS = 15
KNOWN_WORDS = 300_000        # words a task combines before it hands their counts on
BREAK = b"."
UPPER, LOWER, ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b".,;:!?\n\x0b\x0c\r"
CLEAN = bytes.maketrans(UPPER + b"\t" + ENDS, LOWER + b" " + BREAK * len(ENDS))


def texts_of(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


# ------------------------------------------------------------------ kernels over chunks of text

class Words:
    """The words of some texts of one language: distinct ones, and the sequence of their numbers (0 ends a piece)."""

    def __init__(self, data: bytes, lang: str):
        tokens = data.translate(CLEAN).replace(BREAK, b" . ").split()       # bytes: at ASCII white space only
        number = {BREAK: 0}
        for w in dict.fromkeys(tokens):
            number.setdefault(w, len(number))
        self.seq = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.words, self.lang = list(number), lang

    def pair_cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Places i whose word has a next one in its piece, and the counter of each such pair."""
        size = np.array([len(w) for w in self.words], np.int64)
        end = np.cumsum(size)
        h = span_hashes(np.frombuffer(b"".join(self.words), np.uint8), end - size, end, BYTE_KEYS)[0]
        salt = span_hashes(np.frombuffer(b"l" + self.lang.encode(), np.uint8), np.array([0]), np.array([1 + len(self.lang.encode())]), BYTE_KEYS)[0][0]
        at = np.flatnonzero((self.seq[:-1] > 0) & (self.seq[1:] > 0))
        a, b = h[self.seq[at]], h[self.seq[at + 1]]
        return at, (mix64(mix64(a ^ salt) * SLOT_KEYS[1] + mix64(b ^ SLOT_KEYS[2]) * SLOT_KEYS[3]) >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    def grams(self, frequent: np.ndarray | None, longest: int) -> tuple[pa.Array, np.ndarray]:
        """Distinct longest grams (words, each with a space after it) of two or more words at each place, and their counts.

        ``frequent``: bits of the counters that reach the minimum; pieces are cut at other pairs."""
        if len(self.seq) < 2:
            return pa.array([], pa.binary()), np.zeros(0, np.int64)
        at, cell = self.pair_cells()
        if frequent is not None:
            at = at[(frequent[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1]
        joined = np.zeros(len(self.seq), bool)
        joined[at] = True
        key = np.zeros(len(at), np.int64)
        n_words, follows = len(self.words) + 1, np.ones(len(at), bool)
        columns = []
        for k in range(longest):
            if k:
                follows = follows & joined[np.minimum(at + k - 1, len(joined) - 1)]
            word = np.where(follows, self.seq[np.minimum(at + k, len(self.seq) - 1)], 0)
            columns.append(word)
            _, key = np.unique(key * n_words + word, return_inverse=True)     # numbers below len(at): no overflow
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        spaced = pa.array([b"", *[w + b" " for w in self.words[1:]]], pa.large_binary())
        return pc.binary_join_element_wise(*[spaced.take(pa.array(c[first])) for c in columns], pa.scalar(b"", pa.large_binary())), count


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for part in text_chunks(batches, "text", CHUNK_BYTES):
        data, off = utf8(part.column("text"))
        raw, langs = data.tobytes(), part.column("lang").to_pylist()
        rows: dict[str, list[bytes]] = {}
        for i, lang in enumerate(langs):
            rows.setdefault(lang, []).append(raw[off[i]:off[i + 1]])
        for lang, texts in rows.items():
            yield Words(b"\n".join(texts), lang)


FIRST_PASS = "lang string, word string, n long, block int, cells binary"
GRAMS = "lang string, gram string, n long"


def words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: counts of words, and the task's counters of pairs, a byte each (255: or more), by block."""
    cells = np.zeros(1 << CELL_BITS, np.uint8)
    known: dict[str, Counter] = {}
    for words in by_language(batches):
        mine = known.setdefault(words.lang, Counter())
        counts = np.bincount(words.seq, minlength=len(words.words))
        mine.update(dict(zip(words.words[1:], counts[1:].tolist())))
        if sum(map(len, known.values())) > KNOWN_WORDS:
            yield from _word_rows(known)
            known = {}
        if len(words.seq) > 1:
            at, n = np.unique(words.pair_cells()[1], return_counts=True)
            cells[at] = np.minimum(cells[at] + n, 255)
    yield from _word_rows(known)
    pack = zstandard.ZstdCompressor(level=1)
    blocks = cells.reshape(-1, 1 << BLOCK_BITS)
    some = np.flatnonzero(blocks.any(axis=1))
    for lo in range(0, len(some), 64):
        now = some[lo:lo + 64]
        yield _row_batch([None] * len(now), [None] * len(now), [None] * len(now), now.tolist(), [pack.compress(blocks[b].tobytes()) for b in now])


def _word_rows(known: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counts in known.items():
        words = list(counts)
        for lo in range(0, len(words), 20_000):
            some = words[lo:lo + 20_000]
            yield _row_batch([lang] * len(some), [w.decode() for w in some], [counts[w] for w in some], [None] * len(some), [None] * len(some))


def _row_batch(lang, word, n, block, cells) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64()),
                                       pa.array(block, pa.int32()), pa.array(cells, pa.binary())], names=["lang", "word", "n", "block", "cells"])


def frequent_cells(least: int):
    """mapInArrow function: the tasks' counters of a block (rows sorted by block) added up, one bit each: ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, unpack = None, None, zstandard.ZstdDecompressor()

        def row():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                if block != now:
                    if now is not None:
                        yield row()
                    now, total = block, np.zeros(1 << BLOCK_BITS, np.uint64)
                total += np.frombuffer(unpack.decompress(cells, max_output_size=1 << BLOCK_BITS), np.uint8)
        if now is not None:
            yield row()

    return run


def longest_grams(frequent, longest: int):
    """mapInArrow function: the distinct longest grams of each chunk with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value if frequent is not None else None
        for words in by_language(batches):
            grams, n = words.grams(bits, longest)
            for lo in range(0, len(n), 20_000):
                some = grams.slice(lo, 20_000).cast(pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([words.lang] * len(some), pa.string()), some, pa.array(n[lo:lo + 20_000])], names=["lang", "gram", "n"])

    return run


class Flow:
    """Counts of all beginnings of two or more words of grams that come in sorted order."""

    def __init__(self, longest: int, least: int):
        self.orders, self.least = range(2, longest + 1), least
        self.last: tuple[str, bytes] | None = None           # the row before
        self.open = dict.fromkeys(self.orders, 0)            # count so far of the last row's beginning of k words
        self.border = dict.fromkeys(self.orders, False)      # whether that began with the range's first row

    def take(self, langs: list[str], grams: list[bytes], n: np.ndarray):
        """Rows (lang, phrase, count) that these rows complete."""
        first = self.last is None
        if not first:
            langs, grams, n = [self.last[0], *langs], [self.last[1], *grams], np.concatenate([[0], n])
        rows = len(grams)
        size = np.array([len(g) for g in grams], np.int64)
        off = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(grams), np.uint8)
        space = np.flatnonzero(data == 0x20)
        from_space = np.searchsorted(space, off)
        common = np.full(rows, -1, np.int64)                  # bytes shared with the row before
        if rows > 1:
            both = np.minimum(size[1:], size[:-1])
            starts = np.concatenate([[0], np.cumsum(both)[:-1]])
            local = np.arange(int(both.sum())) - np.repeat(starts, both)
            differ = data[local + np.repeat(off[1:-1], both)] != data[local + np.repeat(off[:-2], both)]
            common[1:] = np.minimum.reduceat(np.where(differ, local, np.repeat(both, both)), starts)
            same = np.array([a == b for a, b in zip(langs[1:], langs)], bool)
            common[1:][~same] = -1
        out = []
        for k in self.orders:
            has = from_space[1:] - from_space[:-1] >= k
            length = np.zeros(rows, np.int64)
            length[has] = space[from_space[:-1][has] + k - 1] - off[:-1][has] + 1
            begins = np.flatnonzero(has & (common < length))
            if not len(begins):                               # nothing of k words here: what was open is closed already
                self.open[k], self.border[k] = 0, False
                continue
            total = np.add.reduceat(np.where(has, n, 0), begins)
            if not first and has[0]:
                total[0] += self.open[k]
            border = np.zeros(len(begins), bool)
            border[0] = (first or self.border[k]) and begins[0] == 0
            open_end = bool(has[-1])
            done = len(begins) - open_end
            for g in np.flatnonzero((total[:done] >= self.least) | border[:done]).tolist():
                at = int(begins[g])
                out.append((langs[at], grams[at][:int(length[at]) - 1].decode(), int(total[g])))
            self.open[k], self.border[k] = (int(total[-1]), bool(border[-1])) if open_end else (0, False)
        self.last = (langs[-1], grams[-1])
        return out

    def rest(self):
        """What is open at the range's end."""
        if self.last is None:
            return []
        lang, gram = self.last
        words = gram.split(b" ")[:-1]
        return [(lang, b" ".join(words[:k]).decode(), self.open[k]) for k in self.orders if len(words) >= k]


def flow_counts(longest: int, least: int):
    """mapInArrow function over sorted ranges: counts of phrases of ``least`` or more, and of any count at the range's borders."""

    def batch_of(rows):
        cols = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = Flow(longest, least)
        for batch in batches:
            if batch.num_rows:
                grams = batch.column("gram").cast(pa.binary()).to_pylist()
                yield batch_of(flow.take(batch.column("lang").to_pylist(), grams, batch.column("n").to_numpy()))
        yield batch_of(flow.rest())

    return run


# ------------------------------------------------------------------ the graph

def pair_filter(first_pass: DataFrame, least: int):
    """Broadcast bits of the pair counters: 2**CELL_BITS / 8 bytes, whatever the corpus."""
    spark = first_pass.sparkSession
    blocks = first_pass.where("block IS NOT NULL").select("block", "cells").repartition("block").sortWithinPartitions("block")
    bits = np.zeros((1 << CELL_BITS - BLOCK_BITS, 1 << BLOCK_BITS - 3), np.uint8)
    for r in blocks.mapInArrow(frequent_cells(min(least, 255)), "block int, bits binary").collect():
        bits[r.block] = np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(bits.reshape(-1))


def phrase_counts(docs: DataFrame, longest: int = MAX_WORDS, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang"
                  ) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words that occur ``min_count`` times or more, and (lang, n), all words."""
    texts = texts_of(docs, text_col, lang_col)
    first = stored(texts.mapInArrow(words_and_pairs, FIRST_PASS), "phrase-words")
    words = stored(first.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-dictionary")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = pair_filter(first, min_count)
    grams = stored(texts.mapInArrow(longest_grams(frequent, longest), GRAMS), "phrase-edges")
    ranges = grams.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram")
    flow = ranges.mapInArrow(flow_counts(longest, min_count), "lang string, phrase string, f long")
    phrases = flow.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    ones = words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))
    every = ones.unionByName(phrases).where(F.col("f") >= min_count)
    return stored(every.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f"), "phrase-counts"), totals


def _first(col, k):
    return F.substring_index(col, " ", k)


def _without_first(col):
    return F.expr(f"substring({col}, locate(' ', {col}) + 1)")


def _without_last(col):
    return F.expr(f"substring({col}, 1, length({col}) - locate(' ', reverse({col})))")


def unary_paths(counts: DataFrame, longest: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, path_words): for each edge (phrase of ``longest`` words) how many words its unary path has."""
    edges = counts.where(F.col("words") == longest).select("lang", "phrase", "f", _without_last("phrase").alias("tail"), _without_first("phrase").alias("head"))
    nodes = counts.where(F.col("words") == longest - 1).select("lang", F.col("phrase").alias("head"), F.col("f").alias("flow"))
    ins = edges.join(nodes, ["lang", "head"]).where("f = flow").select("lang", F.col("head").alias("node"), "phrase")
    outs = edges.join(nodes.withColumnRenamed("head", "tail"), ["lang", "tail"]).where("f = flow").select("lang", F.col("tail").alias("node"), F.col("phrase").alias("next"))
    links = ins.join(outs, ["lang", "node"]).select("lang", "phrase", "next")
    # Every piece begins and ends somewhere, so that paths have ends: after log2(their length) rounds all pointers rest there.
    at = stored(edges.select("lang", "phrase").join(links, ["lang", "phrase"], "left")
                .select("lang", "phrase", F.coalesce("next", "phrase").alias("goal"), F.col("next").isNotNull().cast("long").alias("steps")), "phrase-paths")
    while True:
        on = at.select("lang", F.col("phrase").alias("goal"), F.col("goal").alias("further"), F.col("steps").alias("more"))
        nxt = stored(at.join(on, ["lang", "goal"]).select("lang", "phrase", F.col("further").alias("goal"), (F.col("steps") + F.col("more")).alias("steps")), "phrase-paths")
        moved = nxt.agg(F.sum("steps")).first()[0] != at.agg(F.sum("steps")).first()[0]
        at = nxt
        if not moved:
            break
    longest_way = at.groupBy("lang", "goal").agg((F.max("steps") + longest).alias("path_words"))
    return at.join(longest_way, ["lang", "goal"]).select("lang", "phrase", "path_words")


def mine_phrases(docs: DataFrame, longest: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a (its count), l and r (the
    counts of its parts at the lowest-scoring cut), n (words of the language), score =
    floor(1000 * a * n / (l * r)), path_words (words of the unary path that a phrase of
    ``longest`` words lies in, else of the phrase).

    A phrase that always occurs within one longer phrase of up to ``longest`` words is
    left out: then one of one word more has its count too, and that one is looked for."""
    counts, totals = phrase_counts(docs, longest, min_count, text_col, lang_col)
    longer = counts.where("words > 2")
    around = longer.select("lang", F.explode(F.array(_without_last("phrase"), _without_first("phrase"))).alias("phrase"), F.col("f").alias("outer"))
    around = around.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = counts.where("words > 1").join(around, ["lang", "phrase"], "left").where("outer IS NULL OR outer < f")
    kept = kept.select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = kept.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    part = F.split("phrase", " ")
    cuts = cuts.select("*", F.array_join(F.slice(part, F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice(part, F.col("cut") + 1, F.col("words")), " ").alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    # DECIMAL(38): whole numbers, cut off by DIV, so that nothing is rounded
    score = F.expr("(cast(1000 * cast(a AS decimal(19,0)) AS decimal(23,0)) * cast(n AS decimal(19,0))) DIV (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    best = cuts.select("*", score.cast("long").alias("score")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("b"), F.any_value("a").alias("a"), F.any_value("n").alias("n"), F.any_value("words").alias("words"))
    flat = best.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"), "words")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    paths = unary_paths(counts, longest)
    return ranked.join(paths, ["lang", "phrase"], "left").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.coalesce("path_words", F.col("words").cast("long")).alias("path_words"))
