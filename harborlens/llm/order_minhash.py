"""Document fingerprints by order MinHash.

Each byte k-mer of a text is numbered by how often it has occurred before, so a
text becomes a set of (k-mer, occurrence) items.  Every item is hashed once; the
hash picks one of ``slots`` slots and a rank inside it.  Each slot keeps its
``per_slot`` items of least rank, puts them back into text order and hashes that
tuple: the signature then depends on the order of the k-mers, which is what
makes it follow edit distance and not just the bag of k-mers.

Defined results: null text is empty; an empty text has the all-zero fingerprint;
a text shorter than k is one item; slots that no item of a short text falls into
borrow the next filled slot's value, mixed with the distance.  Equal texts have
equal fingerprints whatever their row, order or partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.textkit import POWER_BASE, mix64, stored, text_view

K = 8
SLOTS = 64
PER_SLOT = 2


def signature(raw: bytes, k: int = K, slots: int = SLOTS, per_slot: int = PER_SLOT) -> np.ndarray:
    """16-bit signature of each slot (uint16 array of length ``slots``)."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(slots, np.uint16)
    size = min(k, len(data))
    n = len(data) - size + 1
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * POWER_BASE + data[j:j + n]
    # A k-mer is known by 40 bits of its hash; sorting (k-mer, position) in one word numbers its occurrences.
    word = (mix64(h + np.uint64(size)) >> np.uint64(24)) << np.uint64(24)
    if n >> 24:  # beyond 16 M positions the two parts no longer fit one word
        order = np.lexsort((np.arange(n), word))
        kmer, pos = word[order], order.astype(np.uint64)
    else:
        both = np.sort(word | np.arange(n, dtype=np.uint64))
        kmer, pos = both & ~np.uint64(0xFFFFFF), both & np.uint64(0xFFFFFF)
    head = np.flatnonzero(np.concatenate([[True], kmer[1:] != kmer[:-1]]))
    seen = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
    item = mix64(kmer + seen.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    slot = (item % np.uint64(slots)).astype(np.int64)
    # Items of least hash per slot: only the smallest few can win, the rest need no sorting.
    want = 4 * slots * per_slot + 64
    if n > 4 * want:
        near = np.partition(item, want)[want]
        few = np.flatnonzero(item <= near)
        if np.bincount(slot[few], minlength=slots).min() < per_slot:
            few = np.arange(n)
    else:
        few = np.arange(n)
    few = few[np.lexsort((item[few], slot[few]))]
    s = slot[few]
    first = np.searchsorted(s, np.arange(slots))
    rank = np.arange(len(s)) - first[s]
    few, s = few[rank < per_slot], s[rank < per_slot]
    few = few[np.lexsort((pos[few], s))]
    value = np.zeros(slots, np.uint64)
    count = np.bincount(s, minlength=slots)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    for j in range(per_slot):
        has = count > j
        value[has] = mix64(value[has] * POWER_BASE + item[few[start[has] + j]] + np.uint64(1))
    filled = np.flatnonzero(count)
    if len(filled) < slots:
        at = np.arange(slots)
        to = filled[np.searchsorted(filled, at) % len(filled)]
        gap = ((to - at) % slots).astype(np.uint64)
        value = np.where(count > 0, value, mix64(value[to] + gap * np.uint64(0x632BE59BD9B4E019)))
    return (value & np.uint64(0xFFFF)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots, 0 to 1."""
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprint(df: DataFrame, text_col: str = "text", out: str = "fingerprint",
                k: int = K, slots: int = SLOTS, per_slot: int = PER_SLOT) -> DataFrame:
    """``df`` with its text's fingerprint (hex, 4 digits a slot) in column ``out``.

    A null text is fingerprinted as an empty one; every other column is kept."""
    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: signature((t or "").encode(), k, slots, per_slot).astype(">u2").tobytes().hex())

    return df.withColumn(out, run(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                      slots: int = SLOTS, per_slot: int = PER_SLOT) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    Documents are range-partitioned and sorted by id (nulls first, then text), so
    each task streams over neighbours; only the last row of each partition needs
    the first of the next, and these two rows per partition meet in a second,
    small step, by a join on the partition's number.  After the last document comes
    the first.  Memory: one document and its neighbour."""
    docs = text_view(df, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def row(i, text, sig, nxt, nxt_sig):
        changed = edited_text(text, nxt)
        edit = signature(changed.encode(), k, slots, per_slot)
        return {"doc_id": i, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                "fingerprint": _hex(sig), "edited_fingerprint": _hex(edit),
                "near_edited": likeness(sig, edit), "near_next": likeness(sig, nxt_sig)}

    def run(batches):
        held, last = None, None
        rows = []
        for batch in batches:
            part, ids, texts = batch.column("part"), batch.column("doc_id"), batch.column("text")
            for j in range(batch.num_rows):
                i, text = ids[j].as_py(), texts[j].as_py()
                sig = signature(text.encode(), k, slots, per_slot)
                if held is None:
                    rows.append({"edge": 0, "part": part[j].as_py(), "doc_id": i, "text": text})
                else:
                    rows.append({"edge": 2, "part": part[j].as_py(), **row(*held, text, sig)})
                held = (i, text, sig)
                if len(rows) >= 1000:
                    yield _batch(rows, schema)
                    rows = []
            last = part[-1].as_py() if batch.num_rows else last
        if held is not None:
            rows.append({"edge": 1, "part": last, "doc_id": held[0], "text": held[1]})
            yield _batch(rows, schema)

    def join_edges(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, nxt = r["text"], r["next_text"]
                rows.append(row(r["doc_id"], text, signature(text.encode(), k, slots, per_slot),
                                nxt, signature(nxt.encode(), k, slots, per_slot)))
            yield _batch(rows, plain)

    fields = [pa.field(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
              for n, t in (x.split() for x in _FIELDS.split(", "))]
    plain = pa.schema(fields)
    schema = pa.schema([pa.field("edge", pa.int32()), pa.field("part", pa.int32()), pa.field("text", pa.string()), *fields])
    done = stored(docs.withColumn("part", F.spark_partition_id())
                  .mapInArrow(run, "edge int, part int, text string, " + _FIELDS), "order-minhash")
    out = [x.split()[0] for x in _FIELDS.split(", ")]
    # Two rows for each non-empty partition: its first and its last document.  Only partition
    # numbers are put in order; the texts meet by a join on the number.
    edges = done.where("edge < 2").select("part", "edge", "doc_id", "text")
    parts = edges.where("edge = 0").select("part")
    every = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    parts = parts.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.first("part").over(every)).alias("next"))
    following = edges.where("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    last = (edges.where("edge = 1").join(parts, "part").join(following, "next")
            .select("doc_id", "text", "next_text").mapInArrow(join_edges, _FIELDS))
    return done.where("edge = 2").select(*out).unionByName(last)


def _hex(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{f: r.get(f) for f in schema.names} for r in rows], schema=schema)
