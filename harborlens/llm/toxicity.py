"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters the network as its word embedding beside the largest of its character
n-grams' embeddings in each dimension (n = 3 and 5, in bytes, word borders
included), so unknown words still say something.  A forward and a
backward GRU run over a window of words, attention pools their states into one
vector, and a logistic unit scores it.  The network is trained here, in numpy, on
windows of a bounded sample of labelled documents; every document is scored on
all its overlapping windows and takes the largest window's score.

Bounds (parameters): ``train_docs`` labelled rows of each class, ``train_windows``
windows of all of them together, ``max_vocab`` words.  A sample with fewer windows is
learnt from whole; else all its documents may give the same number at most, the
largest that stays within the bound.  Training runs in one task, in a child process, on that sample.  The
model is a few hundred kB however large the corpus, which is its broadcast bound.
Scoring is one pass without a shuffle.

Defined results: null text is empty; an empty text is scored as a window without
words; null or missing labels are not learned from; repeated rows score alike;
without both classes among the labels every score is 0.
"""

from __future__ import annotations

import multiprocessing
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.llm.textkit import LOWER, give_back, mix64, stored, text_chunks, text_view, utf8, words

WINDOW = 64
STRIDE = 48
WINDOWS_AT_ONCE = 1024      # windows whose states are in memory together
THRESHOLD = 0.3
CHAR_BUCKETS = 1 << 15
SCORE_BYTES = 1 << 20        # of text scored together
CHAR_GRAMS = (3, 5)


@dataclass
class Model:
    vocab: np.ndarray                        # sorted word hashes; row i + 1 of E belongs to vocab[i]
    p: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0                       # window logit at which a document's score is THRESHOLD
    scale: float = 1.0

    def score(self, logit: np.ndarray) -> np.ndarray:
        x = self.scale * (logit - self.shift) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sigmoid(x):
    return np.float32(0.5) * (np.float32(1) + np.tanh(np.float32(0.5) * x))


def init_model(vocab: np.ndarray, dim: int = 8, hidden: int = 8, seed: int = 7) -> Model:
    g = np.random.default_rng(seed)
    f = lambda *s: (g.standard_normal(s) * 0.3).astype(np.float32)
    p = {"E": np.zeros((len(vocab) + 1, dim), np.float32), "C": f(CHAR_BUCKETS, dim) * np.float32(0.1)}
    for d in "fb":
        p |= {f"W{d}": f(2 * dim, 3 * hidden), f"U{d}": f(hidden, 3 * hidden), f"b{d}": np.zeros(3 * hidden, np.float32)}
    p |= {"A": f(2 * hidden, hidden), "a": np.zeros(hidden, np.float32), "v": f(hidden), "w": f(2 * hidden), "o": np.zeros(1, np.float32)}
    return Model(vocab, p)


def char_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Character n-gram buckets of the given words, word by word, and each word's first one."""
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    n = int(size.sum())
    at = np.arange(n) + np.repeat(start - first, size)
    here = LOWER[data[at]].astype(np.uint64)
    place = np.arange(n) - np.repeat(first, size)
    left = np.repeat(size, size) - place
    out = np.empty((n, len(CHAR_GRAMS)), np.int64)
    for g, k in enumerate(CHAR_GRAMS):
        h = np.full(n, np.uint64(k))
        for j in range(-(k // 2), k // 2 + 1):
            inside = (place + j >= 0) & (left - j > 0)
            h = h * np.uint64(257) + np.where(inside, np.roll(here, -j) + np.uint64(1), np.uint64(0))
        out[:, g] = mix64(h) % np.uint64(CHAR_BUCKETS)
    return out.ravel(), first * len(CHAR_GRAMS)


def word_inputs(p: dict, ids: np.ndarray, gram: np.ndarray, first: np.ndarray, at_once: int = 20_000):
    """Inputs of the words: embedding, and the largest character n-gram embedding by dimension; ``at_once`` words in memory."""
    chars = np.empty((len(first), p["C"].shape[1]), np.float32)
    for lo in range(0, len(first), at_once):
        hi = min(lo + at_once, len(first))
        begin, end = first[lo], first[hi] if hi < len(first) else len(gram)
        chars[lo:hi] = np.maximum.reduceat(p["C"][gram[begin:end]], first[lo:hi] - begin)
    return np.concatenate([p["E"][ids], chars], axis=1)


def window_grid(n_words: np.ndarray, window: int = WINDOW, stride: int = STRIDE):
    """(row, first word within the row) of all overlapping windows; a row without words has one."""
    per = np.maximum(1, -(-(n_words - (window - stride)) // stride))
    row = np.repeat(np.arange(len(n_words)), per)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return row, k * stride


def _gates(p, d, x):
    """Input part of the gates for each distinct word, and last a padding row that keeps the state."""
    g = x @ p[f"W{d}"] + p[f"b{d}"]
    pad = np.zeros((1, g.shape[1]), np.float32)
    pad[0, :g.shape[1] // 3] = 50
    return np.concatenate([g, pad])


def _run(p, d, gates, ids, keep=None):
    """States [T, N, hidden] of one direction; ``keep`` collects what the backward pass needs."""
    n, steps = ids.shape
    u = p[f"U{d}"]
    k = u.shape[0]
    h = np.zeros((n, k), np.float32)
    out = np.empty((steps, n, k), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        g = gates[ids[:, t]]
        hu = h @ u
        zr = _sigmoid(g[:, :2 * k] + hu[:, :2 * k])
        z, r = zr[:, :k], zr[:, k:]
        c = np.tanh(g[:, 2 * k:] + r * hu[:, 2 * k:])
        if keep is not None:
            keep.append((t, h, z, r, c, hu[:, 2 * k:]))
        h = c + z * (h - c)
        out[t] = h
    return out


def _pool(p, states, real):
    u = np.tanh(states @ p["A"] + p["a"])
    e = np.where(real, u @ p["v"], np.float32(-1e9))
    e = np.exp(e - e.max(axis=0)) * real
    alpha = e / np.maximum(e.sum(axis=0), np.float32(1e-9))
    ctx = np.einsum("tn,tnk->nk", alpha, states)
    return u, alpha, ctx, ctx @ p["w"] + p["o"][0]


def window_logits(m: Model, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Logit of each window; ids index rows of x, len(x) is padding."""
    p = m.p
    states = np.concatenate([_run(p, "f", _gates(p, "f", x), ids), _run(p, "b", _gates(p, "b", x), ids)], axis=2)
    return _pool(p, states, (ids < len(x)).T)[3]


def text_logits(m: Model, data: np.ndarray, off: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """Largest window logit of each row."""
    h, row, start, end = words(data, off)
    if len(h):
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        pos = np.minimum(np.searchsorted(m.vocab, u), max(0, len(m.vocab) - 1))
        known = m.vocab[pos] == u if len(m.vocab) else np.zeros(len(u), bool)
        x = word_inputs(m.p, np.where(known, pos + 1, 0), *char_grams(data, start[at], end[at]))
    else:
        u, inv, x = h, np.zeros(0, np.int64), np.zeros((0, m.p["E"].shape[1] + m.p["C"].shape[1]), np.float32)
    inv = np.append(inv, len(u)).astype(np.int64)
    n = np.diff(row)
    of, begin = window_grid(n, window, stride)
    best = np.full(len(n), -np.inf, np.float32)
    for lo in range(0, len(of), WINDOWS_AT_ONCE):
        o, b = of[lo:lo + WINDOWS_AT_ONCE], begin[lo:lo + WINDOWS_AT_ONCE]
        at = b[:, None] + np.arange(window)
        ids = inv[np.where(at < n[o][:, None], row[o][:, None] + at, len(inv) - 1)]
        np.maximum.at(best, o, window_logits(m, x, ids))
    return best


# -------------------------------------------------------------------- training

def _gradients(m: Model, x, ids, y, weight):
    p, g = m.p, {}
    real = (ids < len(x)).T
    keep = {"f": [], "b": []}
    gates = {d: _gates(p, d, x) for d in "fb"}
    both = [_run(p, d, gates[d], ids, keep[d]) for d in "fb"]
    states = np.concatenate(both, axis=2)
    u, alpha, ctx, logit = _pool(p, states, real)
    d_logit = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
    g["w"], g["o"] = ctx.T @ d_logit, d_logit.sum(keepdims=True)
    d_ctx = d_logit[:, None] * p["w"]
    d_states = alpha[:, :, None] * d_ctx
    d_alpha = np.einsum("tnk,nk->tn", states, d_ctx)
    d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
    g["v"] = np.einsum("tn,tnk->k", d_e, u)
    d_u = d_e[:, :, None] * p["v"] * (1 - u * u)
    flat = d_u.reshape(-1, d_u.shape[2])
    g["A"], g["a"] = states.reshape(-1, states.shape[2]).T @ flat, flat.sum(axis=0)
    d_states += d_u @ p["A"].T
    dx = np.zeros_like(x)
    k = p["Uf"].shape[0]
    order = np.argsort(ids.T.ravel(), kind="stable")
    sorted_ids = ids.T.ravel()[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
    for i, d in enumerate("fb"):
        U = p[f"U{d}"]
        dU, dg, dh = np.zeros_like(U), np.empty((*states.shape[:2], 3 * k), np.float32), np.zeros((ids.shape[0], k), np.float32)
        for t, h, z, r, c, huc in reversed(keep[d]):
            dh = dh + d_states[t][:, i * k:(i + 1) * k]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * huc * r * (1 - r)
            dg[t] = np.concatenate([dz, dr, dc], axis=1)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            dU += h.T @ dhu
            dh = dh * z + dhu @ U.T
        per = np.add.reduceat(dg.reshape(-1, 3 * k)[order], heads)
        at = sorted_ids[heads]
        per, at = per[at < len(x)], at[at < len(x)]
        g[f"U{d}"], g[f"b{d}"], g[f"W{d}"] = dU, per.sum(axis=0), x[at].T @ per
        dx[at] += per @ p[f"W{d}"].T
    return g, dx


def train(texts: list[str], labels: list[int], docs: list[int] | None = None, max_vocab: int = 30_000, min_count: int = 3, epochs: int = 6, steps: int = 900,
          batch: int = 128, rate: float = 0.01, decay: float = 0.1, dropout: float = 0.5, seed: int = 7) -> Model:
    """Fit the network on windows of text, each with its document's 0/1 label (Adam, deterministic).

    A toxic document's windows need not all be toxic: after a third of the epochs only
    its best window, and those that look toxic already, stay among the positives.  A
    small sample is gone through more often, for about ``steps`` steps."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    h, row, start, end = words(data, off)
    u, at, inv, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    often = np.flatnonzero(count >= min_count)
    often = often[np.argsort(-count[often], kind="stable")[:max_vocab]]
    vocab = np.sort(u[often])
    m = init_model(vocab, seed=seed)
    pos = np.minimum(np.searchsorted(vocab, u), max(0, len(vocab) - 1))
    known = np.where(vocab[pos] == u, pos + 1, 0) if len(vocab) else np.zeros(len(u), np.int64)
    gram, first = char_grams(data, start[at], end[at])
    size = (end - start)[at] * len(CHAR_GRAMS)
    of = np.arange(len(texts)) if docs is None else np.unique(np.array(docs), return_inverse=True)[1]
    y = np.array(labels, np.float32)
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    n = np.diff(row)
    inv = np.append(inv, len(u)).astype(np.int64)
    g = np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in m.p.items()}
    m2 = {k: np.zeros_like(v) for k, v in m.p.items()}
    step = 0
    def grid(b):
        at = np.arange(WINDOW)
        return inv[np.where(at < n[b][:, None], row[b][:, None] + at, len(inv) - 1)]

    epochs = max(epochs, min(40, -(-steps * batch // len(y)))) if epochs > 1 else epochs
    good = np.ones(len(y), bool)
    for epoch in range(epochs):
        if epoch >= epochs // 3 and epoch > 1:
            x = word_inputs(m.p, known, gram, first)
            logit = np.concatenate([window_logits(m, x, grid(np.arange(lo, min(lo + WINDOWS_AT_ONCE, len(y))))) for lo in range(0, len(y), WINDOWS_AT_ONCE)])
            best = np.full(of.max() + 1, -np.inf)
            np.maximum.at(best, of, logit)
            good = (y == 0) | (logit > 0) | (logit >= best[of])
        todo = g.permutation(np.flatnonzero(good))
        for lo in range(0, len(todo), batch):
            b = todo[lo:lo + batch]
            ids = grid(b)
            mine = np.unique(ids)
            mine = mine[mine < len(u)]
            local = np.where(ids == len(u), len(mine), np.searchsorted(mine, ids))
            # Word dropout: some words are seen by their characters alone.
            w = np.where(g.random(len(mine)) < dropout, 0, known[mine])
            size_b = size[mine]
            first_b = np.concatenate([[0], np.cumsum(size_b)[:-1]]).astype(np.int64)
            gram_b = gram[np.arange(int(size_b.sum())) + np.repeat(first[mine] - first_b, size_b)]
            x = word_inputs(m.p, w, gram_b, first_b)
            grads, dx = _gradients(m, x, local, y[b], weight[b])
            half = m.p["E"].shape[1]
            grads["E"], grads["C"] = np.zeros_like(m.p["E"]), np.zeros_like(m.p["C"])
            np.add.at(grads["E"], w, dx[:, :half])
            # The gradient of a maximum goes to the n-gram that attains it (shared between equal ones).
            top = m.p["C"][gram_b] == np.repeat(x[:, half:], size_b, axis=0)
            ways = np.add.reduceat(top, first_b, dtype=np.float32)
            np.add.at(grads["C"], gram_b, np.repeat(dx[:, half:] / ways, size_b, axis=0) * top)
            step += 1
            lr = rate * (0.5 if epoch >= epochs - 2 else 1.0)
            for k, v in grads.items():
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                if k in "EC":   # weights of rare words and n-grams fade unless they keep earning their place
                    m.p[k] *= np.float32(1 - lr * decay)
                m.p[k] -= (lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return m


def calibrate(m: Model, logits: np.ndarray, labels: np.ndarray, weight: tuple[float, float] = (1.0, 1.0)) -> None:
    """Put THRESHOLD at the logit that separates the sample's documents best (F1, midway between neighbours).

    ``weight`` is how many labelled documents one of the sample's of class 0 or 1 stands for."""
    order = np.argsort(-logits, kind="stable")
    s, y = logits[order], labels[order]
    hits, wrong = weight[1] * np.cumsum(y), weight[0] * np.cumsum(1 - y)
    f1 = 2 * hits / (hits + wrong + hits[-1])
    i = int(np.argmax(f1))
    m.shift = float((s[i] + s[min(i + 1, len(s) - 1)]) / 2)


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_logits(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, logit) over all windows of every text; docs has doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        m = Model(**shared.value)
        for b in text_chunks(batches, max_bytes=SCORE_BYTES):
            data, off = utf8(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text_logits(m, data, off).astype(np.float64))],
                                             names=["doc_id", "logit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, logit double")


def window_share(windows: list[int], bound: int) -> int:
    """Most windows a document may give so that all together stay within ``bound`` (one at least)."""
    each, left = 0, sorted(windows)
    while left and len(left) * (left[0] - each) <= bound:
        bound -= len(left) * (left[0] - each)
        each = left.pop(0)
    return max(1, each + (bound // len(left) if left else 0))


def cut_windows(share: int):
    """mapInArrow function: up to ``share`` windows of each document, drawn by its id."""
    def run(batches):
        for b in text_chunks(batches):
            out = []
            for i, t, y in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("y").to_pylist()):
                w = t.encode().split()                       # bytes: at the white space that scoring knows
                _, begin = window_grid(np.array([len(w)]))
                g = np.random.default_rng(i & 0xFFFFFFFF)
                for k in np.sort(g.permutation(len(begin))[:share]):
                    out.append((i, int(k), b" ".join(w[begin[k]:begin[k] + WINDOW]).decode(), y))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["doc_id", "k", "text", "y"])

    return run


def in_child(work):
    """``work()`` in a short-lived child process: Spark's worker keeps nothing of its memory."""
    fork = multiprocessing.get_context("fork")
    out, into = fork.Pipe(duplex=False)
    child = fork.Process(target=lambda: into.send(work()))
    child.start()
    into.close()
    try:
        return out.recv()                                    # EOFError if the child dies: the task is run again
    finally:
        child.join()


def train_in_task(windows: DataFrame, **options) -> Model | None:
    """A model of (doc_id, k, text, y) windows, a bounded number, trained in one task; None without both classes."""
    def run(batches):
        rows = sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
        if len({r[3] for r in rows}) == 2:
            def work():
                m = train([r[2] for r in rows], [r[3] for r in rows], [r[0] for r in rows], **options)
                return {"vocab": m.vocab, **m.p}

            parts = in_child(work)
            give_back()
            yield pa.RecordBatch.from_arrays([pa.array(list(parts)), pa.array([a.dtype.str for a in parts.values()]),
                                              pa.array([list(a.shape) for a in parts.values()], pa.list_(pa.int64())),
                                              pa.array([a.tobytes() for a in parts.values()], pa.binary())], names=["name", "kind", "shape", "data"])

    got = windows.repartition(1).mapInArrow(run, "name string, kind string, shape array<long>, data binary").collect()
    parts = {r.name: np.frombuffer(bytes(r.data), np.dtype(r.kind)).reshape(r.shape).copy() for r in got}
    return Model(parts.pop("vocab"), parts) if parts else None


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
        train_docs: int = 2500, train_windows: int = 20_000, **options) -> Model | None:
    """Train on a bounded sample: ``train_docs`` labelled rows of each class, those least by md5 of the id.

    docs has (doc_id, text).  The sample's ids (a bounded set) are broadcast to the
    documents, and the sample is stored.  The driver receives ids, numbers of windows,
    logits and the model."""
    rows = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
            .where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y")))
    pick = [rows.where(F.col("y") == c).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(train_docs) for c in (0, 1)]
    spark = docs.sparkSession
    ids = [tuple(r) for c in pick for r in c.collect()]
    if len({y for _, y in ids}) < 2:
        return None
    sample = stored(docs.join(F.broadcast(spark.createDataFrame(ids, "doc_id long, y int")), "doc_id").select("doc_id", "text", "y"), "toxicity-sample")
    # A fifth of the sample is kept from training and sets the threshold.
    apart = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 4) % 5 == 0
    learnt = sample.where(~apart)
    n_words = F.length(F.regexp_replace(F.regexp_replace("text", "[^\\x20\\x09-\\x0D]+", "x"), "[\\x20\\x09-\\x0D]+", ""))
    sizes = np.array([r.n for r in learnt.select(n_words.alias("n")).collect()], np.int64)
    share = window_share(np.bincount(window_grid(sizes)[0], minlength=len(sizes)).tolist(), train_windows)
    model = train_in_task(learnt.mapInArrow(cut_windows(share), "doc_id long, k long, text string, y long"), **options)
    if model is None:
        return None
    scored = document_logits(sample, model).join(F.broadcast(spark.createDataFrame(ids, "doc_id long, y int")), "doc_id")
    whole = sorted(tuple(r) for r in scored.where(apart).select("doc_id", "logit", "y").collect())
    if len({r[2] for r in whole}) < 2:
        whole = sorted(tuple(r) for r in scored.select("doc_id", "logit", "y").collect())
    y = np.array([r[2] for r in whole])
    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    calibrate(model, np.array([r[1] for r in whole]), y, (total[0] / (y == 0).sum(), total[1] / (y == 1).sum()))
    return model


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_id_col: str = "doc_id", label_col: str = "toxic", model: Model | None = None, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``df``."""
    docs = text_view(df, id_col, text_col)
    model = model or fit(docs, labels, label_id_col, label_col, **options)
    if model is None:
        return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scale, shift, base = model.scale, model.shift, float(np.log(THRESHOLD / (1 - THRESHOLD)))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(scale) * (F.col("logit") - F.lit(shift)) + F.lit(base))))
    return (document_logits(docs, model).withColumn("score", score)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= F.lit(THRESHOLD)).cast("int").alias("predicted")))


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
               label_col: str = "toxic", **options) -> DataFrame:
    """Rows of ``df`` whose score is below THRESHOLD, all columns as they are; no shuffle.

    Without a trained model (labels of one class only) every row stays."""
    model = fit(text_view(df, id_col, text_col), labels, label_id_col, label_col, **options)
    if model is None:
        return df
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        m = Model(**shared.value)
        for b in text_chunks(batches, text_col, SCORE_BYTES):
            yield b.filter(pa.array(m.score(text_logits(m, *utf8(b.column(text_col))).astype(np.float64)) < THRESHOLD))

    return df.mapInArrow(run, df.schema)
