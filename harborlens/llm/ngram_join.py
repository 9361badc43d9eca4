"""N-gram Jaccard join: near-duplicate classes by token-combination prefixes.

A document is the set of hashes of its distinct 5-word shingles (tokens).  Two
documents link when 100 * |A and B| >= 75 * |A or B|.  All tokens have one global
order: tokens known to be frequent come last, by frequency class, the rest by
hash.  If two sets of sizes n and m link they have at least ceil(0.75 n) tokens in
common, so their first common token lies among the first n - ceil(0.75 n) + 1 of
either (the prefix), and their first two among one more (the extended prefix).

* A rare prefix token is indexed alone, with its position in the set's order.  If
  it is the pair's first common token, then the sets have at most 1 + the smaller
  number of tokens after it in common, so pairs that this bound rules out are not
  looked at under this key (a linking pair passes under its first common token).
* If the first common token is frequent, all common ones are, and two of them lie
  in both extended prefixes: documents of up to ``combine_up_to`` shingles index
  frequent tokens as combinations of two, longer ones (whose prefix would give too
  many combinations) one by one, and documents within a length ratio of the border
  do both.  Either way every linking pair shares an index key.

* All common tokens up to the smaller of the two prefixes' last tokens lie in both
  prefixes, and the rest is at most what one set has after its prefix.  So linking
  sets share not one key but as many as :func:`least_shared` says; pairs that share
  fewer, such as two texts with one boilerplate line, are never verified.

Equal sets are collapsed first.  An index key's documents are sorted by size and
chained: neighbours that share enough keys are verified on the texts, and give
components; long lists are chained again in other orders (at most ``turns`` times)
while that joins components, each document with the one of the ``WINDOW`` before it
that seems nearest.  Then only documents that share a key but lie in
different components are paired, counted and verified, all of them: lists that lie in
one component are dropped, and lists of more than ``split`` rows are cut into blocks
that meet in pairs, so no list is one task's.  A pair that could link is therefore
either verified or already in one component: components are exact, and a group of
copies costs a chain and not a clique.

* Documents in long lists carry SIGN_BITS bits, each the parity of the number of tokens
  that fall on it.  A bit differs only where an odd number of tokens in one set alone
  falls, so two sets differ in at least as many tokens as bits; a pair with more
  differing bits than linking sets have differing tokens is ruled out where the
  list lies and gives no row.  Sets of some 1,700 tokens or more are hardly ever
  ruled out this way, and all their pairs are counted and verified as without it.

Frequent tokens are found by counting every token of every document, combined
over ``survey_bytes`` of text where the text lies; tokens seen once there are not
sent.  The set of frequent tokens is at most (mean shingles a
document) / frequent_share, whatever the corpus, and only orders tokens: results
do not depend on it.

Defined results: null or empty texts and texts without words have no shingles and
link with nothing (their component is their own doc_id); fewer than five words
make one shingle; rows that share a doc_id are judged by their own text; null
doc_ids never name a component unless it has no other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.linked import components, joined
from harborlens.llm.textkit import CHUNK_BYTES, SLOT_KEYS, fresh, give_back, mix64, shingle_sets, stored, text_chunks, text_view, utf8

PERCENT = 75
FREQUENT_SHARE = 0.00005
COMBINE_SHARE = 0.02
COMBINE_UP_TO = 64
SURVEY_BYTES = 24 << 20
LIST_UP_TO = 12
TURNS = 4
EARLY = 8
SPLIT = 512
SIGN_BITS = 1024
WINDOW = 32
_LONG = pa.int64()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), _LONG)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def set_hash(tokens: np.ndarray, seed: int) -> np.uint64:
    return mix64(np.uint64(len(tokens)) + np.sum(mix64(tokens ^ SLOT_KEYS[seed]), keepdims=True, dtype=np.uint64))[0]


def need_common(n: int) -> int:
    """Least number of common tokens a set of n needs for any link."""
    return -(-PERCENT * n // 100)


# ------------------------------------------------------------------------ survey

def survey(docs: DataFrame, window_bytes: int, seed: int) -> DataFrame:
    """kind 0: (doc_id, n, s1, s2) of each document's set; kind 1: (s1 = token, n = documents) of often-seen tokens."""
    def run(batches):
        pool, used = [], 0

        def counts():
            nonlocal pool, used
            if pool:
                tokens = np.sort(np.concatenate(pool))
                first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(tokens)))
                often = n >= 2
                k = int(often.sum())
                if k:
                    yield _batch(kind=pa.array(np.ones(k, np.int32)), doc_id=pa.nulls(k, _LONG), n=pa.array(n[often], _LONG),
                                 s1=_signed(tokens[first[often]]), s2=pa.nulls(k, _LONG))
            pool, used = [], 0

        for b in text_chunks(batches):
            data, off = utf8(b.column("text"))
            sets = shingle_sets(data, off)
            yield _batch(kind=pa.array(np.zeros(len(sets), np.int32)), doc_id=b.column("doc_id"),
                         n=pa.array([len(s) for s in sets], _LONG),
                         s1=_signed(np.array([set_hash(s, seed) for s in sets], np.uint64)),
                         s2=_signed(np.array([set_hash(s, seed + 1) for s in sets], np.uint64)))
            pool += sets
            used += len(data)
            if used >= window_bytes:
                yield from counts()
        yield from counts()

    return docs.mapInArrow(run, "kind int, doc_id long, n long, s1 long, s2 long")


def frequent_tokens(surveyed: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of at least ``share`` of all documents, sorted, and their frequency over ``share`` of all."""
    n_docs = surveyed.where("kind = 0").count()
    floor = max(3.0, share * n_docs)
    got = (surveyed.where("kind = 1").groupBy("s1").agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
           .select("s1", "n").toArrow())
    token = got.column("s1").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], (got.column("n").to_numpy() / floor)[order]


# ------------------------------------------------------------------- index keys

def index_keys(tokens: np.ndarray, frequent: np.ndarray, level: np.ndarray, combine_level: int, combine_up_to: int = COMBINE_UP_TO):
    """Index keys of one set (sorted distinct tokens), and the position of each (of its first token) in the set's order.

    ``level`` is the frequency class (from 1) of each frequent token; classes from
    ``combine_level`` on count as frequent in the sense of the module text."""
    n = len(tokens)
    if n < 2:  # a set of one token links with equal sets alone
        return tokens[:0], np.zeros(0, np.int64)
    p = n - need_common(n) + 1
    at = np.minimum(np.searchsorted(frequent, tokens), max(0, len(frequent) - 1))
    cls = np.where(frequent[at] == tokens, level[at], 0) if len(frequent) else np.zeros(n, np.int64)
    if not cls.any():
        return tokens[:p] & SINGLE, np.arange(p)
    order = np.lexsort((tokens, cls))[:p + 1]
    t, c = tokens[order], cls[order]
    alone = np.arange(p) if n > combine_up_to else np.flatnonzero(c[:p] < combine_level)
    if n > combine_up_to * 100 // PERCENT + 1:
        return t[alone] & SINGLE, alone
    often = np.flatnonzero(c >= combine_level)
    i, j = np.triu_indices(len(often), 1)
    i, j = often[i], often[j]
    pairs = mix64(t[i] * SLOT_KEYS[3] + mix64(t[j] ^ SLOT_KEYS[4])) | ~SINGLE
    return np.concatenate([t[alone] & SINGLE, pairs]), np.concatenate([alone, i])


#: The lowest bit of a key tells combinations (1) from single tokens (0).
SINGLE = ~np.uint64(1)


def least_shared(n, m):
    """Least number of prefix tokens that linking sets of n and m tokens have in common."""
    common = -(-PERCENT * (n + m) // (100 + PERCENT))
    after = -(-PERCENT * np.maximum(n, m) // 100) - 1
    return np.maximum(1, common - after)


def may_link(n, i, m, j):
    """Whether sets of n and m tokens whose first common one is at i and j can link: lengths, and tokens left."""
    common = -(-PERCENT * (n + m) // (100 + PERCENT))
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (1 + np.minimum(n - 1 - i, m - 1 - j) >= common)


def signature(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens on each of SIGN_BITS places, as bits."""
    return np.packbits(np.bincount((tokens % np.uint64(SIGN_BITS)).astype(np.int64), minlength=SIGN_BITS).astype(np.uint8) & 1).tobytes()


def bits_over(sign: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Differing bits of the signatures of rows x and y, less the most tokens that linking sets of n and m differ in.

    Above 0 the sets cannot link.  Rows without a signature have all bits 0."""
    most = n + m - 2 * -(-PERCENT * (n + m) // (100 + PERCENT))
    differ = np.zeros(len(x), np.int64)
    for w in range(sign.shape[1]):
        differ += np.bitwise_count(sign[x, w] ^ sign[y, w])
    return differ - most


def _pack(n, i):
    return n.astype(np.int64) << 32 | i


def _unpack(x):
    return x >> 32, x & 0xFFFFFFFF


def key_rows(docs: DataFrame, frequent: np.ndarray, ratio: np.ndarray, combine_ratio: float, combine_up_to: int, seed: int) -> DataFrame:
    """(key, n, s): an index row for each key of each distinct set (distinct per task); n is packed with the key's position."""
    level = 1 + np.floor(np.log2(np.maximum(ratio, 1))).astype(np.int64)
    combine_level = 1 + int(np.floor(np.log2(max(combine_ratio, 1))))
    shared = docs.sparkSession.sparkContext.broadcast((frequent, level))

    def run(batches):
        often, lev = shared.value
        seen: set[int] = set()
        for b in text_chunks(batches):
            sets = shingle_sets(*utf8(b.column("text")))
            keys, size, name = [], [], []
            for s in sets:
                h = set_hash(s, seed)
                if len(s) > 1 and int(h) not in seen:
                    seen.add(int(h))
                    k, i = index_keys(s, often, lev, combine_level, combine_up_to)
                    keys.append(k)
                    size.append(_pack(np.full(len(k), len(s)), i))
                    name.append(np.full(len(k), h, np.uint64))
            if len(seen) > 200_000:
                seen.clear()
            if keys:
                yield _batch(key=_signed(np.concatenate(keys)), n=pa.array(np.concatenate(size), _LONG), s=_signed(np.concatenate(name)))

    return docs.mapInArrow(run, "key long, n long, s long")


def _streamed(batches, names):
    for b in batches:
        if b.num_rows:
            yield [_signs(b.column(c)) if c == "sign" else b.column(c).to_numpy(zero_copy_only=False) for c in names]
    give_back()


def _signs(column) -> np.ndarray:
    """A row of SIGN_BITS bits as 64-bit words for each value; zeros for null or empty ones."""
    data, off = utf8(column)
    out = np.zeros((len(column), SIGN_BITS // 64), np.uint64)
    out[off[1:] > off[:-1]] = data.reshape(-1, SIGN_BITS // 8).view(np.uint64)
    return out


def chain_lists(rows: DataFrame) -> DataFrame:
    """kind 0: (key, n, s) of keys with two sets or more; kind 1: neighbour pairs (key, s) = (s, s) in a key's
    list, in n the number of lists and in x their sizes.

    Rows arrive sorted by key, size and name; one row is held between batches."""
    def run(batches):
        held, tied = None, False   # the last row so far; whether it shares its key with the row before it
        for key, n, s in _streamed(batches, ("key", "n", "s")):
            if held is not None:
                key, n, s = np.append(held[0], key), np.append(held[1], n), np.append(held[2], s)
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (s[1:] != s[:-1])
            key, n, s = key[fresh], n[fresh], s[fresh]
            same = np.zeros(len(key) + 1, bool)      # same[i]: row i shares its key with row i - 1
            same[0] = tied if held is not None else False
            same[1:-1] = key[1:] == key[:-1]
            many = same[:-1] | same[1:]
            many[-1] = False                         # decided with the next batch
            at = np.flatnonzero(many)
            i = np.flatnonzero(same[1:-1])
            i = i[may_link(*_unpack(n[i]), *_unpack(n[i + 1]))]
            a, b, size, many, _ = _counted(s[i], s[i + 1], n[i] >> 32, n[i + 1] >> 32)
            yield _batch(kind=pa.array(np.repeat(np.array([0, 1], np.int32), [len(at), len(a)])),
                         key=pa.array(np.concatenate([key[at], a]), _LONG), n=pa.array(np.concatenate([n[at], many]), _LONG),
                         s=pa.array(np.concatenate([s[at], b]), _LONG), x=pa.array(np.concatenate([np.zeros(len(at), np.int64), size]), _LONG))
            held, tied = (key[-1:], n[-1:], s[-1:]), bool(same[len(key) - 1])
        if held is not None and tied:
            yield _batch(kind=pa.array([0], pa.int32()), key=pa.array(held[0], _LONG), n=pa.array(held[1], _LONG), s=pa.array(held[2], _LONG),
                         x=pa.array([0], _LONG))

    return rows.repartition("key").sortWithinPartitions("key", "n", "s").mapInArrow(run, "kind int, key long, n long, s long, x long")


def chain_again(lists: DataFrame, signs: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each row of the lists, the one of the WINDOW before it whose set seems nearest to its own, of those
    in other components that may link; the lists are in another order each turn.

    Rows arrive sorted by key and a hash of their set's name and the turn; WINDOW rows are held between batches."""
    def run(batches):
        held = None
        for key, n, s, c, sign in _streamed(batches, ("key", "n", "s", "c", "sign")):
            new = 0
            if held is not None:
                new = len(held[0])
                key, n, s, c, sign = (np.concatenate(x) for x in zip(held, (key, n, s, c, sign)))
            size, place = _unpack(n)
            near, over = np.full(len(key), -1), np.ones(len(key), np.int64)
            for back in range(1, WINDOW + 1):
                i = np.arange(max(new, back), len(key))
                i = i[key[i] == key[i - back]]
                if not len(i):                       # no longer list reaches into these rows
                    break
                i = i[c[i] != c[i - back]]
                small = n[i] <= n[i - back]
                x, y = np.where(small, i, i - back), np.where(small, i - back, i)
                ok = may_link(size[x], place[x], size[y], place[y])
                i, x, y = i[ok], x[ok], y[ok]
                bits = bits_over(sign, x, y, size[x], size[y])
                ok = (bits <= 0) & (bits < over[i])
                near[i[ok]], over[i[ok]] = i[ok] - back, bits[ok]
            i = np.flatnonzero(near >= 0)
            a, b, x, times, _ = _counted(s[i], s[near[i]], size[i], size[near[i]])
            yield _batch(a=pa.array(a, _LONG), b=pa.array(b, _LONG), x=pa.array(x, _LONG), k=pa.array(times, _LONG))
            held = key[-WINDOW:], n[-WINDOW:], s[-WINDOW:], c[-WINDOW:], sign[-WINDOW:]

    rows = (lists.join(mixed_keys(lists), "key", "left_semi").join(signs, "s", "left").withColumn("order", F.xxhash64("s", F.lit(turn)))
            .repartition("key").sortWithinPartitions("key", "order"))
    pairs = rows.select("key", "n", "s", "c", "sign").mapInArrow(run, "a long, b long, x long, k long")
    return pairs.groupBy("a", "b").agg(F.sum("k").alias("k"), F.max("x").alias("x")).where(_enough("k", 0.1)).select("a", "b")


def _counted(s, t, n, m, flag=None, counts=None):
    """Unordered pairs (a, b) of the names s and t, once each: packed sizes, number of times (where ``counts``), flags of any."""
    swap = s > t
    a, b = np.where(swap, t, s), np.where(swap, s, t)
    order = np.lexsort((b, a))
    a, b, size = a[order], b[order], np.where(swap, _pack(m, n), _pack(n, m))[order]
    head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    top = np.bitwise_or.reduceat(flag[order], head) if flag is not None and len(head) else np.zeros(len(head), np.int64)
    times = np.diff(np.append(head, len(a))) if counts is None else np.add.reduceat(counts[order].astype(np.int64), head) if len(head) else head
    return a[head], b[head], size[head], times, top


def _enough(times: str, share: float = 1.0):
    """Column: a pair with sizes x was seen under enough keys (or ``share`` of them)."""
    n, m = F.shiftright("x", 32), F.col("x").bitwiseAND(F.lit(0xFFFFFFFF))
    common = F.ceil(F.lit(PERCENT) * (n + m) / (100 + PERCENT))
    least = common - F.ceil(F.lit(PERCENT) * F.greatest(n, m) / 100) + 1
    return F.col(times) >= F.greatest(F.lit(1), F.floor(least * F.lit(share)))


def with_lengths(lists: DataFrame, list_up_to: int) -> DataFrame:
    """Index rows with ``long``: whether their key's list has more than ``list_up_to`` rows."""
    return lists.withColumn("long", F.count(F.lit(1)).over(W.partitionBy("key")) > list_up_to)


def mixed_keys(lists: DataFrame) -> DataFrame:
    """(key): keys whose rows lie in more than one component; lists has key and c, combined where they lie."""
    return lists.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key")


def blocked(lists: DataFrame, split: int = SPLIT) -> DataFrame:
    """The rows of ``lists``, with ``g`` and ``role``: those of equal (key, g) meet in one task.

    A list of up to ``split`` rows stays whole (g 0, role 2).  A longer one is cut into
    blocks of about ``split`` rows by size class, by component where one has ``split``
    rows of a class, and by a hash of the set's name.  Any row of the left blocks (role
    0, rows that may be the smaller set of a pair) meets any row of the right blocks
    (role 1, all rows) once, under the g of the two blocks; blocks of one component or of
    sizes too far apart do not meet."""
    size, place = F.shiftright("n", 32), F.col("n").bitwiseAND(F.lit(0xFFFFFFFF))
    # Sizes of linking sets differ by 4/3 at most: by one class.
    rows = lists.withColumns({"q": F.floor(F.log(size.cast("double")) / F.log(F.lit(1.34))).cast("int"),
                              "early": (F.col("long") == 0) | (place <= size - F.expr(
                                  f"({2 * PERCENT} * shiftright(n, 32) + {99 + PERCENT}) div {100 + PERCENT}"))})
    cells = rows.groupBy("key", "q", "c").agg(F.count(F.lit(1)).alias("rights"), F.sum(F.col("early").cast("long")).alias("lefts"))
    wide = stored(cells.groupBy("key").agg(F.sum("rights").alias("rows")).where(F.col("rows") > split).select("key"), "ngram-wide-keys")
    whole = lists.join(wide, "key", "left_anti").withColumns({"g": F.lit(0).cast("long"), "role": F.lit(2)})
    if wide.limit(1).count() == 0:
        return whole
    cells = stored(cells.join(wide, "key", "left_semi"), "ngram-cells")
    own = cells.where(F.col("rights") >= split).select("key", "q", "c", F.lit(1).alias("own"))

    def named(df):   # own 1: a block of component o; own 0: the rest of the size class
        return (df.join(own, ["key", "q", "c"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
                .withColumn("o", F.when(F.col("own") == 1, F.col("c")).otherwise(F.lit(0).cast("long"))))

    at = ["key", "q", "own", "o"]
    totals = stored(named(cells).groupBy(*at).agg(F.sum("lefts").alias("lefts"), F.sum("rights").alias("rights"))
                    .select(*at, *[F.ceil(F.col(x) / split).cast("long").alias(x) for x in ("lefts", "rights")]), "ngram-blocks")

    def blocks(x):
        return (totals.where(F.col(x) > 0).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col(x) - 1)))
                .select("key", *[F.col(c).alias(f"{x}_{c}") for c in (*at[1:], "salt")]))

    meet = blocks("lefts").join(blocks("rights"), "key").where(
        "rights_q - lefts_q in (0, 1) and not (lefts_own = 1 and rights_own = 1 and lefts_o = rights_o)")
    meet = stored(meet.withColumn("g", F.monotonically_increasing_id() + 1), "ngram-block-pairs")
    cut = named(rows.join(wide, "key", "left_semi")).join(totals, at)
    out = whole
    for role, x, some in ((0, "lefts", cut.where("early")), (1, "rights", cut)):
        here = [*at, "salt"]
        to = meet.select("key", *[F.col(f"{x}_{c}").alias(c) for c in here[1:]], "g")
        some = some.withColumn("salt", F.pmod(F.xxhash64("s"), F.col(x)))
        out = out.unionByName(some.join(to, here).select(*lists.columns, "g", F.lit(role).alias("role")))
    return out


def crossing_pairs(lists: DataFrame, combine_up_to: int = COMBINE_UP_TO, split: int = SPLIT) -> DataFrame:
    """(a, b): sets in different components that share enough keys, and may link under one of them.

    Rows arrive in the blocks of :func:`blocked`, sorted by size; for a row only
    earlier ones of at least 0.75 times its size are looked at, and only those rows are
    held, not more than a block.  Under a short
    list's key every pair is counted.  Under a long list's key a pair is taken only if
    the key may be its first common token: the smaller set must then have it among
    its first seventh, which few sets have unless they are mostly such tokens, and the
    first EARLY such keys of the two sets (``e0``, ...) must show no earlier common
    one, whose own list has the pair, and their signatures must not rule out a link.  The
    count a pair needs is lowered by ``m``, the number of a set's keys with long
    lists, the smaller of the two sets' numbers; counts are summed where the lists
    lie first.  A small set may have one common frequent token that no key of its own
    stands for; two or more show as a shared combination, and such a pair needs no
    count."""
    def run(batches):
        window = None
        for key, n, s, c, many, more, g, role, sign, *early in _streamed(batches, ("key", "n", "s", "c", "long", "m", "g", "role", "sign", *names)):
            new, head = 0, np.stack(early, axis=1)
            if window is not None:
                new = len(window[0])
                key, n, s, c, many, more, g, role, sign, head = (np.concatenate(x) for x in zip(window, (key, n, s, c, many, more, g, role, sign, head)))
            n, place = _unpack(n)
            # first row of the same block pair that is large enough, for each new row
            block = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (g[1:] != g[:-1])]))
            start = np.searchsorted(block, block, "left")
            lo = start.copy()
            for x, y in _key_runs(block, new):
                first = int(start[x])
                lo[x:y] = first + np.searchsorted(n[first:y], -(-PERCENT * n[x:y] // 100), "left")
            early = (role != 1) & (~many.astype(bool) | (place <= n - -(-2 * PERCENT * n // (100 + PERCENT))))
            lefts = np.flatnonzero(early)
            rows = new + np.flatnonzero(role[new:] != 0)
            begin, end = np.searchsorted(lefts, lo[rows]), np.searchsorted(lefts, rows)
            span = end - begin
            total = np.cumsum(span)
            at = 0
            while at < len(rows):   # at most about half a million comparisons at once, or one row's
                to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 19), "right")))
                k = span[at:to]
                right = np.repeat(rows[at:to], k)
                left = lefts[np.repeat(begin[at:to], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
                first = may_link(n[left], place[left], n[right], place[right])
                take = (c[left] != c[right]) & (first | ~many[right].astype(bool))
                left, right, first = left[take], right[take], first[take]
                take = ~(many[right].astype(bool) & _met_before(key[left], head[left], head[right]))
                left, right, first = left[take], right[take], first[take]
                take = bits_over(sign, left, right, n[left], n[right]) <= 0
                left, right, first = left[take], right[take], first[take]
                flag = first.astype(np.int64) | (key[left] & 1) << 1
                less = np.minimum(more[left], more[right])
                a, b, size, times, flag = _counted(s[left], s[right], n[left], n[right], flag | less << 2, ~many[left].astype(bool))
                if len(a):
                    yield _batch(a=pa.array(a, _LONG), b=pa.array(b, _LONG), x=pa.array(size, _LONG), k=pa.array(times, _LONG), flag=pa.array(flag, _LONG))
                at = to
            keep = (block == block[-1]) & (100 * n >= PERCENT * n[-1]) & early
            window = key[keep], _pack(n[keep], place[keep]), s[keep], c[keep], many[keep], more[keep], g[keep], role[keep], sign[keep], head[keep]

    names = [f"e{j}" for j in range(EARLY)]
    if "sign" not in lists.columns:   # then none rules anything out
        lists = lists.withColumn("sign", F.lit(None).cast("binary"))
    placed = blocked(lists, split).repartition("key", "g").sortWithinPartitions("key", "g", "n", "s")
    seen = placed.mapInArrow(run, "a long, b long, x long, k long, flag long")
    seen = seen.groupBy("a", "b").agg(F.max("x").alias("x"), F.sum("k").alias("k"), F.bit_or("flag").alias("flag"))
    small = F.least(F.shiftright("x", 32), F.col("x").bitwiseAND(F.lit(0xFFFFFFFF))) <= combine_up_to
    seen = seen.withColumns({"k": F.col("k") + small.cast("long") + F.shiftright("flag", 2), "flag": F.col("flag").bitwiseAND(F.lit(3))})
    # flag 1: the pair may link with its first common token under one of the keys; flag 2: it shares a combination
    return seen.where((F.col("flag") == 3) | ((F.col("flag") == 1) & _enough("k"))).select("a", "b")


def _met_before(key: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two sets have a common key before ``key`` among their first ones, which are in order."""
    out, before = np.zeros(len(key), bool), np.ones(len(key), bool)
    for j in range(left.shape[1]):
        before &= left[:, j] != key
        out |= before & (right == left[:, j, None]).any(axis=1)
    return out


def first_keys(hard: DataFrame) -> DataFrame:
    """(s, m, e0, ...): the number of a set's keys with long lists and the first EARLY of them in the set's order.

    A set has at most a quarter of its tokens as keys; missing ones are filled with
    the set's own name, which equals no other's."""
    place = F.col("n").bitwiseAND(F.lit(0xFFFFFFFF))
    keys = hard.groupBy("s").agg(F.count(F.lit(1)).alias("m"), F.slice(F.array_sort(F.collect_list(F.struct(place.alias("p"), "key"))), 1, EARLY).alias("keys"))
    return keys.select("s", "m", *[F.coalesce(F.get("keys", F.lit(j))["key"], "s").alias(f"e{j}") for j in range(EARLY)])


def _key_runs(key: np.ndarray, new: int):
    """Runs of equal keys among the rows from ``new`` on."""
    cut = new + np.flatnonzero(np.concatenate([[True], key[new + 1:] != key[new:-1]])) if new < len(key) else np.zeros(0, np.int64)
    return zip(cut.tolist(), np.append(cut[1:], len(key)).tolist())


# ------------------------------------------------------------ verification, classes

def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) pairs whose whole texts link; texts is (s, text) with compressed texts."""
    def run(batches):
        for b in batches:
            for lo, hi, left, right in _unpacked(b, "text_a", "text_b"):
                ok = []
                for x, y in zip(left, right):
                    z = np.sort(np.concatenate([x, y]))
                    both = int((z[1:] == z[:-1]).sum())
                    ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
                yield _batch(a=b.column("a").slice(lo, hi - lo), b=b.column("b").slice(lo, hi - lo), ok=pa.array(ok, pa.bool_()))

    a = texts.select(F.col("s").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("s").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, ok boolean").where("ok").select("a", "b")


def _unpacked(batch, *columns):
    """(lo, hi, sets of each column) for runs of rows whose texts together have CHUNK_BYTES at most, or one row."""
    unzip = zstandard.ZstdDecompressor()
    lo, used, raw = 0, 0, [[] for _ in columns]

    def sets(texts):
        return shingle_sets(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))

    for i in range(batch.num_rows):
        for r, c in zip(raw, columns):
            r.append(unzip.decompress(batch.column(c)[i].as_py()))
            used += len(r[-1])
        if used >= CHUNK_BYTES or i + 1 == batch.num_rows:
            yield (lo, i + 1, *(sets(r) for r in raw))
            lo, used, raw = i + 1, 0, [[] for _ in columns]


def compressed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with each text as zstandard bytes, about half of what a shuffle would otherwise carry."""
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=3)
        for b in text_chunks(batches):
            data, off = utf8(b.column("text"))
            raw = memoryview(data.tobytes())
            yield _batch(doc_id=b.column("doc_id"), text=pa.array([zip_.compress(raw[i:j]) for i, j in zip(off[:-1], off[1:])], pa.binary()))

    return docs.mapInArrow(run, "doc_id long, text binary")


def similarity_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent_share: float = FREQUENT_SHARE,
                       combine_share: float = COMBINE_SHARE, combine_up_to: int = COMBINE_UP_TO,
                       survey_bytes: int = SURVEY_BYTES, list_up_to: int = LIST_UP_TO,
                       turns: int = TURNS, split: int = SPLIT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``df``."""
    docs = text_view(df, id_col, text_col)
    seed = 0
    while True:
        seen = stored(survey(docs, survey_bytes, seed), "ngram-survey")
        sets = seen.where("kind = 0").select("doc_id", "n", "s1", "s2")
        # The 64-bit name of a set must be its own; another pair of hashes is taken if two sets ever share one.
        clash = sets.groupBy("s1").agg((F.min("s2") != F.max("s2")).alias("x")).where("x").limit(1).count()
        if not clash:
            break
        seed += 2
    frequent, ratio = frequent_tokens(seen, frequent_share)
    rows = key_rows(docs, frequent, ratio, combine_share / frequent_share, combine_up_to, seed)
    chained = stored(chain_lists(rows), "ngram-lists")
    lists = chained.where("kind = 0").select("key", "n", "s")
    # Neighbours in few lists are left to the second round.
    chain = (chained.where("kind = 1").groupBy(F.col("key").alias("a"), F.col("s").alias("b"))
             .agg(F.sum("n").alias("k"), F.max("x").alias("x")).where(_enough("k", 0.25)).select("a", "b"))
    # The text of one document for each set that some key pairs with another.
    wanted = lists.select("s").distinct()
    first = sets.groupBy("s1").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    named = first.join(wanted, first["s1"] == wanted["s"]).select(F.col("doc_id").alias("_id"), "s")
    whole = compressed(docs)
    texts = named.join(whole, named["_id"].eqNullSafe(whole["doc_id"])).select("s", "doc_id", "text")
    texts = stored(_own_text(texts, seed), "ngram-texts", "uncompressed")
    tried = stored(chain, "ngram-pairs")
    classes = components(stored(links(tried, texts), "ngram-links"))
    sized = with_lengths(lists, list_up_to)
    hard = stored(sized.where("long").select("key", "n", "s"), "ngram-long-lists")
    signs = stored(signatures(texts.join(hard.select("s").distinct(), "s", "left_semi")), "ngram-signatures")
    for turn in range(turns):
        # Long lists are chained again in other orders, until that joins no more components.
        labelled = hard.join(classes, "s", "left").select("key", "n", "s", F.coalesce("c", "s").alias("c"))
        pairs = stored(chain_again(labelled, signs, turn).join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
        found = stored(links(pairs, texts), "ngram-links")
        if found.limit(1).count() == 0:
            break
        tried = tried.unionAll(pairs)
        classes = joined(classes, found)
    # Lists that lie in one component have no pair to give.
    mixed = stored(mixed_keys(lists.join(classes, "s", "left").select("key", F.coalesce("c", "s").alias("c"))), "ngram-mixed-keys")
    # Keys with long lists of each set: a pair's count leaves them out.
    labelled = (sized.join(mixed, "key", "left_semi").join(classes, "s", "left").join(first_keys(hard), "s", "left")
                .join(signs, "s", "left").select("key", "n", "s", F.coalesce("c", "s").alias("c"), F.col("long").cast("int").alias("long"), F.coalesce("m", F.lit(0)).alias("m"), F.when(F.col("long"), F.col("sign")).alias("sign"),
                        *[F.when(F.col("long"), F.col(f"e{j}")).otherwise(F.lit(0)).alias(f"e{j}") for j in range(EARLY)]))
    rest = crossing_pairs(stored(labelled, "ngram-mixed-lists"), combine_up_to, split).join(tried, ["a", "b"], "left_anti")
    found = stored(links(rest, texts), "ngram-links")
    return _by_document(sets, joined(classes, found))


def signatures(texts: DataFrame) -> DataFrame:
    """(s, sign) of the sets of compressed texts."""
    def run(batches):
        for b in batches:
            for lo, hi, sets in _unpacked(b, "text"):
                yield _batch(s=b.column("s").slice(lo, hi - lo), sign=pa.array([signature(x) for x in sets], pa.binary()))

    return texts.select("s", "text").mapInArrow(run, "s long, sign binary")


def _own_text(texts: DataFrame, seed: int) -> DataFrame:
    """(s, text): of the rows that share a doc_id, one whose text is the set's."""
    def run(batches):
        for b in batches:
            for lo, hi, sets in _unpacked(b, "text"):
                name = np.array([set_hash(x, seed) for x in sets], np.uint64).view(np.int64)
                c = b.slice(lo, hi - lo).select(["s", "text"])
                yield c.filter(pa.array(name == c.column("s").to_numpy()))

    repeated = texts.groupBy("s").count().where("count > 1").limit(1).count()
    if not repeated:
        return texts.select("s", "text")
    return texts.mapInArrow(run, "s long, text binary").dropDuplicates(["s"])


def _by_document(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Component ids as least doc_ids; sets of no shingles stand alone."""
    own = F.when(F.col("n") > 0, F.coalesce("c", "s1"))
    mine = stored(sets.join(classes, sets["s1"] == classes["s"], "left").select("doc_id", "n", own.alias("c")), "ngram-classes")
    least = mine.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return mine.join(least, "c", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                               F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df`` that name their component: one document of each group of near-duplicates.

    doc_id is a document's key; of rows that share one, one stays.  Documents
    without words stay."""
    classes = similarity_classes(df, id_col, text_col, **options)
    (name,) = fresh(df, "_lost")
    lost = classes.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    kept = df.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_anti")
    repeated = classes.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates([id_col]) if repeated else kept
