"""Each operator against a brute-force version on rows full of edge cases, and on empty tables."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harborlens.llm import (chat_snapshots, decontaminate, line_runs, ngram_join, order_minhash, shard_table, source_mix,
                            suffix_buckets, token_planes, toxicity)
from harborlens.llm.queries import ORACLES, QUERIES, tokenizer_file
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, edge_rows
from tools.oracle_check import compare

LOW = -(1 << 63)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def ordered(rows):
    return sorted(((LOW if i is None else i, i, t or "") for i, t, *_ in rows), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF_SMALL, [name], verbose=False)[name]["ok"] is True


# ----------------------------------------------------------------------- op1

def chats(rows):
    conv = {}
    for c, t, r, x in rows:
        conv.setdefault(c, set()).add((LOW if t is None else t, r or "", x or ""))
    conv = {c: [(r, x) for _, r, x in sorted(v)] for c, v in conv.items()}
    kept = {}
    for c in sorted(conv, key=lambda c: (c is not None, c or 0)):
        mine = conv[c]
        if not any(len(o) > len(mine) and o[:len(mine)] == mine for o in conv.values()) and mine not in kept.values():
            kept[c] = mine
    return {c: "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in v) for c, v in kept.items()}


def test_chats(spark):
    g = random.Random(5)
    long = [("user" if i % 2 == 0 else "assistant", f"turn {i} {g.random()}") for i in range(90)]
    rows = []
    for c in range(12):
        rows += [(c, t, r, x) for t, (r, x) in enumerate(long[:g.choice([3, 17, 40, 90])])]
    rows += [(50, 0, None, None), (50, 0, None, None), (51, 0, "", ""), (51, 5, "user", None), (None, None, "user", "a"), (None, 2, "user", "b"),
             (60, 3, "user", "same"), (60, 3, "assistant", "same"), (61, 10 ** 12, "user", "far"), (61, -5, "system", "near")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, segment string")
    got = {}
    for r in sorted(chat_snapshots.format_chats(df, segment=7, stretch=16).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.segment)):
        assert r.segment_turns <= 7
        got[r.conv_id] = got.get(r.conv_id, "") + r.rendered
    assert got == chats(rows)
    assert chat_snapshots.format_chats(df.limit(0)).count() == 0


# ----------------------------------------------------------------------- op2

def test_token_files_round_trip(spark, edge, empty):
    tok = Tokenizer.from_file(tokenizer_file())
    tok.encode_special_tokens = True
    for unit in ("byte", "bit"):
        got = token_planes.token_files(edge, tokenizer_file(), chunk_ids=500, unit=unit).collect()
        want, start = [], 0
        for _, i, t in ordered(edge_rows()):
            ids = tok.encode(t, add_special_tokens=False).ids + [0]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_planes.token_files(empty, tokenizer_file()).count() == 0


def test_encoder_equals_the_library():
    g = random.Random(1)
    bits = ["a", "B", "c ", "  ", "\n", " \n", "é", "ß", " ", "'s", " ", "1", "23", "!", ".", ",", "\t", "\x1c", " ", "😀", "\x00",
            "<|endoftext|>", "the", " the"]
    texts = ["".join(g.choice(bits) for _ in range(g.randint(0, 25))) for _ in range(1500)]
    enc = token_planes.Encoder(tokenizer_file(), max_units=200)
    for lo in range(0, len(texts), 100):
        raw = [t.encode() for t in texts[lo:lo + 100]]
        got = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
        assert [x.tolist() for x in got] == [e.ids for e in enc.tok.encode_batch(texts[lo:lo + 100], add_special_tokens=False)]


def test_planes_and_checksums():
    ids = np.random.default_rng(2).integers(0, 1 << 20, 1001).astype(np.uint32)
    for unit in ("byte", "bit"):
        assert (token_planes.from_planes(token_planes.to_planes(ids, unit), len(ids), unit) == ids).all()
    a, b = b"hello ", b"world" * 50
    assert token_planes.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# ----------------------------------------------------------------------- op3

def test_line_runs(edge, empty):
    for k in (1, 2, 3, 4):
        got = line_runs.dedup_lines(edge, min_lines=k)
        seen, want = set(), {}
        for _, i, t in ordered(edge_rows()):
            lines = t.split("\n")
            gone = [False] * len(lines)
            for s in range(len(lines) - k + 1):
                run = tuple(lines[s:s + k])
                if run in seen:
                    gone[s:s + k] = [True] * k
                seen.add(run)
            runs = len(re.findall("1+", "".join("01"[x] for x in gone)))
            want[i] = ("\n".join(x for x, d in zip(lines, gone) if not d), len(lines), sum(gone), runs)
        assert {r.doc_id: (r.kept_text, r.n_lines, r.n_removed, r.n_runs) for r in got.collect()} == want
    assert line_runs.dedup_lines(empty).count() == 0


def test_line_runs_of_few_long_lines(spark, edge, empty):
    """A run of fewer lines counts if it has min_words words: also whole copies of one to three lines."""
    g = random.Random(8)
    long = [" ".join(f"v{g.randrange(10 ** 6)}" for _ in range(k)) for k in (49, 50, 80, 30)]
    more = [(500, long[1]), (501, long[1]), (502, long[0]), (503, long[0]), (504, "\n".join([long[3], "", long[3]])),
            (505, "\n".join(["x", long[3], "", long[3], long[2]])), (506, long[2]), (507, "\n".join([long[2]] * 3)), (508, long[0] + "\ny\nz")]
    rows = [*edge_rows(), *[(i, t, "en", "s", None) for i, t in more]]
    df = edge.unionByName(spark.createDataFrame(rows[-len(more):], DOCS))
    for k, least in ((4, 50), (4, 5), (2, 20), (1, 50), (3, 0)):
        seen, want = set(), {}
        for _, i, t in ordered(rows):
            lines = t.split("\n")
            gone = [False] * len(lines)
            for s in range(len(lines)):
                for n in range(1, min(k, len(lines) - s) + 1):
                    run = tuple(lines[s:s + n])
                    if n < k and len(re.findall(r"[^\x20\x09-\x0D]+", "\n".join(run))) < least:
                        continue
                    if run in seen:
                        gone[s:s + n] = [True] * n
                    seen.add(run)
            runs = len(re.findall("1+", "".join("01"[x] for x in gone)))
            want[i] = ("\n".join(x for x, d in zip(lines, gone) if not d), len(lines), sum(gone), runs)
        got = line_runs.dedup_lines(df, min_lines=k, min_words=least)
        assert {r.doc_id: (r.kept_text, r.n_lines, r.n_removed, r.n_runs) for r in got.collect()} == want
        assert want[501][2] == 1 or k == 1
    assert line_runs.dedup_lines(empty, min_words=50).count() == 0


# ----------------------------------------------------------------------- op4

def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    part = {i: i for i in sets}

    def top(a):
        return a if part[a] == a else top(part[a])

    key = lambda a: (a is None, a or 0)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a != b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)), key=key)
                part[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.mark.parametrize("share", [(0.00005, 0.02, 64), (0.05, 0.05, 128), (0.05, 0.05, 40), (0.02, 0.5, 0)])
def test_ngram_classes(edge, share):
    got = ngram_join.similarity_classes(edge, frequent_share=share[0], combine_share=share[1], combine_up_to=share[2])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == classes(edge_rows())


def test_ngram_classes_of_borderline_copies(spark):
    """Many copies edited by different amounts: links exist between some pairs only."""
    g = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(g.randint(0, 5)):
            w[g.randrange(len(w))] = f"e{g.random()}"
        rows.append((i, " ".join(w), "en", "s", None))
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    want = classes(rows)
    for share in ((0.00005, 0.02, 64), (0.1, 0.1, 128)):
        got = ngram_join.similarity_classes(df, frequent_share=share[0], combine_share=share[1], combine_up_to=share[2])
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert 1 < len({c for _, c in want.values()}) < 90
    kept = ngram_join.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_ngram_long_lists_are_dealt_out(spark):
    """Lists of one component are dropped; a long mixed list is cut into blocks, and the pairs stay the same."""
    g = random.Random(12)
    sets = [(s, g.choice([40, 50, 55, 70, 200]), 7 if s < 900 else 8 if s < 1200 else s) for s in range(1500)]
    rows = [(key, n << 32 | g.randrange(9), s, c, long, 50, *[key if j == 0 and long else 0 for j in range(ngram_join.EARLY)])
            for key, long, part in ((2, 1, sets), (4, 0, sets[:30] + sets[1190:1230]), (6, 1, sets[:900])) for s, n, c in part]
    df = spark.createDataFrame(rows, "key long, n long, s long, c long, long int, m long, " + ", ".join(f"e{j} long" for j in range(ngram_join.EARLY)))
    assert {r.key for r in ngram_join.mixed_keys(df).collect()} == {2, 4}
    df = df.where("key < 6").repartition(4)
    parts = ngram_join.blocked(df, split=64)
    sizes = parts.groupBy("key", "g", "role").count().collect()
    assert max(r["count"] for r in sizes) < 150 and sum(r["count"] for r in sizes if r.key == 4) >= 70
    assert parts.groupBy("key", "g").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x = y").count() == 0
    whole = {tuple(r) for r in ngram_join.crossing_pairs(df, split=10 ** 6).collect()}
    assert len(whole) > 10_000 and {tuple(r) for r in ngram_join.crossing_pairs(df, split=64).collect()} == whole
    cls = {s: c for s, _, c in sets}
    assert all(cls[a] != cls[b] for a, b in whole)


def test_ngram_classes_with_small_blocks(spark, edge):
    got = ngram_join.similarity_classes(edge, frequent_share=0.02, combine_share=0.5, combine_up_to=0, split=2, turns=0)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == classes(edge_rows())


def test_ngram_signatures_rule_out_no_link():
    g = np.random.default_rng(5)
    ruled_out = 0
    for _ in range(400):
        n, m, both = g.integers(1, 1500), g.integers(1, 1500), g.random() ** 0.2
        common = int(min(n, m) * both)
        tokens = np.unique(g.integers(0, 2 ** 64, n + m - common, dtype=np.uint64))
        g.shuffle(tokens)
        sets = tokens[:n], np.concatenate([tokens[:common], tokens[n:]])
        signs = pa.array([ngram_join.signature(x) for x in sets] + [None, b""], pa.binary())
        words = ngram_join._signs(signs.slice(1)), ngram_join._signs(signs)
        assert (words[0] == words[1][1:]).all() and not words[1][2:].any()
        over = ngram_join.bits_over(words[1], np.array([0]), np.array([1]), np.array([n]), np.array([m]))[0]
        if 100 * common >= 75 * (n + m - common):
            assert over <= 0
        ruled_out += over > 0
    assert ruled_out > 150


def test_ngram_near_copies_give_no_pair_of_all(spark, monkeypatch):
    """Pairs left after the chains, and those among them that reach the texts, do not grow with the square of a group."""
    g = random.Random(13)
    vocab = [f"w{k}" for k in range(5000)]
    say = lambda k: [g.choice(vocab) for _ in range(k)]
    base, rows = say(150), []
    for i in range(300):
        words = list(base)
        for at in g.sample(range(150), g.choice([2, 3, 3, 4, 4, 5])):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words), "en", "s", None))
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    pairs, plain = [], ngram_join.crossing_pairs

    def counted(*args, **more):
        out = plain(*args, **more).cache()
        pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "crossing_pairs", counted)
    got = ngram_join.similarity_classes(df)
    want = classes(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) > 10 and len(pairs) == 1 and pairs[0] < 2 * len(rows)


def test_ngram_empty(empty):
    assert ngram_join.similarity_classes(empty).count() == 0
    assert ngram_join.drop_near_duplicates(empty).count() == 0


# ----------------------------------------------------------------------- op5

def removed(rows, length=100):
    seen, out = set(), {}
    for _, i, t in ordered(rows):
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, d in zip(b, gone) if not d)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings(edge, empty):
    for combine in (400_000, 50):
        got = suffix_buckets.remove_repeats(edge, combine_rows=combine)
        assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == removed(edge_rows())
    assert {r.doc_id: tuple(r)[1:] for r in suffix_buckets.remove_repeats(edge, length=50, gram=16).collect()} == removed(edge_rows(), 50)
    assert suffix_buckets.remove_repeats(empty).count() == 0


def test_substrings_of_periodic_and_long_texts(spark):
    g = random.Random(4)
    block = "".join(g.choice("ab") for _ in range(300))
    long = "".join(g.choice("abcdefgh") for _ in range(700_000))
    rows = [(1, "ab" * 300), (2, "abc" * 150), (3, block + "z" * 150 + block), (4, block[7:]), (5, long), (6, long[250_000:420_000] + "#" + long[:3000]),
            (7, "é" * 120), (8, "é" * 49 + "x"), (9, "ab" * 90)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    assert {r.doc_id: tuple(r)[1:] for r in suffix_buckets.remove_repeats(df).collect()} == removed(rows)


def test_substrings_of_rows_that_share_an_id(spark):
    a, b = "".join(map(str, range(100))), "".join(map(str, range(500, 600)))
    df = spark.createDataFrame([(1, a, None, None, None), (1, a, None, None, None), (1, b, None, None, None), (2, a + b, None, None, None)], DOCS)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_buckets.remove_repeats(df).collect())
    assert got == [(1, 190, 0), (1, 190, 0), (1, 300, 0), (2, 490, 490)]


# ------------------------------------------------------------------- op6, op7

def test_mix(spark, edge, empty):
    got = source_mix.mix_sources(edge).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in edge_rows()}
    assert {r.doc_id: r["size"] for r in got} == size
    names = sorted({s for *_, s, _ in edge_rows()}, key=lambda s: (s is None, s or ""))
    of = {s: sum(size[i] for i, _, _, x, _ in edge_rows() if x == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(of.values()) - sum(3 * of[s] for s in capped)
        level = left / sum(w for s, w in weight.items() if s not in capped)
        more = {s for s in names if s not in capped and 3 * of[s] < level * weight[s]}
        if not more:
            break
        capped |= more
    target = {s: 3.0 * of[s] if s in capped else level * weight[s] for s in names}
    for r in got:
        assert (r.source_size, r.target) == (of[r.source], target[r.source])
        rate = r.target / r.source_size
        assert r.taken == r["size"] * r.copies and r.copies in (int(rate), int(rate) + (rate > int(rate))) and r.copies <= 3
    assert sorted(map(str, source_mix.mix_sources(edge.repartition(5)).collect())) == sorted(map(str, got))
    rows = source_mix.repeat_documents(edge.withColumn("copies", F.lit("x")))
    count = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert rows.columns == [*edge.columns, "copies"] and count == {r.doc_id: r.copies for r in got if r.copies}
    assert source_mix.mix_sources(empty).count() == 0 and source_mix.repeat_documents(empty).count() == 0


def test_lookup_table():
    for n, m in ((1, 3), (5, 97), (64, 8191)):
        t = shard_table.lookup_table(shard_table.shard_names(n), m)
        sizes = [t.count(i) for i in range(n)]
        assert sum(sizes) == m and max(sizes) - min(sizes) <= 1
    with pytest.raises(ValueError):
        shard_table.lookup_table(["a"], 8)
    a, b = (shard_table.lookup_table(x, 8191) for x in (shard_table.shard_names(64), shard_table.shard_names(63)))
    assert sum(x != y for x, y in zip(a, b)) < 8191 * 0.1   # losing one shard of 64 moves little else


def test_shards(spark, edge, empty):
    df = edge.withColumns({"slot": F.lit("mine"), "_owner_": F.lit(1)})
    out = shard_table.assign_shards(df)
    assert sorted(out.columns) == sorted([*df.columns, "shard"])
    t = shard_table.lookup_table(shard_table.shard_names(64))
    want = {i: int(hashlib.md5((f"k:{i}" if i is not None else "t:" + (x or "")).encode()).hexdigest()[:15], 16) % 8191 for i, x, *_ in edge_rows()}
    assert {r.doc_id: (r.slot, r.shard) for r in out.collect()} == {i: (s, t[s]) for i, s in want.items()}
    assert shard_table.assign_shards(empty).count() == 0


# ------------------------------------------------------------------------ op8

def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment_scores():
    g = np.random.default_rng(3)
    for _ in range(30):
        a, b = g.integers(1, 6, 12).astype(np.uint64), g.integers(1, 6, (4, 25)).astype(np.uint64)
        assert decontaminate.align(a, b)[0].tolist() == [smith_waterman(a.tolist(), x.tolist()) for x in b]


def test_decontamination(spark, empty):
    g = random.Random(9)
    vocab = [f"w{i}" for i in range(900)]
    say = lambda k: [g.choice(vocab) for _ in range(k)]
    items = {i: say(g.randint(12, 40)) for i in range(20)} | {100: ["tiny", "item"], 101: []}
    docs, leaks = {}, set()
    for d in range(120):
        w = say(g.randint(5, 200))
        if d % 4 == 0:
            i = g.randrange(20)
            part = list(items[i])
            if d % 8 == 0:      # edited: some words changed, dropped and added
                part[g.randrange(len(part))] = "edit"
                del part[g.randrange(len(part))]
                part.insert(g.randrange(len(part)), "more")
            at = g.randrange(len(w) + 1)
            w[at:at] = part
        docs[d] = w
    docs[500] = ["say", "Tiny", "ITEM", "now"]
    rows = [(d, " ".join(w), "en", "s", None) for d, w in docs.items()] + [(600, None, None, None, None), (601, "", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(102, None)], "item_id long, text string")
    for options in ({}, {"block_items": 7}):
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.decontaminate(df, bench, **options).collect()}
        want = {}
        for d, w in docs.items():
            low = [x.lower() for x in w]
            for i, it in items.items():
                if it and (s := smith_waterman(it, low) / (2 * len(it))) >= 0.6:
                    want[d, i] = s
        assert got == want
        assert {d for d, _ in got} == {d for d in docs if d % 4 == 0}
    clean = decontaminate.clean_documents(df, decontaminate.decontaminate(df, bench))
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == sorted({r[0] for r in rows} - {d for d, _ in got})
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == 0


# ------------------------------------------------------------------------ op9

def test_gradients_agree_with_differences():
    g = np.random.default_rng(0)
    m = toxicity.init_model(np.arange(5, dtype=np.uint64), dim=3, hidden=3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x = g.standard_normal((6, 6))
    ids = np.array([[0, 1, 2, 3, 6], [4, 5, 1, 6, 6], [2, 2, 2, 0, 1], [6, 6, 6, 6, 6]])
    y, w = np.array([1.0, 0.0, 1.0, 0.0]), np.ones(4)

    def loss(x):
        z = toxicity.window_logits(m, x, ids).astype(np.float64)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    grads, dx = toxicity._gradients(m, x, ids, y, w)
    for k in ("Wf", "Ub", "bf", "A", "a", "v", "w", "o"):
        at = tuple(g.integers(0, n) for n in m.p[k].shape)
        old, eps = m.p[k][at], 1e-4
        m.p[k][at] = old + eps
        up = loss(x)
        m.p[k][at] = old - eps
        down = loss(x)
        m.p[k][at] = old
        assert abs((up - down) / (2 * eps) - grads[k][at]) < 2e-4, k
    x2 = x.copy()
    x2[1, 2] += 1e-4
    x3 = x.copy()
    x3[1, 2] -= 1e-4
    assert abs((loss(x2) - loss(x3)) / 2e-4 - dx[1, 2]) < 2e-4


def test_windows_cover_every_word():
    row, begin = toxicity.window_grid(np.array([0, 1, 64, 65, 112, 113, 500]))
    for i, n in enumerate([0, 1, 64, 65, 112, 113, 500]):
        covered = set()
        for b in begin[row == i]:
            covered |= set(range(b, min(n, b + 64)))
        assert covered == set(range(n)) and (row == i).sum() >= 1


def test_toxicity_on_held_out_rows(spark):
    from harborlens.sources.tables import Tables
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op9_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == Tables(spark, sf).documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    caught = sum(r.predicted for r in rows if r.toxic)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93 and caught > 0.6 * sum(r.toxic for r in rows)


def test_toxicity_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in (10, 11, 20, 21, 100, 101, 104, 105)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    a, b = (toxicity.score_toxicity(df, labels, epochs=1).collect() for df in (edge, edge.repartition(7)))
    assert len(a) == edge.count() and sorted(map(str, a)) == sorted(map(str, b))
    assert {r.doc_id: r.held_out for r in a if r.doc_id is not None} == {
        i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in edge_rows() if i is not None}
    none = toxicity.score_toxicity(edge, labels.limit(0))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.drop_toxic(edge, labels.limit(0)).count() == edge.count()


# ----------------------------------------------------------------------- op10

def slow_signature(raw, k=8, slots=64, per_slot=2):
    """Order MinHash item by item."""
    if not raw:
        return [0] * slots
    m, k = (1 << 64) - 1, min(k, len(raw))
    mix = lambda x: int(order_minhash.mix64(np.array([x & m], np.uint64))[0])
    seen, items = {}, []
    for i in range(len(raw) - k + 1):
        h = 0
        for c in raw[i:i + k]:
            h = (h * int(order_minhash.POWER_BASE) + c) & m
        kmer = mix(h + k) >> 24 << 24
        items.append((mix(kmer + seen.get(kmer, 0) * 0x9E3779B97F4A7C15), i))
        seen[kmer] = seen.get(kmer, 0) + 1
    out = []
    for s in range(slots):
        best = sorted(x for x in items if x[0] % slots == s)[:per_slot]
        v = 0
        for h, _ in sorted(best, key=lambda x: x[1]):
            v = mix(v * int(order_minhash.POWER_BASE) + h + 1)
        out.append((len(best), v))
    full = [(v if n else mix(out[(s + g) % slots][1] + g * 0x632BE59BD9B4E019)) for s, (n, v) in enumerate(out)
            for g in [next(g for g in range(slots) if out[(s + g) % slots][0])]]
    return [v & 0xFFFF for v in full]


def test_signature_equals_the_slow_one():
    g = random.Random(6)
    for raw in (b"", b"a", b"abcdefgh", b"ab" * 50, bytes(g.randrange(256) for _ in range(900)), b"the cat " * 40,
                bytes(g.choice(b"abc ") for _ in range(5000))):
        assert order_minhash.signature(raw).tolist() == slow_signature(raw)


def test_fingerprints(edge, empty):
    got = by_id(order_minhash.compare_with_edit(edge))
    rows = [(i, t) for _, i, t in ordered(edge_rows())]
    sig = {t: order_minhash.signature(t.encode()) for _, t in rows}
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        edit = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        e = order_minhash.signature(edit.encode())
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert r.fingerprint == sig[t].astype(">u2").tobytes().hex() and r.edited_fingerprint == e.astype(">u2").tobytes().hex()
        assert (r.near_edited, r.near_next) == (np.mean(sig[t] == e), np.mean(sig[t] == sig[nxt]))
    assert got[10].fingerprint == got[11].fingerprint
    assert order_minhash.compare_with_edit(empty).count() == 0
    out = order_minhash.fingerprint(edge.withColumn("slot", F.lit(1)))
    assert {r.doc_id: r.fingerprint for r in out.collect()} == {i: r.fingerprint for i, r in got.items()}


def test_fingerprint_follows_order_and_edits():
    g = random.Random(8)
    w = ["".join(g.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    sig = lambda x: order_minhash.signature(" ".join(x).encode())
    few = list(w)
    few[150] = "changed"
    swapped = w[150:] + w[:150]
    far = g.sample(w, len(w))
    like = [order_minhash.likeness(sig(w), sig(x)) for x in (w, few, swapped, far)]
    assert like[0] == 1 and like[1] > 0.8 and like[1] > like[2] > like[3]


def test_single_document_is_its_own_neighbour(spark):
    df = spark.createDataFrame([(1, "abcdef", None, None, None)], DOCS)
    r = order_minhash.compare_with_edit(df).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1.0


def test_duckdb_reads_the_oracles():
    assert duckdb.sql("select 1").fetchall() == [(1,)] and set(ORACLES) <= set(QUERIES)


CLASHING = ["d", "t", "w", "q", "c", "n", "s", "k", "key", "part", "edge", "pos", "rank", "runs", "size", "rate", "copies", "target", "logit", "score",
            "block", "chunk", "ordinal", "item_id", "_part", "_rate", "_copies", "_id", "text_a", "begin", "end", "first", "kept_text"]


@pytest.mark.parametrize("run", [
    lambda df: token_planes.token_files(df, tokenizer_file()), line_runs.dedup_lines, suffix_buckets.remove_repeats, source_mix.mix_sources,
    order_minhash.compare_with_edit], ids=["op2", "op3", "op5", "op6", "op10"])
def test_extra_columns_change_nothing(edge, run):
    few = edge.where("doc_id < 40 or doc_id is null")
    more = few.withColumns({c: F.lit("x") for c in CLASHING})
    assert sorted(map(str, run(more).collect())) == sorted(map(str, run(few).collect()))


def test_extra_columns_are_kept_where_rows_are(spark, edge):
    more = edge.withColumns({c: F.lit(1) for c in CLASHING})
    bench = spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").withColumn("doc_id", F.lit(5)).withColumn("b", F.lit(1))
    for out in (ngram_join.drop_near_duplicates(more), source_mix.repeat_documents(more),
                decontaminate.clean_documents(more, decontaminate.decontaminate(more, bench))):
        assert out.columns == more.columns and out.count() > 0


def test_callers_columns_keep_their_values(spark, edge):
    """Columns named like an operator's own come back as they were."""
    names = ["_rate", "_copies", "_Copy", "_size", "_target", "_source", "_owner", "_TABLE_SLOT", "_lost", "_bad_id", "c", "s"]
    few = edge.where("doc_id < 40 or doc_id is null")
    more = few.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in names})
    bench = spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string")
    for run in (source_mix.repeat_documents, shard_table.assign_shards, ngram_join.drop_near_duplicates,
                lambda df: decontaminate.clean_documents(df, decontaminate.decontaminate(df, bench))):
        out, plain = run(more), run(few)
        assert out.columns == [*more.columns, *[c for c in plain.columns if c not in few.columns]]
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{'none' if r.doc_id is None else r.doc_id}" for r in rows for c in names)
        assert sorted(str([r[c] for c in plain.columns]) for r in rows) == sorted(str(list(r)) for r in plain.collect())
