"""op13 against a brute-force count of every phrase, with small minimum counts, many ranges and full counters."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from harborlens.llm import phrase_graph
from tests.llm.conftest import edge_rows

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string, lang string, n long, phrase string"


def pieces(rows):
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII_LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            if words:
                yield lang or "und", words


def counted(rows, longest=5):
    f = {}
    for lang, ws in pieces(rows):
        c = f.setdefault(lang, Counter())
        for k in range(1, longest + 1):
            c.update(" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1))
    return f


def brute(rows, longest, least, top):
    out = []
    for lang, f in counted(rows, longest).items():
        n = sum(a for p, a in f.items() if " " not in p)
        cand = {p: a for p, a in f.items() if " " in p and a >= least}
        best = []
        for p, a in cand.items():
            if any(len(q.split(" ")) > len(p.split(" ")) and f" {p} " in f" {q} " and 100 * b >= 100 * a for q, b in cand.items()):
                continue
            ws = p.split(" ")
            cuts = [(1000 * a * n // (f[" ".join(ws[:j])] * f[" ".join(ws[j:])]), j) for j in range(1, len(ws))]
            s, j = min(cuts)
            best.append((-s, -a, p.encode(), (p, a, f[" ".join(ws[:j])], f[" ".join(ws[j:])], n, s)))
        out += [(lang, i + 1, *row[3]) for i, row in enumerate(sorted(best)[:top])]
    return sorted(out)


def corpus(seed, n=150):
    g = random.Random(seed)
    vocab = ["a", "b", "the", "The", "of", "é", "x\x01", "x", "a\x0b", "zz", "Été", "10", "3.5", "don't", "😀"]
    stock = [" ".join(g.choice(vocab) for _ in range(g.randint(3, 14))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [g.choice(stock) if g.random() < 0.3 else " ".join(g.choice(vocab) for _ in range(g.randint(0, 7))) for _ in range(g.randint(0, 6))]
        rows.append((i % 40 if i % 9 else None, g.choice([" ", "  ", "\t", ". ", ",", "\n", " ; "]).join(parts) if i % 11 else None, g.choice(["en", "de", "e", None]), 1, "n"))
    rows += [(900, "one two three four five six seven eight nine. " * 5, "hot", 1, ""), (901, "hot word " * 400, "hot", 1, "")]
    return rows


def got(spark, rows, longest, least, top, parts=3):
    df = spark.createDataFrame(rows, DOC).repartition(parts)
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrase_graph.mine_phrases(df, longest, least, top).collect())


@pytest.mark.parametrize("seed,longest,least,top", [(1, 5, 2, 2000), (2, 5, 4, 20), (3, 3, 3, 2000), (4, 2, 2, 5)])
def test_against_brute_force(spark, monkeypatch, seed, longest, least, top):
    rows = corpus(seed)
    want = brute([(t, lang) for _, t, lang, *_ in rows], longest, least, top)
    assert len(want) > 10
    assert got(spark, rows, longest, least, top) == want


def test_edge_rows_and_empty_tables(spark, edge, empty):
    want = brute([(t, lang) for _, t, lang, *_ in edge_rows()], 5, 3, 50)
    assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrase_graph.mine_phrases(edge, 5, 3, 50).collect()) == want
    assert phrase_graph.mine_phrases(empty).count() == 0
    assert phrase_graph.mine_phrases(spark.createDataFrame([(1, None, None, 1, ""), (2, " . ", "en", 1, ""), (3, "word", "en", 1, "")], DOC)).count() == 0


def test_full_counters_change_nothing(spark, monkeypatch):
    """Without any cut (all counters over the minimum) the same rows come out."""
    rows = corpus(7, 60)
    want = brute([(t, lang) for _, t, lang, *_ in rows], 5, 2, 2000)
    full = spark.sparkContext.broadcast(np.full(1 << phrase_graph.CELL_BITS - 3, 255, np.uint8))
    monkeypatch.setattr(phrase_graph, "pair_filter", lambda first, least: full)
    assert got(spark, rows, 5, 2, 2000) == want


def test_small_counters_let_too_much_through_only():
    """A pair at or above the minimum always passes, whichever pairs share its counter."""
    rows = [(t, "en") for _, t, *_ in corpus(11)]
    words = phrase_graph.Words("\n".join(t or "" for t, _ in rows).encode(), "en")
    at, cell = words.pair_cells()
    for bits in (4, 8, 12):
        shared = cell & ((1 << bits) - 1)
        total = np.bincount(shared, minlength=1 << bits)
        for p, a in counted(rows, 2)["en"].items():
            if p.count(" ") == 1:
                one = [i for i in at if words.words[words.seq[i]] + b" " + words.words[words.seq[i + 1]] == p.encode()]
                assert len(one) == a and total[shared[at.tolist().index(one[0])]] >= a


def test_flow_across_any_borders():
    """Sorted grams cut into ranges and batches anywhere: the parts add up to the same counts."""
    g = random.Random(3)
    grams = sorted({(g.choice(["en", "eng"]), b"".join(g.choice([b"a ", b"a\x01 ", b"ab ", b"\xc3\xa9 "]) for _ in range(g.randint(2, 5)))) for _ in range(300)})
    n = np.array([g.randint(1, 5) for _ in grams])
    want = Counter()
    for (lang, gram), c in zip(grams, n.tolist()):
        ws = gram.split(b" ")[:-1]
        for k in range(2, len(ws) + 1):
            want[lang, b" ".join(ws[:k]).decode()] += c
    for trial in range(60):
        total = Counter()
        borders = [0, *sorted(g.sample(range(len(grams)), g.randint(0, 6))), len(grams)]
        for lo, hi in zip(borders, borders[1:]):
            flow = phrase_graph.Flow(5, 1)
            while lo < hi:
                to = min(hi, lo + g.choice([1, 2, 7, 50]))
                some = flow.take([x for x, _ in grams[lo:to]], [x for _, x in grams[lo:to]], n[lo:to])
                for lang, phrase, c in some:
                    total[lang, phrase] += c
                lo = to
            for lang, phrase, c in flow.rest():
                total[lang, phrase] += c
        assert total == want


def test_unary_paths(spark):
    """A passage that always stands as a whole is one path; a branch or a piece's end divides it."""
    ws = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join(ws), "en", 1, "") for i in range(4)] + [(9, " ".join(ws[:9]) + " other end", "en", 1, "")]
    counts, _ = phrase_graph.phrase_counts(spark.createDataFrame(rows, DOC), 5, 2)
    got = {r.phrase: r.path_words for r in phrase_graph.unary_paths(counts).collect()}
    # edges 0-4 occur 5 times, 5-9 four times
    assert got == {" ".join(ws[i:i + 5]): (9 if i <= 4 else 9) for i in range(10)}


def test_long_words_and_products_past_64_bits(spark):
    long = "y" * 70000
    rows = [(i, f"{long} {long} z", "en", 1, "") for i in range(3)]
    assert got(spark, rows, 5, 2, 10) == brute([(t, lang) for _, t, lang, *_ in rows], 5, 2, 10)
    expr = "(cast(1000 * cast(a AS decimal(19,0)) AS decimal(23,0)) * cast(n AS decimal(19,0))) DIV (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"
    import inspect
    assert expr in inspect.getsource(phrase_graph.mine_phrases)
    g = random.Random(2)
    vals = [(a, n, l, r) for a, n, l, r in ((g.randint(100, 10 ** 12), g.randint(10 ** 14, 10 ** 16), g.randint(10 ** 12, 10 ** 14), g.randint(10 ** 12, 10 ** 14)) for _ in range(200))]
    out = spark.createDataFrame(vals, "a long, n long, l long, r long").selectExpr("a", "n", "l", "r", f"cast({expr} AS long) s").collect()
    assert all(x.s == 1000 * x.a * x.n // (x.l * x.r) for x in out)
