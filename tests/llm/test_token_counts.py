"""op11: counts against the library itself, and what the digest cache does."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harborlens.llm import token_counts
from harborlens.llm.queries import tokenizer_file
from harborlens.llm.textkit import new_path
from tests.llm.conftest import edge_rows

WORDS = "word_bpe_49k.json"


def library(texts, name=WORDS):
    if name.endswith(".model"):
        import sentencepiece
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name)).encode(list(texts))]
    tok = Tokenizer.from_file(tokenizer_file(name))
    return [len(e) for e in tok.encode_batch(list(texts), add_special_tokens=False)]


def odd_texts(n=1500, seed=4):
    g = random.Random(seed)
    letters = "aAbBjJiIsStTdDhHwWyYK '’\t\n\x0b\r  .,!é̌̇́̈ßΣςİ12½٣\xa0\x1c\x85 中ǰ😀"
    pieces = ["<|startoftext|>", "<|STARTofTEXT|>", "<|endoftext|>", "<|endoftext|", "a", "'re", "'RE", " ", "\n", "<|", "|>", "B", "é"]
    return (["".join(g.choice(letters) for _ in range(g.randint(0, 60))) for _ in range(n)]
            + ["".join(g.choice(pieces) for _ in range(g.randint(0, 12))) for _ in range(n)])


@pytest.mark.parametrize("name", [WORDS, "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, edge, empty, name):
    got = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(edge, tokenizer_file(name), limit=100).collect()}
    rows = [(i, t or "") for i, t, *_ in edge_rows()]
    for (i, t), n in zip(rows, library([t for _, t in rows], name)):
        r = got[i, len(t.encode())]
        assert (r.n_tokens, r.over_limit) == (n, n > 100)
    assert len(got) == len(rows)
    assert token_counts.count_tokens(empty, tokenizer_file(name)).count() == 0


def test_folding_keeps_counts(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, tokenizer_file(WORDS)).collect()}
    assert [got[i] for i in range(len(texts))] == library(texts)
    special = token_counts.folding_rules(tokenizer_file(WORDS))
    assert library([token_counts.content(t, special) for t in texts]) == library(texts)
    assert token_counts.content("One\n\tTWO  ", special) == "one two"
    assert token_counts.folding_rules(tokenizer_file("byte_bpe_50k.json")) is None      # case and white space count there


def test_long_texts_go_in_parts(monkeypatch):
    path = tokenizer_file(WORDS)
    text = " ".join(odd_texts(300)).replace("<|", "") + " " + "long " * 3000 + "x" * 5000
    special = token_counts.folding_rules(path)
    whole = token_counts.content(text, special)
    monkeypatch.setattr(token_counts, "PART_CHARS", 64)
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 100)
    assert token_counts.Counter(path, special).count(whole) == library([text])[0]


def test_only_misses_are_encoded(spark, monkeypatch):
    path, cache = tokenizer_file(WORDS), new_path(spark, "test-counts")
    first = spark.createDataFrame([(1, "One two", "x"), (2, "one  TWO", "y"), (2, "three", "z"), (None, None, "z")], "doc_id long, text string, digest string")
    assert token_counts.fill_cache(first, path, cache) == 3
    assert token_counts.fill_cache(first, path, cache) == 0
    more = first.unionByName(spark.createDataFrame([(9, "four", "n"), (8, "FOUR ", "n"), (7, "", "n")], first.schema))
    for sent in (0, 1000):                                      # misses joined after the shuffle, and sent to every task
        monkeypatch.setattr(token_counts, "MISSES_SENT", sent)
        other = new_path(spark, "test-counts")
        assert token_counts.fill_cache(first, path, other) == 3
        assert token_counts.fill_cache(more, path, other) == 1
    assert token_counts.fill_cache(first, tokenizer_file("byte_bpe_50k.json"), cache) == 4     # another tokenizer's rows are its own
    # two jobs that stored the same digest at the same time do not double any document
    token_counts.read_cache(spark, cache).write.mode("append").parquet(cache + "-twice")
    token_counts.read_cache(spark, cache).write.mode("append").parquet(cache + "-twice")
    got = token_counts.count_tokens(more, path, cache + "-twice")
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got.collect()) == [
        (False, 1, 7, 2), (False, 2, 5, 1), (False, 2, 8, 2), (False, 7, 0, 0), (False, 8, 5, 1), (False, 9, 4, 1), (True, 0, 0, 0)]


def test_a_hot_content_moves_once_a_task(spark):
    """A third of the rows share one text: it is dropped to one row a task before the shuffle."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = token_counts.count_tokens(df, tokenizer_file(WORDS))
    assert got.count() == 3000 and got.where("doc_id % 3 = 0").select("n_tokens").distinct().count() == 1
