"""Token counts through a digest cache.

A document's count depends only on its content, as far as the tokenizer can see
it, and on the tokenizer.  So a stored table holds (content digest, tokenizer
digest, count).  Documents are reduced to their content digest, joined to the
stored counts, and only the distinct contents that the cache does not know are
encoded; their counts are appended to it and the documents joined once more.

*Content.*  A tokenizer that lower-cases, and drops white space, gives the same
count when A-Z is lower-cased and runs of ASCII white space become one space, so
texts that differ in these only share one entry.  A text keeps its form if it or its
lower-cased form is not in Unicode's composed form (J with a caron mark composes
otherwise than j), or if lower-casing could make a special string.  Any other
tokenizer takes the text as it is.

*Encoding.*  No token of such a tokenizer spans white space, so a text's count is
the sum over its words, and each worker counts a word once.

*Movement.*  Documents move as digests; those of a content that more than one document
in ``HOT`` has do not move at all: there are fewer than ``HOT`` such contents, so their
counts go to every task.  Texts move once, the distinct ones of each task only, and
none that the cache knows (those are left out before the shuffle if the list of misses
is short enough to send to every task, else after it).

Defined results: null text is empty and has no tokens; one row for each row of
the input, also for repeated and null doc_ids; other columns are not read, so they
can have any name; an empty table gives no row.  Texts of any length are counted
whole, ``PART_CHARS`` characters at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.llm.textkit import new_path, stored, text_chunks, text_view, utf8

LIMIT = 2048
MISSES_SENT = 500_000        # digests of 32 bytes: at most 16 MB go to every task
KNOWN_WORDS = 600_000        # words a worker remembers at most
PART_CHARS = 1 << 20
HOT = 1000
CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens long"
#: The normaliser and the splitter for which the folding of contents and the counting by words are exact.
FOLDING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same splitter for lower-case words of printable ASCII, which stand for themselves in the model's alphabet.
ASCII_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
PRINTABLE = re.compile("[!-~]+").fullmatch
TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def tokenizer_digest(path: str) -> bytes:
    """Digest of a tokenizer's version: its file and the release of the library that reads it."""
    import importlib.metadata
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode() + f.read()).digest()


def folding_rules(path: str) -> list[str] | None:
    """The special strings of a tokenizer that lower-cases and drops white space, None for any other one."""
    if path.endswith(".model"):
        return None
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers")
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = {"type": "Split", "pattern": {"Regex": SPLITTER}, "behavior": "Removed", "invert": True}
    bytelevel = len(cuts) == 2 and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not any(c.isspace() for c in t["content"])
                for t in spec.get("added_tokens", []))
    known = steps == FOLDING and cuts[0] == split and bytelevel and plain and not spec.get("post_processor")
    return [t["content"] for t in spec.get("added_tokens", [])] if known else None


def content(text: str, special: list[str] | None) -> str:
    """What of a text its count depends on."""
    if special is None:
        return text
    raw = text.encode()
    low = b" ".join(raw.translate(TO_LOWER).split())           # split() takes ASCII white space only in bytes
    folded = low.decode()
    if not text.isascii() and not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", folded)):
        return text
    if any(s.lower() in folded for s in special):
        return text
    return folded


class Counter:
    """Counts of whole texts by one tokenizer file."""

    def __init__(self, path: str, special: list[str] | None):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        self.special, self.words, self.parts = special, {}, {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.sizes = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.model = tok.model
        self.sizes = lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def for_worker(path: str, special: list[str] | None) -> Counter:
        """One counter, with the words it knows, for all tasks that a Python worker process runs."""
        kept = sys.modules.setdefault("_harborlens_counts", types.ModuleType("_harborlens_counts")).__dict__
        if path not in kept:
            kept[path] = Counter(path, special)
        return kept[path]

    def learn(self, words: list[str]) -> None:
        """Counts of words the counter has not met: those of printable lower-case ASCII by the model alone, part by part."""
        whole = []
        for word in words:
            if PRINTABLE(word) and word == word.lower() and not any(s in word for s in self.special):
                n = 0
                for part in ASCII_PARTS(word):
                    size = self.parts.get(part)
                    if size is None:
                        size = self.parts[part] = len(self.model.tokenize(part))
                    n += size
                self.words[word] = n
            else:
                whole.append(word)
        if whole:
            self.words.update(zip(whole, self.sizes(whole)))

    def count(self, text: str) -> int:
        if self.special is None:
            return self.sizes([text])[0]
        total, lo = 0, 0
        while lo < len(text):
            hi = len(text)
            if hi - lo > PART_CHARS:                     # cut after a part, at the next space
                hi = text.find(" ", lo + PART_CHARS)
                hi = len(text) if hi < 0 else hi
            words = text[lo:hi].split(" ")
            new = [w for w in set(words) if w not in self.words]
            if len(self.words) + len(new) > KNOWN_WORDS:
                self.words, self.parts, new = {}, {}, list(set(words))
            if new:
                self.learn(new)
            total += sum(map(self.words.__getitem__, words))
            lo = hi + 1
        return total


def digests(special: list[str] | None, with_content: bool):
    """mapInArrow function: (doc_id, text) to (doc_id, n_bytes, digest) or to (digest, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks([batch]):
                texts = part.column("text").to_pylist()
                contents = [content(t, special) for t in texts]
                names = pa.array([hashlib.sha256(c.encode()).digest() for c in contents], pa.binary())
                if with_content:
                    yield pa.RecordBatch.from_arrays([names, pa.array(contents, pa.string())], names=["digest", "content"])
                else:
                    sizes = np.diff(utf8(part.column("text"))[1])
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), names], names=["doc_id", "n_bytes", "digest"])

    return run


def encode_misses(path: str, shipped: str | None, version: bytes, special: list[str] | None):
    """mapInArrow function: (digest, content) to the cache's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter.for_worker(SparkFiles.get(shipped) if shipped else path, special)
            sizes = [counter.count(t.as_py()) for t in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([version] * len(sizes), pa.binary()), pa.array(sizes, pa.int64())],
                                             names=["digest", "tokenizer", "n_tokens"])

    return run


def read_cache(spark, cache: str) -> DataFrame | None:
    """The stored counts, None if nothing has been stored there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def known_counts(spark, cache: str, version: bytes) -> DataFrame | None:
    """(digest, n_tokens) of one tokenizer: one row a digest, whatever jobs appended at the same time."""
    rows = read_cache(spark, cache)
    if rows is None:
        return None
    return rows.where(F.col("tokenizer") == F.lit(bytearray(version))).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def docs_digests(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_bytes, digest) of every row."""
    return text_view(docs, id_col, text_col).mapInArrow(digests(folding_rules(tokenizer), False), "doc_id long, n_bytes long, digest binary")


def fill_cache(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text", ship: bool = False,
               names: DataFrame | None = None) -> int:
    """Append the counts of all contents of ``docs`` that ``cache`` lacks; returns how many were encoded.

    ``names`` are the documents' digests if they are at hand.  ``ship`` sends the tokenizer
    file to the workers, for clusters whose machines do not have it at ``tokenizer``."""
    spark = docs.sparkSession
    special, version = folding_rules(tokenizer), tokenizer_digest(tokenizer)
    shipped = None
    if ship:
        import os
        spark.sparkContext.addFile(tokenizer)
        shipped = os.path.basename(tokenizer)
    texts = text_view(docs, id_col, text_col).mapInArrow(digests(special, True), "digest binary, content string")
    known = known_counts(spark, cache, version)
    if known is not None:
        names = docs_digests(docs, tokenizer, id_col, text_col) if names is None else names
        misses = stored(names.select("digest").distinct().join(known, "digest", "left_anti"), "token-misses")
        n = misses.count()
        if not n:
            return 0
        if n <= MISSES_SENT:
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
    distinct = texts.groupBy("digest").agg(F.any_value("content").alias("content"))
    if known is not None and n > MISSES_SENT:
        distinct = distinct.join(misses, "digest", "left_semi")
    rows = distinct.mapInArrow(encode_misses(tokenizer, shipped, version, special), CACHE_SCHEMA)
    before = 0 if known is None else read_cache(spark, cache).count()
    rows.write.mode("append").parquet(cache)
    return read_cache(spark, cache).count() - before


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, ship: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    ``tokenizer`` is a .json file of the tokenizers library or a .model file of
    sentencepiece.  ``cache`` is the folder of the stored counts in storage that the
    cluster shares; without one, a new folder beside the checkpoints holds them."""
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-counts")
    rows = stored(docs_digests(docs, tokenizer, id_col, text_col), "token-digests")
    fill_cache(docs, tokenizer, cache, id_col, text_col, ship, rows)
    counts = known_counts(spark, cache, tokenizer_digest(tokenizer))
    per = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("docs"))
    hot = per.where(F.col("docs") * HOT > rows.count()).select("digest")      # fewer than HOT rows
    hot = F.broadcast(stored(hot.join(counts, "digest"), "token-hot"))
    out = (F.col("n_tokens") > limit).alias("over_limit")
    there = rows.join(hot, "digest").select("doc_id", "n_bytes", "n_tokens", out)
    rest = rows.join(hot.select("digest"), "digest", "left_anti").join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", out)
    return there.unionAll(rest)
