"""The operators bound to the driver tables, with SQL where SQL can say the same.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLES[name]`` is DuckDB SQL.
Every query runs its operator, with production parameters, over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.llm import (chat_snapshots, decontaminate, line_runs, ngram_join, order_minhash, phrase_graph, shard_table, source_mix, suffix_buckets,
                            token_counts, token_planes, toxicity, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_CHAT_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM t),
p AS (SELECT *, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS h,
      count(*) OVER (PARTITION BY conv_id) AS n_turns FROM n),
whole AS (SELECT CASE WHEN bool_or(conv_id IS NULL) THEN NULL ELSE min(conv_id) END AS conv_id, h FROM p WHERE n = n_turns GROUP BY h),
kept AS (SELECT conv_id FROM whole WHERE h NOT IN (SELECT h FROM p WHERE n < n_turns))
SELECT p.conv_id, n_turns, (n - 1) // {chat_snapshots.SEGMENT} AS segment, min(n) AS first_turn, count(*) AS segment_turns,
  string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY n) AS rendered
FROM p JOIN kept ON p.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL"""


@query("op1_chat_snapshots", _CHAT_SQL)
def op1(spark, sf_dir):
    """Maximal conversations as chat markup."""
    return chat_snapshots.format_chats(table(spark, sf_dir, "conversations"))


@query("op2_token_planes")
def op2(spark, sf_dir):
    """Token ids of all documents, written as plane-shuffled chunks and read back."""
    return token_planes.token_files(table(spark, sf_dir, "documents"), tokenizer_file())


_AFTER = ", ".join(f"lead(line, {k}) OVER w AS l{k}" for k in range(1, line_runs.MIN_LINES))
_KEY = ", ".join(["line", *(f"l{k}" for k in range(1, line_runs.MIN_LINES))])
_LINES_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
g AS (SELECT doc_id, pos, {_AFTER}, line, lead(pos, {line_runs.MIN_LINES - 1}) OVER w AS last FROM l
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY {_KEY} ORDER BY doc_id, pos) AS r
                                   FROM g WHERE last IS NOT NULL) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range({line_runs.MIN_LINES})) AS k)),
m AS (SELECT l.*, gone.pos IS NOT NULL AS gone FROM l LEFT JOIN gone USING (doc_id, pos)),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS begins FROM m)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM e GROUP BY doc_id"""


@query("op3_line_runs", _LINES_SQL)
def op3(spark, sf_dir):
    """Later copies of runs of four lines or more removed from all documents."""
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


_DEPTHS = ", ".join(f"({k})" for k in range(1, line_runs.MIN_LINES + 1))
_NEXT = ", ".join(f"CASE WHEN k > {j} THEN lead(line, {j}) OVER w END AS l{j}" for j in range(1, line_runs.MIN_LINES))
_PASSAGES_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
c AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
u AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        count(*) OVER (PARTITION BY doc_id) AS n_lines, sum(n) OVER (PARTITION BY doc_id) AS n_words FROM c),
g AS (SELECT doc_id, pos, k, line, {_NEXT}, n_lines, coalesce(lead(before, k) OVER w, n_words) - before AS run_words
      FROM u, (VALUES {_DEPTHS}) AS d(k) WINDOW w AS (PARTITION BY doc_id, k ORDER BY pos)),
later AS (SELECT doc_id, pos, k FROM (SELECT doc_id, pos, k, row_number() OVER (PARTITION BY k, {_KEY} ORDER BY doc_id, pos) AS r
            FROM g WHERE pos + k <= n_lines AND (k = {line_runs.MIN_LINES} OR run_words >= {line_runs.MIN_WORDS})) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, pos + j AS pos FROM later, (SELECT unnest(range({line_runs.MIN_LINES})) AS j) WHERE j < k),
m AS (SELECT l.*, gone.pos IS NOT NULL AS gone FROM l LEFT JOIN gone USING (doc_id, pos)),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS begins FROM m)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM e GROUP BY doc_id"""


@query("op3_line_passages", _PASSAGES_SQL)
def op3_passages(spark, sf_dir):
    """Later copies of runs of four lines or more, or of fewer lines with 50 words or more, removed from all documents."""
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents"), min_words=line_runs.MIN_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op4_ngram_join")
def op4(spark, sf_dir):
    """Near-duplicate classes of all documents by 5-word shingles, Jaccard 0.75 or more."""
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


@query("op5_suffix_buckets")
def op5(spark, sf_dir):
    """Bytes of all documents covered by a 100-byte string that starts earlier, removed."""
    return suffix_buckets.remove_repeats(table(spark, sf_dir, "documents"))


_MIX_SQL = f"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM s GROUP BY source),
w AS (SELECT *, r % 3 + 1 AS weight FROM per),
o AS (SELECT *, sum(source_size) OVER () - {source_mix.MAX_RATE} * coalesce(sum(source_size) OVER before, 0) AS words_left,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left, row_number() OVER (ORDER BY source_size / weight, r) AS k
      FROM w WINDOW before AS (ORDER BY source_size / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE) AS level FROM o),
v AS (SELECT arg_min(level, k) AS level FROM f WHERE {source_mix.MAX_RATE} * source_size >= level * weight),
t AS (SELECT source, source_size, CASE WHEN {source_mix.MAX_RATE} * source_size < v.level * weight
        THEN CAST({source_mix.MAX_RATE} * source_size AS DOUBLE) ELSE v.level * weight END AS target FROM f, v),
c AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
        CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0.0 END AS rate,
        CAST(CAST('0x' || substr(md5('{source_mix.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS UBIGINT) AS DOUBLE)
          / 281474976710656.0 AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, rate, CAST(floor(rate) AS BIGINT) + CAST(u < rate - floor(rate) AS BIGINT) AS copies,
  size * (CAST(floor(rate) AS BIGINT) + CAST(u < rate - floor(rate) AS BIGINT)) AS taken FROM c"""


@query("op6_source_mix", _MIX_SQL)
def op6(spark, sf_dir):
    """All documents mixed to the weights of their sources."""
    return source_mix.mix_sources(table(spark, sf_dir, "documents"))


_OWNERS = ",".join(str(x) for x in shard_table.lookup_table(shard_table.shard_names(shard_table.SHARDS)))
_SHARD_SQL = f"""
WITH p AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes,
  CAST(CAST('0x' || substr(md5(coalesce('k:' || CAST(doc_id AS VARCHAR), 't:' || coalesce(text, ''))), 1, 15) AS UBIGINT) % {shard_table.SLOTS} AS BIGINT) AS slot
  FROM documents)
SELECT doc_id, n_bytes, slot, CAST(string_split('{_OWNERS}', ',')[slot + 1] AS INTEGER) AS shard FROM p"""


@query("op7_shard_table", _SHARD_SQL)
def op7(spark, sf_dir):
    """Slot and shard of all documents, by id."""
    out = shard_table.assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "slot", "shard")


@query("op8_decontaminate")
def op8(spark, sf_dir):
    """Pairs of documents and benchmark items that align."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_toxicity")
def op9(spark, sf_dir):
    """Toxicity of all documents by a network trained on the labels that are not held out."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_order_minhash")
def op10(spark, sf_dir):
    """Order-MinHash fingerprints of all documents and of their edited texts."""
    return order_minhash.compare_with_edit(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def op11(spark, sf_dir):
    """Tokens of all documents, by way of the digest cache (a new one for each call)."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op12_whitening")
def op12(spark, sf_dir):
    """All embeddings whitened, up to four components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_PHRASES_SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
q AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
w AS (SELECT pid, lang, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM q),
g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
      FROM w WINDOW o AS (PARTITION BY pid ORDER BY i)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM (SELECT lang, unnest([1, 2, 3, 4, 5]) AS k, unnest([w1, w1 || ' ' || w2,
        w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4,
        w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5]) AS phrase FROM g) WHERE phrase IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= {phrase_graph.MIN_COUNT}),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS d WHERE d.lang = c.lang AND d.k > c.k
           AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a)),
cut AS (SELECT *, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS ws FROM kept),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, l.a AS l, r.a AS r, n.n,
        (1000::HUGEINT * cut.a::HUGEINT * n.n::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT) AS score
      FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:j], ' ')
        JOIN f AS r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[j + 1:], ' ') JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM best QUALIFY rank <= {phrase_graph.TOP}"""


@query("op13_phrase_graph", _PHRASES_SQL)
def op13(spark, sf_dir):
    """Collocations of up to five words in each language of all documents."""
    return phrase_graph.mine_phrases(table(spark, sf_dir, "documents")).drop("path_words")
