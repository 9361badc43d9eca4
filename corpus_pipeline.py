"""Corpus preparation: stages over the documents table, each calling one operator.

``run(spark, sf_dir)`` applies STAGES in order.  A stage takes (spark, docs,
sf_dir); its result is written to the shared folder and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from harborlens.llm.decontaminate import clean_documents, decontaminate
from harborlens.llm.ngram_join import drop_near_duplicates
from harborlens.llm.shard_table import assign_shards
from harborlens.llm.source_mix import repeat_documents
from harborlens.llm.textkit import stored
from harborlens.llm.toxicity import drop_toxic


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark, docs, sf_dir):
    """Documents that the toxicity network rejects go."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document, that of least doc_id, of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item, edited or not, go."""
    return clean_documents(docs, decontaminate(docs, _table(spark, sf_dir, "benchmark")))


def mixing(spark, docs, sf_dir):
    """Documents are repeated or thinned out until their sources have their weights' shares."""
    return repeat_documents(docs)


def sharding(spark, docs, sf_dir):
    """Every document, repeats included, gets its slot and shard."""
    return assign_shards(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: Toxicity is a trained model, which SQL cannot express; tests hold run() against a brute-force twin.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
