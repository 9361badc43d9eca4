"""The pipeline against the same steps done by brute force, and the entry point without the subpackage."""

import hashlib
import os
import shutil
import subprocess
import sys

import corpus_pipeline
from harborlens.llm import decontaminate, shard_table, source_mix, toxicity
from tests.conftest import ROOT, SF_SMALL
from tests.llm.test_operators import classes


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_run_equals_brute_force(spark):
    documents, labels, benchmark = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity.score_toxicity(documents, labels).collect() if r.predicted}
    docs = {r.doc_id: r for r in documents.collect() if r.doc_id not in toxic}
    near = classes([(i, r.text) for i, r in docs.items()])
    docs = {i: r for i, r in docs.items() if near[i][1] == i}
    kept = spark.createDataFrame(list(docs.values()), documents.schema)
    leaked = {r.doc_id for r in decontaminate.decontaminate(kept, benchmark).collect()}
    docs = {i: r for i, r in docs.items() if i not in leaked}
    kept = spark.createDataFrame(list(docs.values()), documents.schema)
    copies = {r.doc_id: r.copies for r in source_mix.mix_sources(kept).collect()}
    table = shard_table.lookup_table(shard_table.shard_names(shard_table.SHARDS))
    want = []
    for i, r in docs.items():
        slot = int(hashlib.md5(f"k:{i}".encode()).hexdigest()[:15], 16) % shard_table.SLOTS
        want += [(*r, slot, table[slot])] * copies[i]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == [*documents.columns, "slot", "shard"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert leaked and toxic and len(near) > len(docs) and {0, 1} < set(copies.values())


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dedup' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")})
