"""The pipeline against its stages by other means, and the contract of the entry."""

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from conftest import own_columns
from test_packing import check
from test_simhash import slow, slow_components

from tillview.llm import langid, quality
from tillview.llm.linear import remainder
from tillview.llm.queries import learnt_labels

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = langid.identify(docs, langid.fit_languages(docs.where(remainder("doc_id", 4) != 2)))
    kept = docs.join(told.where("not rejected").select("doc_id"), "doc_id").select(*docs.columns)
    weights = quality.fit_quality(kept, learnt_labels(spark, FOLDER, "quality"))
    good = quality.score_quality(kept, weights).where("score >= 0.3").collect()
    prints = [(r.doc_id, slow(r.text)) for r in good]
    least = slow_components(prints, 2)
    left = [(r.doc_id, r.text) for r, (doc_id, p) in zip(good, prints, strict=True) if least[p] == doc_id]
    check(corpus_pipeline.run(spark, FOLDER).toPandas(), left, 2048)


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, work in corpus_pipeline.STAGES[:-1]:
        kept = work(spark, docs, FOLDER)
        assert kept.schema == docs.schema
        clean = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
        if name != "simhash_near_dedup":
            gone = clean.join(kept, "doc_id", "left_anti").count()
            assert gone <= 0.02 * clean.count(), name


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_edges_in_every_stage(spark, edges, empty, stage):
    name, work = stage
    assert work(spark, empty, FOLDER).count() == 0
    kept = work(spark, edges, FOLDER)
    if name != "best_fit_packing":
        assert kept.schema == edges.schema and own_columns(kept)
    assert kept.count() <= 10 or name == "best_fit_packing"


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    """The rest imports and answers when these folders are gone."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", *([] if pipeline else ["corpus_pipeline.py"]), "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not [n for n in q if n.startswith('op1_')] and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""}, check=True, timeout=120)


def test_executors_need_no_copy_of_the_package(tmp_path):
    """A driver that has the package on its path only: workers start elsewhere."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
for name in ("op1_quality", "op2_toxicity", "op3_url_filter", "op4_best_fit_packing", "op5_simhash", "op6_language_id", "op8_byte_bpe", "op9_chat_format", "op10_hilbert_ann", "op12_token_files", "op13_collocations"):
    entry.queries()[name](spark, {FOLDER!r}).write.format("noop").mode("overwrite").save()
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300, capture_output=True)
